"""Every registered query against its SQL twin, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(columns), sorted((tuple(cell(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DIR)
    got = plain(df.columns, [tuple(r) for r in df.collect()])
    assert got[1], "no rows"
    if name in entry.oracle_sql():
        rel = duck.sql(entry.oracle_sql()[name])
        assert got == plain(rel.columns, rel.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "edge_id"
