"""Tables in versions, and components of hubs and chains."""

import random

import pytest

from wayfleet.operators.network import components_of_links
from wayfleet.schemas import EDGE_STATE
from wayfleet.sources.versions import DocumentTable, StateTable

DOCUMENT = "key string, route array<string>, status string, cost double"


def states(spark, *rows):
    return spark.createDataFrame([(e, speed, 1, 100.0, 50.0, 1.0, speed < 5, "t", at) for e, speed, at in rows], EDGE_STATE)


def held(table, version=None):
    return sorted((r.edge_id, r.avg_speed, r.last_updated) for r in table.read(version).collect())


def test_state_versions(spark, tmp_path):
    table = StateTable(spark, f"{tmp_path}/state", "edge_id", "last_updated", EDGE_STATE, compact_every=3)
    assert held(table) == [] and table.manifest() == {"version": 0}
    assert table.publish(states(spark, ("a", 10.0, 5), ("b", 20.0, 5)), 0) == 1
    assert table.publish(states(spark, ("a", 11.0, 5), ("b", 1.0, 4)), 1) == 2       # the same window again, and an older one
    assert held(table) == [("a", 11.0, 5), ("b", 20.0, 5)]
    assert table.publish(states(spark, ("a", 99.0, 9)), 1) == 2 and table.publish(states(spark, ("a", 99.0, 9)), 0) == 2
    assert held(table) == [("a", 11.0, 5), ("b", 20.0, 5)] and held(table, 1) == [("a", 10.0, 5), ("b", 20.0, 5)]
    assert table.publish(states(spark, ("c", 3.0, 7)), 2) == 4                         # and compacted
    now = table.manifest()
    assert now["deltas"] == [] and now["base"] and now["batch"] == 2 and held(table) == [("a", 11.0, 5), ("b", 20.0, 5), ("c", 3.0, 7)]
    assert table.publish(states(spark, ("c", 4.0, 7)), 3) == 5 and held(table)[-1] == ("c", 4.0, 7)
    assert table.vacuum(keep=1) == 3 and held(table)[-1] == ("c", 4.0, 7) and table.versions() == [5]


def test_an_unfinished_writer_changes_nothing(spark, tmp_path):
    table = StateTable(spark, f"{tmp_path}/state", "edge_id", "last_updated", EDGE_STATE)
    table.publish(states(spark, ("a", 10.0, 5)), 0)
    states(spark, ("a", 99.0, 9)).write.parquet(f"{tmp_path}/state/{table.new_folder()}")
    assert held(table) == [("a", 10.0, 5)]
    with pytest.raises(RuntimeError, match="someone else"):
        table.commit(table.manifest())
    assert held(table) == [("a", 10.0, 5)] and table.vacuum() == 1


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCUMENT)


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    rows = [(f"k{i}", [f"r{i}"], "stale", float(i)) for i in range(200)]
    base = documents(spark, rows)
    table = DocumentTable(spark, f"{tmp_path}/docs", "key", base.schema, buckets=32)
    table.create(base)
    with pytest.raises(ValueError):
        table.create(base)
    changes = spark.createDataFrame([("k3", 30.0), ("new", 1.0), ("k4", None)], "key string, cost double")
    before = table.manifest()["buckets"]
    assert table.merge(changes, reset=("status",)) == 2 and table.merge(changes.where("false")) == 2
    after = table.manifest()["buckets"]
    moved = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(moved) <= 3 and table.rewritten_share() == len(table.manifest()["touched"]) / 32
    got = {r.key: tuple(r) for r in table.read().collect()}
    want = {r[0]: r for r in rows} | {"k3": ("k3", ["r3"], None, 30.0), "new": ("new", None, None, 1.0), "k4": ("k4", ["r4"], None, None)}
    assert got == want and [tuple(r) for r in table.read(key="k3").collect()] == [want["k3"]]
    assert {r.key: tuple(r) for r in table.read(1).collect()} == {r[0]: r for r in rows}
    table.merge(changes, reset=("status",))                                              # the same again
    log = {(r.version, r.key): (r.kind, r.before and r.before.cost, r.after.cost) for r in table.changes(1).collect()}
    assert log == {(2, "k3"): ("update", 3.0, 30.0), (2, "new"): ("insert", None, 1.0), (2, "k4"): ("update", 4.0, None)}
    assert table.changes(3).collect() == [] and table.changes(0, 1).count() == 200


@pytest.mark.parametrize("lanes", [1, 16])
def test_components_of_hubs_and_chains(spark, lanes):
    rng = random.Random(3)
    links = [("hub", f"leaf{i:04d}") for i in range(2000)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(300)]
    links += [("x", "x"), ("z9", "z1"), ("z1", "z5"), ("q", "q"), ("q", "p")]
    rng.shuffle(links)
    got = {r.node_id: r.component for r in components_of_links(spark.createDataFrame(links, "a string, b string"), lanes=lanes).collect()}
    assert {got[f"leaf{i:04d}"] for i in range(2000)} == {"hub"} and got["hub"] == "hub"
    assert {got[f"c{i:03d}"] for i in range(301)} == {"c000"} and got["x"] == "x" and got["p"] == got["q"] == "p"
    assert got["z9"] == got["z5"] == got["z1"] == "z1"
    assert components_of_links(spark.createDataFrame([], "a string, b string")).collect() == []
