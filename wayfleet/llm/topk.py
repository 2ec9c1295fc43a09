"""Exact top-k inner products by norm-bucketed retrieval.

Vectors become integer vectors and are grouped by length into bands, a band into
blocks of bounded size. A first look at one block of the longest vectors gives
every query a score that its k-th best cannot fall below. For each block the
score turns into a local cosine threshold: blocks whose longest vector cannot
reach it are never sent to the query; in the others a high threshold prunes by
coordinates, a low one by length, and what is left is verified by its product.

Defined results: rows without id, null vectors and vectors with a null, NaN or
infinite component take no part; only vectors of one dimension are compared; a query skips
its own row, not other rows of its id; equal scores go to the smaller id;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfleet.session import cut

SCALE = 256
BAND = 1.05             # longest over shortest vector of a band
ROWS, QUERIES = 4096, 1024    # of a block of vectors and of queries
BY_COORDINATE = 0.7     # local cosine threshold from which coordinates prune
COORDINATES = 3
_SLACK = 1e-9


def prepare(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, row, dim, norm, band, v) of the vectors that take part, written to the shared folder."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    whole = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(
        "id is not null and x is not null and not exists(x, c -> c is null or isnan(c) or abs(c) = double('infinity'))")
    rows = whole.select("id", F.monotonically_increasing_id().alias("row"), F.size("x").alias("dim"),
                        F.transform("x", lambda c: F.floor(F.lit(SCALE) * c).cast("long")).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, c: acc + c.cast("double") * c.cast("double")))
    rows = rows.withColumn("norm", norm)
    return cut(rows.withColumn("band", F.when(F.col("norm") > 0, F.floor(F.log("norm") / F.log(F.lit(BAND)))).otherwise(F.lit(-1)).cast("int")), "vectors")


def _matrix(table: pa.Table) -> np.ndarray:
    return table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer products; floats are used where they are exact."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2.0 ** 53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T


_FOUND = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("vec_row", pa.int64()), ("score", pa.int64())])


def _best(k: int, prune: bool, queries: pa.Table, vectors: pa.Table) -> pa.Table:
    """The k best of one block of vectors for each query of one block."""
    q, x = _matrix(queries), _matrix(vectors)
    qn, xn = queries.column("norm").to_numpy(), vectors.column("norm").to_numpy()
    q_row, q_id = queries.column("row").to_numpy(), queries.column("id").to_numpy()
    x_row, x_id = vectors.column("row").to_numpy(), vectors.column("id").to_numpy()
    least = queries.column("least").to_numpy(zero_copy_only=False) if prune else np.full(len(q), -np.inf)
    order = np.argsort(-xn, kind="stable")
    x, xn, x_row, x_id = x[order], xn[order], x_row[order], x_id[order]
    local = np.where(np.isfinite(least) & (least > 0), least / np.maximum(qn * (xn[0] if len(xn) else 0), _SLACK), -1.0)
    out = []

    def keep(i, cand, scores):
        ok = (scores >= least[i]) & (x_row[cand] != q_row[i])
        cand, scores = cand[ok], scores[ok]
        top = np.lexsort((x_row[cand], x_id[cand], -scores))[:k]
        out.append((np.full(len(top), q_row[i]), np.full(len(top), q_id[i]), x_id[cand[top]], x_row[cand[top]], scores[top]))

    far = local > 1 + _SLACK
    sharp = ~far & (local >= BY_COORDINATE)
    unit = x / np.maximum(xn, _SLACK)[:, None]
    for i in np.flatnonzero(sharp):
        direction = q[i] / max(qn[i], _SLACK)
        cand = np.arange(len(x))
        for f in np.argsort(-np.abs(direction))[:COORDINATES]:
            # A unit vector at this cosine lies between these values in coordinate f.
            reach = np.sqrt(max(1 - direction[f] ** 2, 0) * max(1 - local[i] ** 2, 0)) + 1e-6
            u = unit[cand, f]
            inside = (u >= direction[f] * local[i] - reach) if direction[f] >= 0 else (u <= direction[f] * local[i] + reach)
            cand = cand[inside]
        keep(i, cand, _products(q[i:i + 1], x[cand])[0])
    rest = np.flatnonzero(~far & ~sharp)
    for start in range(0, len(rest), 256):
        own = rest[start:start + 256]
        reach = np.where(np.isfinite(least[own]) & (least[own] > 0), least[own] / np.maximum(qn[own], _SLACK) * (1 - _SLACK), -1.0)
        until = np.searchsorted(-xn, -reach, "right")        # vectors too short for the query come after
        scores = _products(q[own], x[:until.max(initial=0)])
        for j, i in enumerate(own):
            keep(i, np.arange(until[j]), scores[j, :until[j]])
    columns = [np.concatenate([o[c] for o in out]) if out else np.zeros(0, np.int64) for c in range(5)]
    return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in columns], schema=_FOUND)


def _search(k: int, prune: bool, queries: pa.Table, vectors: pa.Table) -> pa.Table:
    if not queries.num_rows or not vectors.num_rows:
        return _FOUND.empty_table()
    return _best(k, prune, queries, vectors)


def _searcher(k: int, prune: bool):
    def search(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        return _search(k, prune, queries, vectors)
    return search


def _renewed(table: DataFrame) -> DataFrame:
    """The same columns as new ones, so that a table can meet another one made from the same source."""
    return table.select(*[F.col(c).alias(c) for c in table.columns])


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id ``every`` divides, against all rows."""
    rows = prepare(vectors, id_col, vector_col)
    asking = rows.where(F.pmod("id", F.lit(every)) == 0)
    q_blocks = max(1, -(-asking.count() // QUERIES))
    counts = rows.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"))
    rows = cut(rows.join(counts, ["dim", "band"]).withColumn("block", F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / ROWS)).cast("int")).drop("n"), "blocks")
    queries = rows.where(F.pmod("id", F.lit(every)) == 0).withColumn("q_block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(q_blocks)).cast("int"))
    blocks = cut(rows.groupBy("dim", "band", "block").agg(F.max("norm").alias("longest"), F.count(F.lit(1)).alias("n")), "longest")
    schema = "query long, query_id long, vec_id long, vec_row long, score long"

    # The first look: one block of the longest vectors that has enough rows.
    top = blocks.where(F.col("n") > k).groupBy("dim").agg(F.max(F.struct("longest", "band", "block")).alias("b")).select("dim", "b.band", "b.block")
    seeds = rows.join(top, ["dim", "band", "block"])
    each = seeds.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    first = (queries.groupBy("dim", "q_block").cogroup(_renewed(each).groupBy("dim", "q_block"))
             .applyInArrow(_searcher(k, False), schema))
    bounds = first.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select(
        F.col("query").alias("row"), F.col("least").cast("double").alias("least"))
    queries = cut(queries.join(bounds, "row", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf")))), "queries")

    # Which blocks can reach which block of queries at all.
    reach = queries.groupBy("dim", "q_block").agg(F.max("norm").alias("norm"), F.min(F.when(F.col("norm") > 0, F.col("least") / F.col("norm"))
                                                  .otherwise(F.lit(float("-inf")))).alias("need"))
    met = cut(reach.join(blocks, "dim").where((F.col("need") <= 0) | (F.col("longest") * (1 + _SLACK) >= F.col("need")))
              .select("dim", "q_block", "band", "block"), "met")
    keys = ["dim", "q_block", "band", "block"]
    sent = queries.drop("band", "block").join(met, ["dim", "q_block"])
    looked = rows.join(met, ["dim", "band", "block"])
    found = (sent.groupBy(*keys).cogroup(_renewed(looked).groupBy(*keys)).applyInArrow(_searcher(k, True), schema))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "vec_row"))
    return (found.withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))

