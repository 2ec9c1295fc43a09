"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.session import cut


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: nodes point at the least neighbour of a node they touch.

    The least neighbour is combined before the shuffle; the join back on the
    node is an equi-join that AQE splits where one node has many edges.
    """
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every node of edges (a, b); component is the least id reachable.

    Each round is written to the shared folder, so a lost executor costs one
    round. Rounds grow with the logarithm of the diameter; no convergence within
    ``rounds`` raises.
    """
    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
              "edges")
    for _ in range(rounds):
        seen = now.agg(F.count(F.lit(1)), F.countDistinct("a")).first()
        # Every node points at one smaller node that points at nothing: the components are read off.
        if seen[0] == seen[1] and now.join(now.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        now = cut(_stars(_stars(now, large=True), large=False), "edges")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def merged(found: DataFrame, edges: DataFrame) -> DataFrame:
    """``found`` (id, component) after more edges (a, b): only the graph of components is searched again."""
    ends = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct()
    fresh = ends.join(found.select("id"), "id", "left_anti").select("id", F.col("id").alias("component"))
    every = cut(found.unionByName(fresh), "components")
    side = lambda tag: every.select(F.col("id").alias(tag), F.col("component").alias(f"of_{tag}"))
    between = edges.join(side("a"), "a").join(side("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    joined = components(between).select(F.col("id").alias("component"), F.col("component").alias("_under"))
    return every.join(joined, "component", "left").select("id", F.coalesce("_under", "component").alias("component"))
