"""Repeatable samples of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.functions.scalars import DRAW_DIGITS, drawn


def sample_edges(edges: DataFrame, k: int, seed: int = 0, weighted: bool = False) -> DataFrame:
    """``k`` edges without replacement, uniform or by length (at least 1 m each).

    Each edge draws a key from a digest of its id; the k smallest win, found per
    partition first and then merged.
    """
    u = (drawn(seed, F.col("edge_id")) + 0.5) / float(16 ** DRAW_DIGITS)
    key = -F.log(u) / F.greatest("length_meters", F.lit(1.0)) if weighted else u
    return edges.withColumn("_key", key).orderBy("_key", "edge_id").limit(k).drop("_key")
