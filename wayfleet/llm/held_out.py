"""The fold of a document and its labels for learning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: Column, folds: int) -> Column:
    """crc32 of the key as text modulo ``folds``; a null key belongs to fold -1, which is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(folds)), F.lit(-1)).cast("int")


def training_labels(labels: DataFrame, label_col: str, folds: int, left_out: int, key_col: str = "doc_id") -> DataFrame:
    """(id, label) of the rows to learn from: 0 or 1, outside the fold left out. Other labels and null keys are ignored."""
    return (labels.where(F.col(label_col).isin(0, 1) & F.col(key_col).isNotNull() & (remainder(F.col(key_col), folds) != left_out))
            .select(F.col(key_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")))


def sums(rows: DataFrame, partial, by: str = "part") -> dict[int, list[float]]:
    """Element-wise sums of the arrays that ``partial`` makes of each task's batches, by part. As many numbers as one task yields."""
    made = rows.mapInArrow(partial, f"{by} int, values array<double>")
    cells = made.select(by, F.posexplode("values").alias("at", "x")).groupBy(by, "at").agg(F.sum("x").alias("x")).collect()
    out: dict[int, list[float]] = {}
    for part, at, x in sorted((r[by], r["at"], r["x"]) for r in cells):
        out.setdefault(part, []).append(x)
    return out
