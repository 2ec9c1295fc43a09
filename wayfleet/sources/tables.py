"""Keyed tables kept as Parquet folders: edge state and vehicle documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.operators.traffic import latest_by, latest_edge_state
from wayfleet.schemas import EDGE_STATE, VEHICLE


# ---- edge state: one folder per micro-batch ------------------------------
def write_state_batch(states: DataFrame, batch_id: int, path: str) -> None:
    """Newest row per edge of one micro-batch; a replay of the batch writes the same folder again."""
    latest_edge_state(states).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Newest published row per edge over all batches."""
    return latest_edge_state(spark.read.schema(EDGE_STATE).parquet(path).select(*EDGE_STATE.names))


def compact_state(spark: SparkSession, path: str, new_path: str) -> DataFrame:
    """Fold all batches into one row per edge at a new place; the log itself is left alone."""
    write_state_batch(read_state(spark, path), 0, new_path)
    return read_state(spark, new_path)


def state_as_json(states: DataFrame) -> DataFrame:
    """(key, payload) text rows, the form a key-value reader expects."""
    return states.select(F.concat(F.lit("edge:"), "edge_id").alias("key"),
                         F.to_json(F.struct(*states.columns)).alias("payload"))


def state_from_json(rows: DataFrame) -> DataFrame:
    return rows.select(F.from_json("payload", EDGE_STATE).alias("s")).select("s.*")


# ---- vehicle documents --------------------------------------------------
def read_vehicles(spark: SparkSession, path: str, vehicle_id: str | None = None) -> DataFrame:
    rows = spark.read.schema(VEHICLE).parquet(path)
    return rows.filter(F.col("vehicle_id") == vehicle_id) if vehicle_id is not None else rows


def upsert_by_key(base: DataFrame, changes: DataFrame, key: str, reset: tuple[str, ...] = ()) -> DataFrame:
    """Set the columns that ``changes`` carries, keep the others, insert what is absent.

    A null in ``changes`` is a value like any other and is stored.  ``reset``
    columns are emptied on every row that is touched.
    """
    new_only = [c for c in changes.columns if c not in base.columns]
    if new_only:
        raise ValueError(f"unknown columns {new_only}")
    touched = changes.select(F.col(key).alias("_key"), F.struct(*[c for c in changes.columns if c != key]).alias("_new"))
    joined = base.join(touched, F.col(key) == F.col("_key"), "full_outer")
    hit = F.col("_key").isNotNull()
    out = []
    for c in base.columns:
        if c == key:
            out.append(F.coalesce(key, "_key").alias(key))
        elif c in reset:
            out.append(F.when(~hit, F.col(c)).alias(c))
        elif c in changes.columns:
            out.append(F.when(hit, F.col("_new")[c]).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def newest_documents(log: DataFrame, key: str, order: str) -> DataFrame:
    """Current document per key from an append-only log."""
    return latest_by(log, [key], [order])
