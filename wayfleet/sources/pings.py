"""Ping sources: a topic, or files that hold the same JSON payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.schemas import PING


def read_topic(spark: SparkSession, servers: str, topic: str = "gps_stream",
               starting: str = "earliest", per_trigger: int | None = None) -> DataFrame:
    """Stream of raw topic rows; needs the Kafka connector on the class path."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("startingOffsets", starting).option("failOnDataLoss", "false"))
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()


def read_payload_files(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """Stream of text files, one JSON payload per line, in the same ``value`` column."""
    reader = spark.readStream.format("text")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def decode_pings(raw: DataFrame, schema=PING) -> DataFrame:
    """Payload bytes to columns; malformed JSON becomes nulls for the filters to drop."""
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def encode_pings(pings: DataFrame) -> DataFrame:
    """Key and JSON value as a topic expects them."""
    return pings.select(F.col("entity_id").cast("binary").alias("key"),
                        F.to_json(F.struct(*pings.columns)).alias("value"))
