"""Map sources and sinks: OSM XML, edge files, clipped copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.operators.network import clip_edges, with_position
from wayfleet.schemas import EDGE, OSM_NODE, OSM_WAY


def read_osm(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, ways) of an OSM file, under a fixed schema."""
    nodes = (spark.read.format("xml").option("rowTag", "node").schema(OSM_NODE).load(path)
             .select(F.col("_id").alias("node_id"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon")))
    ways = (spark.read.format("xml").option("rowTag", "way").schema(OSM_WAY).load(path)
            .select(F.col("_id").alias("way_id"), F.col("nd._ref").alias("refs"),
                    F.coalesce("tag", F.array().cast("array<struct<_k:string,_v:string>>")).alias("tags")))
    return nodes, ways


def write_osm(nodes: DataFrame, ways: DataFrame, path: str) -> None:
    """Nodes (node_id, lat, lon) and ways (way_id, refs, tags) as OSM XML, in folders below ``path``; ``read_osm(path + "/*")`` reads them."""
    def save(rows: DataFrame, tag: str) -> None:
        rows.write.format("xml").option("rootTag", "osm").option("rowTag", tag).save(f"{path}/{tag}s")

    save(nodes.select(F.col("node_id").alias("_id"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon")), "node")
    save(ways.select(F.col("way_id").alias("_id"), F.transform("refs", lambda r: F.struct(r.alias("_ref"))).alias("nd"),
                     F.col("tags").alias("tag")), "way")


def read_edges(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Edge table from Parquet, JSON Lines (``json``) or one JSON array (``json_array``).

    Files without ``edge_seq`` get it from their order by name and the row order within
    each, however Spark deals files and blocks to tasks.
    """
    reader = spark.read.schema(EDGE)
    edges = reader.parquet(path) if fmt == "parquet" else reader.option("multiLine", fmt == "json_array").json(path)
    if edges.where("edge_seq is null").isEmpty():
        return edges
    # A block is read by one task, top down.
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return with_position(edges.withColumn("_place", place), "_place", "_found").withColumn(
        "edge_seq", F.coalesce("edge_seq", "_found")).select(*EDGE.names)


def write_edges(edges: DataFrame, path: str, fmt: str = "parquet") -> None:
    edges.write.mode("errorifexists").format(fmt).save(path)


def clip_edges_job(spark: SparkSession, source: str, target: str, box, fmt: str = "parquet") -> DataFrame:
    """Clip the full map at ``source`` into a new place, so every clip starts from the full map."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("the full map is never overwritten: choose another target")
    write_edges(clip_edges(read_edges(spark, source, fmt), box), target, fmt)
    return read_edges(spark, target, fmt)
