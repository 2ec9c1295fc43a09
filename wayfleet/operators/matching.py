"""Map matching of pings to road edges, and nearest road nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet import schemas as S
from wayfleet.functions import geo
from wayfleet.operators.nearest import NearestIndex, attach_nearest, build_index
from wayfleet.operators.network import valid_edges


def edge_index(edges: DataFrame, **options) -> NearestIndex:
    """Index of road edges by distance to the segment."""
    shapes = valid_edges(edges).select(
        F.col("edge_seq").alias("seq"), F.col("edge_id").alias("id"),
        F.col("start_node.lat").alias("a_lat"), F.col("start_node.lon").alias("a_lon"),
        F.col("end_node.lat").alias("b_lat"), F.col("end_node.lon").alias("b_lon"))
    return build_index(shapes, "road", **options)


def node_index(nodes: DataFrame, **options) -> NearestIndex:
    """Index of road nodes by squared degree distance."""
    shapes = nodes.filter("lat is not null and lon is not null").select(
        F.col("node_seq").alias("seq"), F.col("node_id").alias("id"),
        F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"),
        F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"))
    return build_index(shapes, "planar", **options)


def match_pings(pings: DataFrame, index: NearestIndex, salts: int = 1,
                with_distance: bool = False) -> DataFrame:
    """Add the nearest ``edge_id``; ``UNKNOWN`` without coordinates or without a network."""
    base = pings.drop("edge_id")
    found = attach_nearest(base, index, "latitude", "longitude", "_hit", salts)
    columns = [*base.columns, F.coalesce("_hit.id", F.lit(S.UNKNOWN_EDGE)).alias("edge_id")]
    if with_distance:
        columns.append(geo.metres_from_h(F.col("_hit.rank")).alias("match_distance_m"))
    return found.select(*columns)


def nearest_node(points: DataFrame, index: NearestIndex, lat: str = "latitude", lon: str = "longitude",
                 out: str = "node_id", salts: int = 1) -> DataFrame:
    """Add the nearest road node's id; null without coordinates or nodes."""
    found = attach_nearest(points, index, lat, lon, "_hit", salts)
    return found.withColumn(out, F.col("_hit.id")).drop("_hit")


def with_outgoing(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Only the nodes a vehicle can leave, for matching that must not end in a sink."""
    return nodes.join(edges.select(F.col("start_node.node_id").alias("node_id")), "node_id", "left_semi")
