"""Road network preparation: ways to directed edges, nodes, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfleet import schemas as S
from wayfleet.functions import geo
from wayfleet.functions import scalars as X
from wayfleet.session import cut

# (position, direction) of a way's edges stay below this stride; a longer way is refused, not numbered twice.
SEQ_PER_WAY = 1 << 21


# ---- ways and tags ------------------------------------------------------
def _last_tag(key: str, usable=None) -> Column:
    """Value of the last tag with this key, among usable values only."""
    def keep(tag):
        hit = tag["_k"] == key
        return hit & usable(tag["_v"]) if usable else hit
    return F.try_element_at(F.filter("tags", keep), F.lit(-1))["_v"]


def read_way_tags(ways: DataFrame) -> DataFrame:
    """Typed attributes from ``tags``; an unparsable speed counts as absent."""
    speed = _last_tag("maxspeed", lambda v: v.try_cast("double").isNotNull()).try_cast("double")
    return ways.select(
        "way_id", "refs",
        _last_tag("highway").alias("highway"),
        F.coalesce(_last_tag("oneway"), F.lit("no")).alias("oneway"),
        F.coalesce(_last_tag("name"), F.lit(S.UNNAMED_ROAD)).alias("road_name"),
        F.coalesce(speed, F.lit(S.DEFAULT_MAX_SPEED_KMH)).alias("max_speed_kmh"),
    )


def drivable(ways: DataFrame) -> DataFrame:
    return ways.filter(F.col("highway").isin(*S.HIGHWAY_CLASSES))


def way_segments(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Consecutive node pairs with coordinates; pairs with a missing node or no length are dropped."""
    last = F.greatest(F.size("refs") - 1, F.lit(0))
    pairs = ways.select(
        "way_id", "oneway", "road_name", "max_speed_kmh",
        F.posexplode(F.arrays_zip(F.slice("refs", F.lit(1), last).alias("u"),
                                  F.slice("refs", F.lit(2), last).alias("v"))).alias("pos", "pair"),
    ).select("way_id", "pos", "oneway", "road_name", "max_speed_kmh",
             F.col("pair.u").alias("u"), F.col("pair.v").alias("v"))
    u = nodes.select(F.col("node_id").alias("u"), F.col("lat").alias("u_lat"), F.col("lon").alias("u_lon"))
    v = nodes.select(F.col("node_id").alias("v"), F.col("lat").alias("v_lat"), F.col("lon").alias("v_lon"))
    return (pairs.join(u, "u").join(v, "v")
            .withColumn("raw_length_m", geo.haversine_m("u_lat", "u_lon", "v_lat", "v_lon"))
            .filter("raw_length_m > 0"))


def _checked_position() -> Column:
    too_long = F.raise_error(F.concat(F.lit("way with too many nodes: "), F.col("way_id").cast("string")))
    return F.when(F.col("pos") < SEQ_PER_WAY // 2, F.col("pos")).otherwise(too_long.cast("int"))


def segment_ways(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Directed edges: ``yes`` keeps the way's direction, ``-1`` turns it, anything else gives both."""
    segments = way_segments(drivable(ways), nodes)
    directions = (F.when(F.col("oneway") == "yes", F.array(F.lit(0)))
                  .when(F.col("oneway") == "-1", F.array(F.lit(1)))
                  .otherwise(F.array(F.lit(0), F.lit(1))))
    directed = segments.withColumn("direction", F.explode(directions))
    forward = F.col("direction") == 0

    def node(first: str, second: str) -> Column:
        pick = lambda suffix: F.when(forward, F.col(first + suffix)).otherwise(F.col(second + suffix))
        return F.struct(pick("").alias("node_id"), pick("_lat").alias("lat"), pick("_lon").alias("lon"))

    return directed.select(
        (F.col("way_id") * SEQ_PER_WAY + _checked_position() * 2 + F.col("direction")).cast("long").alias("edge_seq"),
        node("u", "v").alias("start_node"),
        node("v", "u").alias("end_node"),
        "road_name", "max_speed_kmh",
        F.round("raw_length_m", 2).alias("length_meters"),
    ).select(
        "edge_seq", X.edge_key("start_node.node_id", "end_node.node_id").alias("edge_id"),
        "road_name", "max_speed_kmh", "start_node", "end_node", "length_meters",
    )


# ---- edge tables --------------------------------------------------------
def valid_edges(edges: DataFrame) -> DataFrame:
    """Edges with an id and both end positions."""
    return edges.filter(
        (F.col("edge_id").isNotNull()) & (F.col("edge_id") != "")
        & F.col("start_node.lat").isNotNull() & F.col("start_node.lon").isNotNull()
        & F.col("end_node.lat").isNotNull() & F.col("end_node.lon").isNotNull())


def dedupe_edges(edges: DataFrame) -> DataFrame:
    """One row per edge id: the last definition wins."""
    rest = [c for c in edges.columns if c != "edge_id"]
    return (edges.groupBy("edge_id")
            .agg(F.max_by(F.struct(*rest), "edge_seq").alias("kept"))
            .select("edge_id", "kept.*").select(*edges.columns))


def clip_edges(edges: DataFrame, box: str | tuple[float, float, float, float]) -> DataFrame:
    """Edges with both ends inside the (inclusive) box, given by name or corners."""
    lat0, lat1, lon0, lon1 = S.DISTRICT_BOXES[box] if isinstance(box, str) else box
    return edges.filter(
        F.col("start_node.lat").between(lat0, lat1) & F.col("start_node.lon").between(lon0, lon1)
        & F.col("end_node.lat").between(lat0, lat1) & F.col("end_node.lon").between(lon0, lon1))


def edge_ids(edges: DataFrame) -> DataFrame:
    return edges.select("edge_id").distinct()


def has_edges(edges: DataFrame) -> bool:
    return not edges.isEmpty()


def nodes_of(edges: DataFrame) -> DataFrame:
    """Nodes in order of first mention; a repeated node keeps its last position."""
    def side(name: str, offset: int) -> DataFrame:
        return edges.select(F.col(f"{name}.node_id").alias("node_id"),
                            F.struct(f"{name}.lat", f"{name}.lon").alias("place"),
                            (F.col("edge_seq") * 2 + offset).alias("mention"))
    return (side("start_node", 0).unionByName(side("end_node", 1))
            .groupBy("node_id")
            .agg(F.min("mention").alias("node_seq"), F.max_by("place", "mention").alias("place"))
            .select("node_seq", "node_id", F.col("place.lat").alias("lat"), F.col("place.lon").alias("lon")))


def graph_tables(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the graph with defaults filled; one row per edge id."""
    clean = dedupe_edges(edges).select(
        "edge_seq", "edge_id",
        F.coalesce("road_name", F.lit(S.UNKNOWN_EDGE)).alias("road_name"),
        F.coalesce("max_speed_kmh", F.lit(S.DEFAULT_MAX_SPEED_KMH)).alias("max_speed_kmh"),
        "start_node", "end_node",
        F.coalesce("length_meters", F.lit(1.0)).alias("length_meters"))
    return nodes_of(edges), clean


def adjacency(edges: DataFrame) -> DataFrame:
    """Outgoing neighbours as rows; a node without any keeps one row of nulls.

    A relation rather than a list per node, so a hub of any size stays spread.
    """
    out = edges.select(F.col("start_node.node_id").alias("node_id"), "edge_id",
                       F.col("end_node.node_id").alias("to_node"))
    return nodes_of(edges).select("node_id").join(out, "node_id", "left")


def edge_endpoints(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """Start and end node per edge id; null for an unknown edge."""
    ends = edges.select("edge_id", F.col("start_node.node_id").alias("start_id"),
                        F.col("end_node.node_id").alias("end_id"))
    return ids.join(ends, "edge_id", "left")


# ---- numbering ----------------------------------------------------------
def with_position(df: DataFrame, order_col: str, name: str = "position") -> DataFrame:
    """Zero-based rank over the whole table by a unique column, without a one-task sort.

    Rows are range-partitioned and written once; each range is then numbered on
    its own and shifted by the size of the ranges before it.
    """
    ranged = cut(df.repartitionByRange(order_col).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range, so a single task sees at most the partition count.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_range").orderBy(order_col)
    return (ranged.withColumn("_local", F.row_number().over(inside) - 1)
            .join(shifts, "_range")
            .withColumn(name, (F.col("_local") + F.col("_shift")).cast("long"))
            .drop("_range", "_local", "_shift"))


# ---- components ---------------------------------------------------------
def connected_components(edges: DataFrame) -> DataFrame:
    """Weakly connected components: (node_id, component), named by the smallest node id."""
    return components_of_links(edges.select(F.col("start_node.node_id").alias("a"), F.col("end_node.node_id").alias("b")))


def components_of_links(arcs: DataFrame, max_rounds: int = 200, lanes: int = 16) -> DataFrame:
    """(node_id, component) over links (a, b), taken in both directions; named by the smallest node id.

    Alternating stars: each node first hands its larger neighbours to the least node it
    knows, then its smaller ones. Rounds grow with the logarithm of the longest chain. A node
    that many point at would be one hot key: its links are dealt to ``lanes`` by a hash of the
    other end, and the least neighbour, combined before the shuffle, goes to every lane.
    """
    nodes = arcs.select(F.col("a").alias("node_id")).unionByName(arcs.select(F.col("b").alias("node_id"))).distinct()
    links = cut(arcs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(max_rounds):
        # Settled: every node points at one smaller node, which points at none.
        if links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty() and \
                links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            return nodes.join(links, F.col("node_id") == F.col("a"), "left").select("node_id", F.coalesce("b", "node_id").alias("component"))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = cut(_star(both, lanes).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct(), "links")
        pointed = _star(links, lanes)
        links = cut(pointed.select(F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b"))
                    .where("a <> b").distinct(), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _star(links: DataFrame, lanes: int) -> DataFrame:
    """The links (a, b) with the least node that a or its neighbours are."""
    least = links.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("least"),
                                                                       F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("_lane"))
    return links.withColumn("_lane", F.pmod(F.xxhash64("b"), F.lit(lanes)).cast("int")).join(least, ["a", "_lane"]).drop("_lane")


def largest_component(edges: DataFrame) -> DataFrame:
    """Edges that start in the component with most nodes (smallest name on a tie)."""
    parts = cut(connected_components(edges), "components")
    biggest = (parts.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
               .agg(F.min_by("component", F.struct((-F.col("n")).alias("n"), "component")).alias("component")))
    members = parts.join(biggest, "component", "left_semi").select("node_id")
    return edges.join(members, F.col("start_node.node_id") == F.col("node_id"), "left_semi")
