"""Serving views: routes, traffic feed, progress along a route, heat points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfleet.functions import geo
from wayfleet.functions import scalars as X
from wayfleet.operators.network import with_position
from wayfleet.operators.traffic import latest_by

SAME_POINT_DEGREES = 0.0001
HEAT_ABOVE = 0.1


# ---- routes -------------------------------------------------------------
def effective_route(vehicles: DataFrame) -> DataFrame:
    """The new route where there is one, else the assigned one."""
    empty = F.array().cast("array<string>")
    old = F.coalesce("assigned_route", empty)
    new = F.coalesce("new_assigned_route", empty)
    return vehicles.select("vehicle_id", old.alias("old_path"), new.alias("new_path"),
                           F.when(F.size(new) > 0, new).otherwise(old).alias("path"),
                           F.col("estimated_total_travel_time").alias("time"))


def route_snapshot(vehicles: DataFrame) -> DataFrame:
    named = vehicles.filter(F.col("vehicle_id").isNotNull() & (F.col("vehicle_id") != ""))
    return effective_route(named).filter(F.size("path") > 0)


def merge_routes(updates: DataFrame, order: str = "update_seq") -> DataFrame:
    """Current route per vehicle; a last update with an empty path removes the vehicle."""
    named = updates.filter(F.col("vehicle_id").isNotNull() & (F.col("vehicle_id") != ""))
    return latest_by(named, ["vehicle_id"], [order]).filter(F.size("path") > 0)


def search_routes(routes: DataFrame, text: str) -> DataFrame:
    query = text.strip().lower()
    return routes.filter(F.contains(F.lower("vehicle_id"), F.lit(query))) if query else routes


def order_vehicles(rows: DataFrame, id_col: str = "vehicle_id") -> DataFrame:
    """Sorted by the number in the id, then the id: a range-partitioned sort."""
    return rows.orderBy(X.number_in_id(id_col), id_col)


def numbered_vehicles(rows: DataFrame, id_col: str = "vehicle_id") -> DataFrame:
    """Each row's ``place`` from 0 in the order of ``order_vehicles``, without a one-task sort."""
    keyed = rows.withColumn("_key", F.struct(X.number_in_id(id_col), F.col(id_col)))
    return with_position(keyed, "_key", "place").drop("_key")


def vehicle_board(positions: DataFrame, routes: DataFrame) -> DataFrame:
    """Vehicles with labels, and whether and how long a route they have."""
    sized = routes.select(F.col("vehicle_id").alias("id"), F.size("path").alias("path_size"), F.col("time").alias("_time"))
    return (positions.join(sized, "id", "left")
            .select("id", X.short_truck_id("id").alias("short_id"), X.display_speed("speed").alias("shown_speed"),
                    F.col("path_size").isNotNull().alias("has_route"), F.coalesce("path_size", F.lit(0)).alias("path_size"),
                    X.eta_text("_time").alias("eta")))


def board_counts(positions: DataFrame, routes: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Headline counts as rows (name, n)."""
    out = None
    for name, rows in (("vehicles", positions), ("routes", routes), ("nodes", nodes), ("edges", edges)):
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


# ---- traffic ------------------------------------------------------------
def traffic_feed(state: DataFrame) -> DataFrame:
    speed = F.coalesce("avg_speed", F.lit(0.0))
    return state.select(X.without_edge_prefix("edge_id").alias("edge_id"),
                        F.when(F.isnan(speed), F.lit(0.0)).otherwise(speed).alias("avg_speed"))


def _midpoints(edges: DataFrame) -> DataFrame:
    return edges.select("edge_id", geo.midpoint("start_node.lat", "end_node.lat").alias("mid_lat"),
                        geo.midpoint("start_node.lon", "end_node.lon").alias("mid_lon"))


def heat_points(traffic: DataFrame, edges: DataFrame) -> DataFrame:
    return (traffic.join(_midpoints(edges), "edge_id")
            .select("edge_id", "mid_lat", "mid_lon", X.heat_intensity("avg_speed").alias("intensity"))
            .filter(F.col("intensity") > HEAT_ABOVE))


def edge_speed_class(edges: DataFrame, traffic: DataFrame) -> DataFrame:
    """Every edge with its display class; ``none`` without data."""
    return (edges.select("edge_id").join(traffic.select("edge_id", "avg_speed"), "edge_id", "left")
            .withColumn("speed_class", X.speed_class("avg_speed")))


# ---- geometry along a route ---------------------------------------------
def route_geometry(routes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per known edge of a path, in path order; unknown ids are skipped."""
    steps = routes.select("vehicle_id", F.posexplode("path").alias("pos", "edge_id"))
    shapes = edges.select("edge_id", F.col("start_node.lat").alias("start_lat"), F.col("start_node.lon").alias("start_lon"),
                          F.col("end_node.lat").alias("end_lat"), F.col("end_node.lon").alias("end_lon"))
    return steps.join(shapes, "edge_id")


def route_segments(geometry: DataFrame) -> DataFrame:
    """Continuous pieces of each route: a jump in lat or lon starts a new piece.

    A vehicle's rows come from the path array of its own document.
    """
    along = Window.partitionBy("vehicle_id").orderBy("pos")
    last_lat, last_lon = F.lag("end_lat").over(along), F.lag("end_lon").over(along)
    apart = ((F.abs(last_lat - F.col("start_lat")) >= SAME_POINT_DEGREES)
             | (F.abs(last_lon - F.col("start_lon")) >= SAME_POINT_DEGREES))
    begins = F.when(last_lat.isNull() | apart, 1).otherwise(0)
    marked = geometry.withColumn("_begins", begins)
    numbered = marked.withColumn("segment_no", F.sum("_begins").over(
        along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (numbered.groupBy("vehicle_id", "segment_no")
            .agg(F.array_sort(F.collect_list(F.struct(
                "pos", "edge_id", "start_lat", "start_lon", "end_lat", "end_lon"))).alias("legs"))
            .select("vehicle_id", "segment_no", F.col("legs.edge_id").alias("edge_ids"),
                    F.concat(
                        F.array(F.struct(F.col("legs")[0]["start_lat"].alias("lat"), F.col("legs")[0]["start_lon"].alias("lon"))),
                        F.transform("legs", lambda g: F.struct(g["end_lat"].alias("lat"), g["end_lon"].alias("lon"))),
                    ).alias("points")))


def route_progress(routes: DataFrame, edges: DataFrame, positions: DataFrame) -> DataFrame:
    """Where each vehicle is on its path (edge with the nearest midpoint), and the path split there."""
    at = positions.select(F.col("id").alias("vehicle_id"), "lat", "lon")
    known = (routes.select("vehicle_id", F.posexplode("path").alias("pos", "edge_id"))
             .join(_midpoints(edges), "edge_id").join(at.filter("lat is not null and lon is not null"), "vehicle_id"))
    nearest = (known.groupBy("vehicle_id")
               .agg(F.min(F.struct(geo.planar_d2("mid_lat", "mid_lon", "lat", "lon").alias("d2"), "pos")).alias("_n"))
               .select("vehicle_id", F.col("_n.pos").alias("progress")))
    placed = at.filter("lat is not null and lon is not null").select("vehicle_id", F.lit(0).alias("_zero"))
    joined = (routes.select("vehicle_id", "path").join(placed, "vehicle_id", "left").join(nearest, "vehicle_id", "left")
              .withColumn("progress", F.coalesce("progress", "_zero")))
    traversed, upcoming = X.split_path("path", "progress")
    return joined.select("vehicle_id", "progress", traversed.alias("traversed"), upcoming.alias("upcoming"))


def route_bounds(geometry: DataFrame, positions: DataFrame) -> DataFrame:
    """Extent of each route's points together with the vehicle's position."""
    points = (geometry.select("vehicle_id", F.col("start_lat").alias("lat"), F.col("start_lon").alias("lon"))
              .unionByName(geometry.select("vehicle_id", F.col("end_lat").alias("lat"), F.col("end_lon").alias("lon")))
              .unionByName(positions.select(F.col("id").alias("vehicle_id"), "lat", "lon")))
    return (points.filter("lat is not null and lon is not null").groupBy("vehicle_id")
            .agg(F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
                 F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon")))


# ---- on-demand requests -------------------------------------------------
def resolve_request_stops(requests: DataFrame, vehicles: DataFrame) -> DataFrame:
    """The request's own customers, else the stored ones; ``error`` says why there is no route.

    ``requests``: (vehicle_id, lat, lon, customers).
    """
    stored = vehicles.select("vehicle_id", F.col("remaining_customers").alias("_stored"))
    own = F.size(F.coalesce("customers", F.array().cast("array<struct<cust_id:string,latitude:double,longitude:double>>"))) > 0
    joined = requests.join(stored, "vehicle_id", "left").withColumn(
        "customers", F.when(own, F.col("customers")).otherwise(F.col("_stored"))).drop("_stored")
    missing = F.col("vehicle_id").isNull() | (F.col("vehicle_id") == "") | F.col("lat").isNull() | F.col("lon").isNull()
    return joined.withColumn("error", F.when(missing, F.lit("Missing lat/lon")).when(
        F.coalesce(F.size("customers"), F.lit(0)) <= 0, F.lit("No customers")))
