"""Edge speeds by window, published edge state, blocked edges, occupancy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet import schemas as S
from wayfleet.functions import scalars as X


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last write per key.  Rows are reduced before the shuffle, so a hot key costs nothing extra."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_kept"))
            .select(*keys, "_kept.*").select(*df.columns))


# ---- pings --------------------------------------------------------------
def keep_entities(pings: DataFrame, kinds: tuple[str, ...] = ("Truck", "Bot")) -> DataFrame:
    return pings.filter(F.col("entity_type").isin(*kinds))


def with_coordinates(pings: DataFrame) -> DataFrame:
    return pings.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def with_event_time(pings: DataFrame) -> DataFrame:
    return pings.withColumn("event_time", F.timestamp_millis("timestamp"))


def clean_pings(pings: DataFrame) -> DataFrame:
    return with_event_time(with_coordinates(keep_entities(pings)))


def archive_rows(matched: DataFrame) -> DataFrame:
    """The columns kept in the raw archive."""
    return matched.select("entity_id", "entity_type", "latitude", "longitude", "speed",
                          "timestamp", "event_time", "edge_id")


def _newest(names: tuple[str, ...], order: list[str]) -> list[Column]:
    """Each column of the newest row.

    By one column, every maximum has fixed width and picks the same row, so the
    hash aggregation keeps its buffers in place; a tie-break needs a struct.
    """
    if len(order) == 1:
        return [F.max_by(n, order[0]).alias(n) for n in names]
    return [F.max_by(n, F.struct(*order)).alias(n) for n in names]


def latest_positions(pings: DataFrame, kinds: tuple[str, ...] = ("Truck",),
                     tiebreak: str | None = None) -> DataFrame:
    """Newest position per vehicle; of equally new ones that of ``tiebreak``, or the greatest."""
    order = ["timestamp", tiebreak] if tiebreak else ["timestamp", "latitude", "longitude", "speed"]
    rows = keep_entities(pings, kinds)
    newest = rows.groupBy("entity_id").agg(*_newest(("latitude", "longitude", "speed"), order))
    return newest.select(F.col("entity_id").alias("id"), F.col("latitude").alias("lat"),
                         F.col("longitude").alias("lon"), "speed")


def conflate_positions(pings: DataFrame, every: str = "1 second", kinds: tuple[str, ...] = ("Truck",)) -> DataFrame:
    """Per tick, the newest position of every vehicle that moved in it; of equally new ones the greatest.  Batch or stream."""
    return (keep_entities(pings, kinds)
            .groupBy(F.window("event_time", every).alias("_tick"), "entity_id")
            .agg(*_newest(("latitude", "longitude", "speed"), ["timestamp", "latitude", "longitude", "speed"]))
            .select(F.col("_tick.end").alias("tick"), F.col("entity_id").alias("id"),
                    F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "speed"))


# ---- windows ------------------------------------------------------------
def edge_speed(matched: DataFrame, length: str = S.WINDOW_LENGTH, slide: str = S.WINDOW_SLIDE,
               distinct_vehicles: bool = False) -> DataFrame:
    """Mean speed and ping count per sliding window and edge.  Batch or stream.

    Doubles are summed in whatever order tasks finish; nine decimals are kept so
    that the mean, and every threshold on it, comes out the same each time.
    """
    measures = [F.round(F.avg("speed"), 9).alias("avg_speed"), F.count("entity_id").alias("vehicle_count")]
    if distinct_vehicles:
        measures.append((F.approx_count_distinct if matched.isStreaming else F.count_distinct)("entity_id")
                        .alias("distinct_vehicles"))
    return (matched.groupBy(F.window("event_time", length, slide).alias("_w"), "edge_id")
            .agg(*measures)
            .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "edge_id",
                    *[m for m in ("avg_speed", "vehicle_count")],
                    *(["distinct_vehicles"] if distinct_vehicles else [])))


def enrich_edges(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Length, speed limit and road name by edge id, with defaults for unknown edges."""
    facts = edges.select("edge_id", F.col("length_meters").alias("_length"),
                         F.col("max_speed_kmh").alias("_limit"),
                         F.coalesce("road_name", F.lit(S.UNNAMED_ROAD)).alias("_name"))
    return (rows.join(facts, "edge_id", "left")
            .withColumn("edge_length_m", F.coalesce("_length", F.lit(S.DEFAULT_EDGE_LENGTH_M)))
            .withColumn("edge_max_speed", F.coalesce("_limit", F.lit(S.DEFAULT_MAX_SPEED_KMH)))
            .withColumn("road_name", F.coalesce("_name", F.lit(S.UNKNOWN_EDGE)))
            .drop("_length", "_limit", "_name"))


def publishable(windows: DataFrame) -> DataFrame:
    """Known edges with a positive mean; a fully stopped edge is not published."""
    return windows.filter((F.col("edge_id") != S.UNKNOWN_EDGE) & (F.col("avg_speed") > 0))


def edge_state_rows(enriched: DataFrame) -> DataFrame:
    """Published payload per (edge, window)."""
    return enriched.select(
        "edge_id",
        F.round("avg_speed", 2).alias("avg_speed"),
        "vehicle_count",
        F.round("edge_length_m", 1).alias("distance"),
        F.round("edge_max_speed", 1).alias("max_speed"),
        F.round(X.travel_time_s("edge_length_m", "avg_speed"), 2).alias("estimated_travel_time"),
        X.is_congested("avg_speed").alias("is_congested"),
        X.iso_text("window_end").alias("updated_at"),
        X.epoch_ms("window_end").alias("last_updated"),
    )


def edge_state(matched: DataFrame, edges: DataFrame) -> DataFrame:
    """Windows to published state rows: aggregate, drop, enrich, format."""
    return edge_state_rows(enrich_edges(publishable(edge_speed(matched)), edges))


# ---- current state ------------------------------------------------------
def latest_edge_state(states: DataFrame) -> DataFrame:
    """Newest published window per edge, whatever order the rows arrived in."""
    return latest_by(states, ["edge_id"], ["last_updated"])


def unexpired(as_of_ms: int | Column, ttl_seconds: int = S.STATE_TTL_SECONDS) -> Column:
    as_of = F.lit(as_of_ms) if isinstance(as_of_ms, int) else as_of_ms
    return as_of < F.col("last_updated") + ttl_seconds * 1000


def live_edge_state(states: DataFrame, as_of_ms: int | Column) -> DataFrame:
    """Newest state per edge that has not yet expired at ``as_of_ms``."""
    return latest_edge_state(states).filter(unexpired(as_of_ms))


def blocked_edges(states: DataFrame, expire_at_ms: int | None = None) -> DataFrame:
    """Edges whose newest published state is congested; they stay blocked unless ``expire_at_ms`` is given."""
    latest = latest_edge_state(states)
    if expire_at_ms is not None:
        latest = latest.filter(unexpired(expire_at_ms))
    return latest.filter("is_congested").select("edge_id")


def state_of(states: DataFrame, edge_id: str) -> DataFrame:
    """Point read; the filter reaches the scan."""
    return latest_edge_state(states.filter(F.col("edge_id") == edge_id))


# ---- occupancy ----------------------------------------------------------
def edge_occupancy(latest_matched: DataFrame, edges: DataFrame) -> DataFrame:
    """Vehicles now on each edge, with density, expected speed and capacity."""
    counted = (latest_matched.filter(F.col("edge_id") != S.UNKNOWN_EDGE)
               .groupBy("edge_id").agg(F.count(F.lit(1)).alias("vehicles")))
    facts = edges.select("edge_id", "length_meters", "max_speed_kmh")
    return (counted.join(facts, "edge_id")
            .withColumn("density", X.density_per_km("vehicles", "length_meters"))
            .withColumn("expected_speed", X.expected_speed("max_speed_kmh", "density"))
            .withColumn("capacity", X.edge_capacity("length_meters"))
            .withColumn("at_capacity", F.col("vehicles") >= F.col("capacity")))
