"""Row types and fixed values shared by the operators."""

from pyspark.sql import types as T

# ---- fixed values -------------------------------------------------------
HIGHWAY_CLASSES = (
    "motorway", "motorway_link", "trunk", "trunk_link",
    "primary", "primary_link", "secondary", "secondary_link",
    "tertiary", "tertiary_link", "unclassified", "residential",
)
UNNAMED_ROAD = "Đường không tên"
UNKNOWN_EDGE = "UNKNOWN"
DEFAULT_MAX_SPEED_KMH = 40.0
DEFAULT_EDGE_LENGTH_M = 500.0
DEFAULT_FLEET_SPEED_KMH = 30.0

# Three congestion thresholds that differ on purpose.
STATE_CONGESTED_BELOW_KMH = 5.0      # strict, set on the published edge state
REROUTE_AT_OR_BELOW_KMH = 5.0        # inclusive, and only above zero
SLOW_CLASS_AT_OR_BELOW_KMH = 5.0     # inclusive, display class
MEDIUM_CLASS_AT_OR_BELOW_KMH = 15.0

BLOCKED_ROUTE_PENALTY = 1_000_000.0
CONGESTED_EDGE_PENALTY = 10_000.0
INVALID_ORDER_FITNESS = 1_000_000.0

JAM_DENSITY_PER_KM = 250.0
CRAWL_SPEED_KMH = 2.5

WINDOW_LENGTH = "10 seconds"
WINDOW_SLIDE = "3 seconds"
WATERMARK_DELAY = "10 seconds"
WATERMARK_DELAY_MS = 10_000
STATE_TTL_SECONDS = 120

# Inclusive boxes: (min_lat, max_lat, min_lon, max_lon).
DISTRICT_BOXES = {
    "DongDa": (21.0000, 21.0320, 105.8000, 105.8450),
    "BaDinh": (21.0170, 21.0480, 105.7960, 105.8500),
}

# ---- row types ----------------------------------------------------------
PING = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("entity_type", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

PING_EXTRAS = T.StructType(PING.fields + [
    T.StructField("edge_id", T.StringType()),
    T.StructField("route_index", T.IntegerType()),
    T.StructField("route_total", T.IntegerType()),
])

EDGE_NODE = T.StructType([
    T.StructField("node_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

EDGE = T.StructType([
    T.StructField("edge_seq", T.LongType()),
    T.StructField("edge_id", T.StringType()),
    T.StructField("road_name", T.StringType()),
    T.StructField("max_speed_kmh", T.DoubleType()),
    T.StructField("start_node", EDGE_NODE),
    T.StructField("end_node", EDGE_NODE),
    T.StructField("length_meters", T.DoubleType()),
])

CUSTOMER = T.StructType([
    T.StructField("cust_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

OPTIMIZATION_RESULT = T.StructType([
    T.StructField("old_assigned_route", T.ArrayType(T.StringType())),
    T.StructField("new_assigned_route", T.ArrayType(T.StringType())),
    T.StructField("optimized_customer_order", T.ArrayType(T.StringType())),
    T.StructField("fitness", T.DoubleType()),
    T.StructField("estimated_total_travel_time", T.DoubleType()),
    T.StructField("generation_count", T.IntegerType()),
    T.StructField("algorithm", T.StringType()),
])

VEHICLE = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("entity_type", T.StringType()),
    T.StructField("edge_id", T.StringType()),
    T.StructField("current_edge_id", T.StringType()),
    T.StructField("distance_on_edge", T.DoubleType()),
    T.StructField("assigned_route", T.ArrayType(T.StringType())),
    T.StructField("remaining_customers", T.ArrayType(CUSTOMER)),
    T.StructField("new_assigned_route", T.ArrayType(T.StringType())),
    T.StructField("estimated_total_travel_time", T.DoubleType()),
    T.StructField("route_status", T.StringType()),
    T.StructField("optimized_customer_order", T.ArrayType(T.StringType())),
    T.StructField("last_optimized_at", T.LongType()),
    T.StructField("optimization_result", OPTIMIZATION_RESULT),
])

EDGE_STATE = T.StructType([
    T.StructField("edge_id", T.StringType()),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("vehicle_count", T.LongType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("max_speed", T.DoubleType()),
    T.StructField("estimated_travel_time", T.DoubleType()),
    T.StructField("is_congested", T.BooleanType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("last_updated", T.LongType()),
])

OSM_NODE = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("_lat", T.DoubleType()),
    T.StructField("_lon", T.DoubleType()),
])

OSM_WAY = T.StructType([
    T.StructField("_id", T.LongType()),
    T.StructField("nd", T.ArrayType(T.StructType([T.StructField("_ref", T.StringType())]))),
    T.StructField("tag", T.ArrayType(T.StructType([
        T.StructField("_k", T.StringType()),
        T.StructField("_v", T.StringType()),
    ]))),
])
