"""Re-routing: inputs, triggers, stop order, new routes, results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfleet import schemas as S
from wayfleet.functions import geo
from wayfleet.functions import scalars as X
from wayfleet.operators import genetic, routing, subsets
from wayfleet.operators.matching import nearest_node
from wayfleet.operators.nearest import NearestIndex
from wayfleet.operators.network import with_position
from wayfleet.session import cut, ship_package, task_count

EXACT_STOPS = 15
ROUTE_SPAN = 6
STRIDE = 13
EMPTY_ROUTE = "array<string>"
EMPTY_STOPS = "array<struct<cust_id:string,latitude:double,longitude:double>>"


# ---- vehicle documents --------------------------------------------------
def normalize_vehicles(docs: DataFrame) -> DataFrame:
    """Typed documents: aliases resolved, empty ids and nameless customers dropped."""
    def either(a: str, b: str) -> Column:
        return F.coalesce(X.non_empty(a), X.non_empty(b), F.lit(""))

    customers = F.transform(
        F.filter(F.coalesce("remaining_customers", F.array().cast(EMPTY_STOPS)),
                 lambda c: F.coalesce(c["cust_id"], F.lit("")) != ""),
        lambda c: F.struct(c["cust_id"].alias("cust_id"), X.to_float(c["latitude"]).alias("latitude"),
                           X.to_float(c["longitude"]).alias("longitude")))
    route = F.filter(F.coalesce("assigned_route", F.array().cast(EMPTY_ROUTE)),
                     lambda e: F.coalesce(e, F.lit("")) != "")
    extras = [c for c in ("new_assigned_route",) if c in docs.columns]
    return docs.select(
        either("vehicle_id", "entity_id").alias("vehicle_id"),
        either("entity_id", "vehicle_id").alias("entity_id"),
        X.to_str("entity_type", "Truck").alias("entity_type"),
        either("edge_id", "current_edge_id").alias("current_edge_id"),
        X.to_float("distance_on_edge").alias("distance_on_edge"),
        route.alias("assigned_route"), customers.alias("remaining_customers"), *extras)


def validate_inputs(inputs: DataFrame) -> DataFrame:
    """Adds ``error``: the first rule a row breaks, else null."""
    def missing(name: str) -> tuple[Column, str]:
        return F.col(name).isNull(), f"Missing field: {name}"

    rules = [missing(c) for c in ("vehicle_id", "entity_id", "entity_type", "current_edge_id",
                                  "assigned_route", "remaining_customers")]
    rules += [
        (F.col("vehicle_id") == "", "vehicle_id must not be empty"),
        (F.col("current_edge_id") == "", "current_edge_id must not be empty"),
        (F.exists("remaining_customers", lambda c: c["cust_id"].isNull()), "Each customer must have cust_id"),
        (F.exists("remaining_customers", lambda c: c["latitude"].isNull() | c["longitude"].isNull()),
         "Each customer must have latitude and longitude"),
    ]
    return inputs.withColumn("error", F.coalesce(*[F.when(broken, F.lit(text)) for broken, text in rules]))


def stops_of(vehicles: DataFrame) -> DataFrame:
    return vehicles.select("vehicle_id", F.posexplode("remaining_customers").alias("stop_idx", "c")).select(
        "vehicle_id", "stop_idx", "c.cust_id", "c.latitude", "c.longitude")


def seed_routes(edges: DataFrame, count: int) -> DataFrame:
    """Vehicle documents 1..count, each over a slice of consecutive edges starting 13 edges apart."""
    placed = cut(with_position(edges, "edge_seq", "_pos"), "placed")
    n = placed.count()
    span = min(ROUTE_SPAN, n)
    if span < 2:
        raise ValueError("the edge table is too short for a route")
    spark = edges.sparkSession
    wanted = (spark.range(1, count + 1).withColumnRenamed("id", "truck")
              .withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(span - 1))))
              .withColumn("_pos", ((F.col("truck") - 1) * STRIDE) % max(1, n - span) + F.col("_k")))
    picked = wanted.join(placed.select("_pos", "edge_id", F.col("start_node.lat").alias("lat"),
                                       F.col("start_node.lon").alias("lon")), "_pos")
    slices = picked.groupBy("truck").agg(F.array_sort(F.collect_list(F.struct("_k", "edge_id", "lat", "lon"))).alias("s"))
    located = F.filter(F.slice("s", 2, 3), lambda e: e["lat"].isNotNull() & e["lon"].isNotNull())
    customers = F.transform(F.when(F.size(located) > 0, located).otherwise(F.slice("s", 1, 1)), lambda e: F.struct(
        X.seed_customer_id(F.col("truck"), F.greatest(e["_k"], F.lit(1))).alias("cust_id"),
        e["lat"].alias("latitude"), e["lon"].alias("longitude")))
    first = F.col("s")[0]["edge_id"]
    name = X.truck_id("truck")
    return slices.select(
        name.alias("vehicle_id"), name.alias("entity_id"), F.lit("Truck").alias("entity_type"),
        first.alias("edge_id"), first.alias("current_edge_id"), F.lit(0.0).alias("distance_on_edge"),
        F.transform("s", lambda e: e["edge_id"]).alias("assigned_route"),
        customers.alias("remaining_customers"))


# ---- traffic seen by a vehicle ------------------------------------------
def relevant_edges(vehicles: DataFrame) -> DataFrame:
    """Distinct (vehicle_id, edge_id) of the current edge and the assigned route."""
    own = F.array_distinct(F.concat(F.array("current_edge_id"), F.col("assigned_route")))
    return vehicles.select("vehicle_id", F.explode(own).alias("edge_id")).filter("edge_id <> ''")


def traffic_snapshot(vehicles: DataFrame, state: DataFrame, blocked: DataFrame) -> DataFrame:
    """Known state of the edges each vehicle looks at.

    Blocked edges belong to every vehicle's snapshot; they are given once, with a
    null vehicle_id, instead of once per vehicle.
    """
    own = relevant_edges(vehicles).join(state, "edge_id")
    shared = blocked.select("edge_id").join(state, "edge_id")
    return own.select("vehicle_id", *state.columns).unionByName(
        shared.select(F.lit(None).cast("string").alias("vehicle_id"), *state.columns))


def snapshot_speed(vehicles: DataFrame, state: DataFrame, blocked: DataFrame,
                   default: float = S.DEFAULT_FLEET_SPEED_KMH) -> DataFrame:
    """Mean positive speed over own and blocked edges; ``default`` without any.

    The blocked part is the same for all vehicles, so it is summed once.  Nine
    decimals are kept, as the order of summation may change from run to run.
    """
    moving = state.filter("avg_speed > 0").select("edge_id", "avg_speed")
    free = moving.join(blocked.select("edge_id"), "edge_id", "left_anti")
    jammed = moving.join(blocked.select("edge_id"), "edge_id", "left_semi").agg(
        F.coalesce(F.sum("avg_speed"), F.lit(0.0)).alias("s"), F.count(F.lit(1)).alias("n")).first()
    own = (relevant_edges(vehicles).join(free, "edge_id").groupBy("vehicle_id")
           .agg(F.sum("avg_speed").alias("_s"), F.count(F.lit(1)).alias("_n")))
    total = F.coalesce("_s", F.lit(0.0)) + F.lit(float(jammed["s"]))
    number = F.coalesce("_n", F.lit(0)) + F.lit(int(jammed["n"]))
    return (vehicles.select("vehicle_id").join(own, "vehicle_id", "left")
            .select("vehicle_id", F.when(number > 0, F.round(total / number, 9)).otherwise(F.lit(default)).alias("speed_kmh")))


def route_conditions(vehicles: DataFrame, state: DataFrame, blocked: DataFrame,
                     limit: float = S.REROUTE_AT_OR_BELOW_KMH) -> DataFrame:
    """Per vehicle: does the assigned route hit blocked, congested or slow edges, and its penalty."""
    route = vehicles.select("vehicle_id", F.explode(F.array_distinct("assigned_route")).alias("edge_id"))
    marks = blocked.select("edge_id", F.lit(True).alias("_blocked"))
    live = state.select("edge_id", "avg_speed", "is_congested")
    slow = F.coalesce(X.triggers_reroute("avg_speed", limit), F.lit(False))
    jam = F.coalesce("is_congested", F.lit(False))
    seen = (route.join(marks, "edge_id", "left").join(live, "edge_id", "left")
            .groupBy("vehicle_id")
            .agg(F.bool_or(F.coalesce("_blocked", F.lit(False))).alias("hits_blocked"),
                 F.bool_or(jam).alias("hits_congested"), F.bool_or(slow).alias("hits_slow"),
                 F.sum(jam.cast("int") + slow.cast("int")).alias("_marks")))
    no = F.lit(False)
    return (vehicles.select("vehicle_id").join(seen, "vehicle_id", "left")
            .select("vehicle_id",
                    F.coalesce("hits_blocked", no).alias("hits_blocked"),
                    F.coalesce("hits_congested", no).alias("hits_congested"),
                    F.coalesce("hits_slow", no).alias("hits_slow"),
                    (F.coalesce(F.col("hits_blocked").cast("int"), F.lit(0)) * S.BLOCKED_ROUTE_PENALTY
                     + F.coalesce("_marks", F.lit(0)) * S.CONGESTED_EDGE_PENALTY).alias("penalty")))


def route_penalty(vehicles: DataFrame, state: DataFrame, blocked: DataFrame) -> DataFrame:
    return route_conditions(vehicles, state, blocked).select("vehicle_id", "penalty")


def reroute_candidates(vehicles: DataFrame, state: DataFrame, blocked: DataFrame,
                       limit: float = S.REROUTE_AT_OR_BELOW_KMH) -> DataFrame:
    """(vehicle_id, needs_reroute, reason); the first matching reason is given."""
    reason = (F.when(F.col("hits_blocked"), "blocked").when(F.col("hits_congested"), "congested")
              .when(F.col("hits_slow"), "slow"))
    return route_conditions(vehicles, state, blocked, limit).select(
        "vehicle_id", reason.isNotNull().alias("needs_reroute"), reason.alias("reason"))


def start_cost_h(vehicles: DataFrame, state: DataFrame) -> DataFrame:
    """Live travel time of the current edge in hours, 0 if unknown."""
    live = state.select(F.col("edge_id").alias("current_edge_id"), F.col("estimated_travel_time").alias("_t"))
    return (vehicles.select("vehicle_id", "current_edge_id").join(live, "current_edge_id", "left")
            .select("vehicle_id", F.when(F.col("_t") > 0, F.col("_t") / 3600.0).otherwise(F.lit(0.0)).alias("start_cost")))


def order_facts(vehicles: DataFrame, state: DataFrame, blocked: DataFrame) -> DataFrame:
    """What scoring an order needs: stops, speed, start cost and penalty per vehicle."""
    return (vehicles.select("vehicle_id", F.col("remaining_customers").alias("stops"))
            .join(snapshot_speed(vehicles, state, blocked), "vehicle_id")
            .join(start_cost_h(vehicles, state), "vehicle_id")
            .join(route_penalty(vehicles, state, blocked), "vehicle_id"))


def optimization_inputs(docs: DataFrame, state: DataFrame, blocked: DataFrame, now_ms: int) -> DataFrame:
    """Normalized vehicles with a request key, order facts and the validation error."""
    vehicles = normalize_vehicles(docs)
    facts = order_facts(vehicles, state, blocked).drop("stops")
    return (validate_inputs(vehicles).join(facts, "vehicle_id")
            .withColumn("request_id", X.request_key("vehicle_id", F.lit(now_ms)))
            .withColumn("created_at", F.lit(now_ms)))


# ---- scoring and exact order --------------------------------------------
def leg_hours(a, b, speed) -> Column:
    """Straight travel time between two stops at the fleet speed."""
    return geo.haversine_km(a["latitude"], a["longitude"], b["latitude"], b["longitude"]) / speed


def stop_pair_costs(facts: DataFrame) -> DataFrame:
    """(vehicle_id, from_idx, to_idx, hours) of all pairs of a vehicle's stops."""
    a = facts.select("vehicle_id", "speed_kmh", "stops", F.posexplode("stops").alias("from_idx", "a"))
    b = a.select("vehicle_id", "speed_kmh", "from_idx", "a", F.posexplode("stops").alias("to_idx", "b"))
    return b.filter("from_idx <> to_idx").select(
        "vehicle_id", "from_idx", "to_idx", leg_hours(F.col("a"), F.col("b"), F.col("speed_kmh")).alias("hours"))


def route_fitness(orders: DataFrame, facts: DataFrame) -> DataFrame:
    """Score ``order`` (array of customer structs) per row; lower is better.

    An order that is not a permutation of the vehicle's stops scores 1e6, an empty one 0.
    """
    joined = orders.join(facts, "vehicle_id")
    key = lambda c: F.struct(c["cust_id"], c["latitude"], c["longitude"])
    same = F.array_sort(F.transform("order", key)) == F.array_sort(F.transform("stops", key))
    later = F.slice("order", F.lit(2), F.greatest(F.size("order") - 1, F.lit(0)))
    hours = F.aggregate(
        F.zip_with(F.slice("order", F.lit(1), F.greatest(F.size("order") - 1, F.lit(0))), later,
                   lambda a, b: leg_hours(a, b, F.col("speed_kmh"))), F.lit(0.0), lambda t, x: t + x)
    score = (F.when(~F.coalesce(same, F.lit(False)), F.lit(S.INVALID_ORDER_FITNESS))
             .when(F.size("order") == 0, F.lit(0.0))
             .otherwise(F.col("start_cost") + hours + F.col("penalty")))
    return joined.select(*orders.columns, score.alias("fitness"))


def exact_order(facts: DataFrame, max_stops: int = EXACT_STOPS) -> DataFrame:
    """Best open order per vehicle, by dynamic programming over visited sets.

    Hours of all legs are worked out per vehicle; a task holds the sets of a few vehicles of equal
    size at a time (``subsets``), n * 2^n entries each, so nothing is shuffled but the rows once.
    A table with a larger vehicle than ``max_stops`` is refused as a whole.
    A route and its reverse cost the same: the one whose stops come first is kept.
    """
    if max_stops > EXACT_STOPS:
        raise ValueError(f"orders are coded for {EXACT_STOPS} stops at most")
    spark = facts.sparkSession
    ship_package(spark)
    small = cut(facts.filter("vehicle_id is not null").filter(F.size("stops") >= 1).withColumn("n", F.size("stops"))
                .repartition(task_count(spark)), "facts")
    longest = small.agg(F.max("n")).first()[0] or 0
    if longest > max_stops:
        raise ValueError(f"a vehicle has {longest} stops; an exact order is worked out for {max_stops} at most: use the genetic search")
    legs = F.flatten(F.transform("stops", lambda a: F.transform("stops", lambda b: leg_hours(a, b, F.col("speed_kmh")))))
    kept = small.drop("speed_kmh")
    ended = small.select(*kept.columns, legs.alias("legs")).mapInArrow(
        subsets.ends, StructType([*kept.schema.fields, *StructType.fromDDL("cost array<double>, code array<bigint>").fields]))
    best = F.array_min(F.zip_with("cost", "code", lambda cost, code: F.struct(F.round(cost, 9).alias("c"), code.alias("code"), cost.alias("cost"))))
    stop_at = lambda k: F.call_function("shiftright", F.col("b.code"), (F.col("n") - k) * subsets.DIGIT).bitwiseAND((1 << subsets.DIGIT) - 1).cast("int")
    ordered = (ended.withColumn("b", best).withColumn("hours", F.col("b.cost"))
               .withColumn("order", F.transform(F.sequence(F.lit(1), F.col("n")), lambda k: F.get(F.col("stops"), stop_at(k)))))
    empty = facts.filter(F.size("stops") == 0).select(
        "vehicle_id", F.array().cast(EMPTY_STOPS).alias("order"), F.lit(0.0).alias("fitness"))
    return ordered.select("vehicle_id", "order", (F.col("start_cost") + F.col("hours") + F.col("penalty")).alias("fitness")).unionByName(empty)


# ---- the whole cycle ----------------------------------------------------
@dataclass(frozen=True)
class CycleConfig:
    now_ms: int
    force: bool = False
    slow_limit: float = S.REROUTE_AT_OR_BELOW_KMH
    algorithm: str = "genetic"      # or "exact"; the same for all vehicles of a cycle
    search: genetic.SearchConfig = genetic.SearchConfig()


def best_orders(facts: DataFrame, cfg: CycleConfig) -> DataFrame:
    """(vehicle_id, order, fitness, generations, algorithm) by the algorithm asked for."""
    if cfg.algorithm == "exact":
        return exact_order(facts).select(
            "vehicle_id", "order", "fitness", F.lit(0).alias("generations"), F.lit("exact").alias("algorithm"))
    if cfg.algorithm != "genetic":
        raise ValueError(f"unknown algorithm {cfg.algorithm}")
    return genetic.ga_optimize(facts, cfg.search).select(
        "vehicle_id", "order", "fitness", "generations", F.lit("genetic").alias("algorithm"))


def new_routes(vehicles: DataFrame, orders: DataFrame, costs: DataFrame, nodes: DataFrame, edges: DataFrame,
               index: NearestIndex) -> DataFrame:
    """Edge route through the ordered stops; the old route where none can be built."""
    ends = edges.select(F.col("edge_id").alias("current_edge_id"), F.col("end_node.node_id").alias("node"))
    starts = vehicles.select("vehicle_id", "current_edge_id").join(ends, "current_edge_id").select("vehicle_id", "node")
    places = (orders.select("vehicle_id", F.posexplode("order").alias("stop_idx", "c"))
              .select("vehicle_id", "stop_idx", "c.latitude", "c.longitude"))
    stops = nearest_node(places, index).select("vehicle_id", "stop_idx", "node_id")
    built = routing.build_routes(starts, stops, costs, nodes)
    path = F.when(F.size("path") > 0, F.col("path"))
    return (vehicles.select("vehicle_id", "assigned_route").join(built, "vehicle_id", "left")
            .select("vehicle_id", F.coalesce(path, "assigned_route", F.array().cast(EMPTY_ROUTE)).alias("new_assigned_route"),
                    F.when(path.isNotNull(), F.col("total_cost")).alias("estimated_total_travel_time_s")))


def optimize_vehicles(docs: DataFrame, state: DataFrame, blocked: DataFrame, edges: DataFrame, nodes: DataFrame,
                      index: NearestIndex, cfg: CycleConfig, only: DataFrame | None = None) -> DataFrame:
    """One result row per vehicle: optimized, skipped or error.

    ``only`` (vehicle_id) restricts the run; an id without a document gives an error row.
    """
    if only is not None:
        asked = only.select(F.col("vehicle_id").alias("_asked")).distinct()
        docs = docs.join(asked, F.col("vehicle_id") == F.col("_asked"), "right").withColumn(
            "_absent", F.col("vehicle_id").isNull()).withColumn("vehicle_id", F.coalesce("vehicle_id", "_asked")).drop("_asked")
    else:
        docs = docs.withColumn("_absent", F.lit(False))
    docs = cut(docs, "docs")
    absent = docs.filter("_absent").select("vehicle_id", F.lit("Vehicle not found").alias("error"))
    vehicles = normalize_vehicles(docs.filter("not _absent"))
    checked = cut(validate_inputs(vehicles), "checked")
    failed = checked.filter("error is not null").select("vehicle_id", "error").unionByName(absent)
    valid = checked.filter("error is null")
    trigger = reroute_candidates(valid, state, blocked, cfg.slow_limit)
    has_new = F.coalesce(F.size("new_assigned_route"), F.lit(0)) > 0 if "new_assigned_route" in valid.columns else F.lit(False)
    decided = cut(valid.withColumn("_forced", F.lit(cfg.force) | ~has_new).join(trigger, "vehicle_id")
                  .withColumn("_go", F.col("_forced") | F.col("needs_reroute")), "decided")
    chosen = decided.filter("_go")
    facts = cut(order_facts(chosen, state, blocked), "order-facts")
    orders = cut(best_orders(facts, cfg), "orders")
    costs = cut(routing.edge_costs(edges, state, blocked), "costs")
    routes = new_routes(chosen, orders, costs, nodes, edges, index).withColumnRenamed("new_assigned_route", "new_route")
    done = chosen.join(orders, "vehicle_id").join(routes, "vehicle_id")
    return result_rows(done, decided.filter("not _go"), failed, cfg.now_ms)


RESULT_COLUMNS = ("status", "vehicle_id", "reason", "old_assigned_route", "new_assigned_route", "fitness",
                  "estimated_total_travel_time_s", "optimized_customer_order", "generation_count", "algorithm",
                  "optimized", "timestamp")


def result_rows(done: DataFrame, skipped: DataFrame, failed: DataFrame, now_ms: int) -> DataFrame:
    """Uniform result documents of a cycle."""
    nothing = {
        "old_assigned_route": F.lit(None).cast(EMPTY_ROUTE), "new_assigned_route": F.lit(None).cast(EMPTY_ROUTE),
        "fitness": F.lit(None).cast("double"), "estimated_total_travel_time_s": F.lit(None).cast("double"),
        "optimized_customer_order": F.lit(None).cast(EMPTY_ROUTE), "generation_count": F.lit(None).cast("int"),
        "algorithm": F.lit(None).cast("string"), "optimized": F.lit(False), "timestamp": F.lit(now_ms)}

    def shaped(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
        every = {**nothing, "vehicle_id": F.col("vehicle_id"), **values}
        return rows.select(*[every[c].alias(c) for c in RESULT_COLUMNS])

    optimized = shaped(done, {
        "status": F.lit("optimized"), "reason": F.coalesce("reason", F.lit("forced")),
        "old_assigned_route": F.col("assigned_route"), "new_assigned_route": F.col("new_route"),
        "fitness": F.col("fitness"), "estimated_total_travel_time_s": F.col("estimated_total_travel_time_s"),
        "optimized_customer_order": F.transform("order", lambda c: c["cust_id"]),
        "generation_count": F.col("generations"), "algorithm": F.col("algorithm"), "optimized": F.lit(True)})
    idle = shaped(skipped, {"status": F.lit("skipped"), "reason": F.lit("No blocked or congested edge detected")})
    wrong = shaped(failed, {"status": F.lit("error"), "reason": F.col("error")})
    return optimized.unionByName(idle).unionByName(wrong)


def result_changes(results: DataFrame) -> DataFrame:
    """Columns a cycle stores back into the vehicle documents (see ``upsert_by_key``)."""
    return results.filter("status = 'optimized'").select(
        "vehicle_id", "new_assigned_route",
        F.col("estimated_total_travel_time_s").alias("estimated_total_travel_time"),
        "optimized_customer_order", F.lit("optimized").alias("route_status"),
        F.col("timestamp").alias("last_optimized_at"),
        F.struct("old_assigned_route", "new_assigned_route", "optimized_customer_order", "fitness",
                 F.col("estimated_total_travel_time_s").alias("estimated_total_travel_time"),
                 "generation_count", "algorithm").alias("optimization_result"))


def result_summary(results: DataFrame) -> DataFrame:
    count = lambda status: F.count_if(F.col("status") == status)
    return results.agg(F.count(F.lit(1)).alias("total"), count("optimized").alias("optimized_count"),
                       count("skipped").alias("skipped_count"), count("error").alias("error_count"))


# ---- on demand ----------------------------------------------------------
def _located_stops(vehicles: DataFrame, index: NearestIndex) -> DataFrame:
    return nearest_node(stops_of(vehicles), index)


def vehicle_starts(vehicles: DataFrame, edges: DataFrame) -> DataFrame:
    """End node of each vehicle's current edge; vehicles on unknown edges are absent."""
    ends = edges.select(F.col("edge_id").alias("current_edge_id"), F.col("end_node.node_id").alias("node"))
    return vehicles.select("vehicle_id", "current_edge_id").join(ends, "current_edge_id").select("vehicle_id", "node")


def greedy_vehicle_order(vehicles: DataFrame, costs: DataFrame, nodes: DataFrame, edges: DataFrame,
                         index: NearestIndex) -> DataFrame:
    """Greedy order by network cost; a vehicle on an unknown edge keeps its given order."""
    stops = cut(_located_stops(vehicles, index), "located")
    ordered = routing.greedy_order(vehicle_starts(vehicles, edges), stops.select("vehicle_id", "stop_idx", "node_id"), costs, nodes)
    return stops.select("vehicle_id", "stop_idx", "cust_id").join(ordered, ["vehicle_id", "stop_idx"])


def route_from_position(requests: DataFrame, vehicles: DataFrame, edges: DataFrame, nodes: DataFrame,
                        index: NearestIndex) -> DataFrame:
    """Route per request from its position over its stops, at speed-limit costs.

    ``requests``: (vehicle_id, lat, lon, customers).  Unreachable stops are dropped,
    blocked edges are not considered, the time is in whole seconds.
    """
    from wayfleet.operators.serving import resolve_request_stops
    resolved = cut(resolve_request_stops(requests, vehicles), "requests")
    good = resolved.filter("error is null")
    starts = nearest_node(good.select("vehicle_id", "lat", "lon"), index, "lat", "lon", "node").select("vehicle_id", "node")
    stops = nearest_node(stops_of(good.withColumnRenamed("customers", "remaining_customers")), index)
    routed = routing.greedy_routes(starts, stops.select("vehicle_id", "stop_idx", "node_id"),
                                   routing.edge_costs(edges), nodes)
    return resolved.select("vehicle_id", "error").join(routed, "vehicle_id", "left").select(
        "vehicle_id", "error", F.coalesce("path", F.array().cast(EMPTY_ROUTE)).alias("path"),
        F.round(F.coalesce("total_cost", F.lit(0.0))).cast("long").alias("time"),
        F.coalesce("visited", F.array().cast("array<int>")).alias("visited"))
