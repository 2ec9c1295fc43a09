"""Named queries over the given tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet import schemas as S
from wayfleet.functions import geo
from wayfleet.functions import scalars as X
from wayfleet.operators import (dispatch, genetic, matching, network, routing, sampling, serving, traffic)
from wayfleet.plans import fixtures, streamed
from wayfleet.session import cut, pin_utc, spread

NOW_MS = 1_704_100_000_000
PLACES = 4
SEARCH = genetic.SearchConfig(population=30, generations=60, seed=42)


class Inputs:
    """Views and the tables prepared from them; each table is built once per session and folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = pin_utc(spark), sf_dir

    def view(self, name: str) -> DataFrame:
        return fixtures.load_view(self.spark, self.sf_dir, name)

    @cached_property
    def ways(self) -> DataFrame:
        return network.read_way_tags(fixtures.ways(self.spark, self.sf_dir))

    @cached_property
    def raw_edges(self) -> DataFrame:
        return cut(network.segment_ways(self.ways, self.view("f_nodes")), "raw-edges")

    @cached_property
    def edges(self) -> DataFrame:
        return cut(network.dedupe_edges(network.valid_edges(self.raw_edges)), "edges")

    @cached_property
    def nodes(self) -> DataFrame:
        return cut(network.nodes_of(self.edges), "nodes")

    @cached_property
    def edge_index(self):
        return matching.edge_index(self.edges)

    @cached_property
    def node_index(self):
        return matching.node_index(self.nodes)

    @cached_property
    def pings(self) -> DataFrame:
        return spread(self.view("f_pings"))

    @cached_property
    def clean(self) -> DataFrame:
        return traffic.clean_pings(self.pings)

    @cached_property
    def matched(self) -> DataFrame:
        return cut(matching.match_pings(self.clean, self.edge_index, with_distance=True), "matched")

    @cached_property
    def states(self) -> DataFrame:
        return cut(traffic.edge_state(self.matched, self.edges), "states")

    @cached_property
    def current(self) -> DataFrame:
        return cut(traffic.latest_edge_state(self.states), "current")

    @cached_property
    def blocked(self) -> DataFrame:
        return cut(traffic.blocked_edges(self.current), "blocked")

    @cached_property
    def positions(self) -> DataFrame:
        return traffic.latest_positions(self.pings, tiebreak="ping_id")

    @cached_property
    def documents(self) -> DataFrame:
        """Vehicle documents with the irregularities the normalizer has to handle."""
        stops = (self.view("f_stops").groupBy("vehicle_no", "vehicle_id")
                 .agg(F.array_sort(F.collect_list(F.struct("stop_idx", "cust_id", "latitude", "longitude"))).alias("l")))
        count = stops.agg(F.max("vehicle_no")).first()[0]
        seeded = dispatch.seed_routes(self.edges, count).select(
            X.number_in_id("vehicle_id").cast("long").alias("vehicle_no"), "edge_id", "assigned_route")
        no = F.col("vehicle_no")
        nameless = F.struct(F.lit("").alias("cust_id"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"))
        customers = F.transform("l", lambda c: F.struct(c["cust_id"].alias("cust_id"), c["latitude"].alias("latitude"),
                                                        c["longitude"].alias("longitude")))
        rows = stops.join(seeded, "vehicle_no").select(
            F.when(no % 10 != 3, F.col("vehicle_id")).alias("vehicle_id"),
            F.col("vehicle_id").alias("entity_id"),
            F.when(no % 10 != 5, F.lit("Truck")).alias("entity_type"),
            F.when((no % 10 == 7), F.lit("")).otherwise(F.col("edge_id")).alias("edge_id"),
            F.when((no % 20 == 17) | (no % 10 == 9), F.lit("")).otherwise(F.col("edge_id")).alias("current_edge_id"),
            F.lit(0.0).alias("distance_on_edge"),
            F.concat("assigned_route", F.array(F.lit(""))).alias("assigned_route"),
            F.concat(customers, F.array(nameless)).alias("remaining_customers"),
            F.when(no % 3 == 0, F.slice("assigned_route", 1, 2)).alias("new_assigned_route"),
            F.lit(None).cast("double").alias("estimated_total_travel_time"),
            F.lit(None).cast("string").alias("route_status"),
            F.lit(None).cast("array<string>").alias("optimized_customer_order"),
            F.lit(None).cast("long").alias("last_optimized_at"),
            F.lit(None).cast(S.OPTIMIZATION_RESULT).alias("optimization_result"))
        return cut(rows, "documents")

    @cached_property
    def vehicles(self) -> DataFrame:
        return cut(dispatch.normalize_vehicles(self.documents), "vehicles")

    @cached_property
    def facts(self) -> DataFrame:
        return cut(dispatch.order_facts(self.vehicles, self.current, self.blocked), "facts")

    @cached_property
    def orders(self) -> DataFrame:
        return cut(dispatch.exact_order(self.facts), "orders")

    @cached_property
    def costs(self) -> DataFrame:
        return cut(routing.edge_costs(self.edges, self.current, self.blocked), "costs")

    @cached_property
    def updates(self) -> DataFrame:
        return self.view("f_route_updates").select(
            "update_seq", "vehicle_id",
            F.when(F.col("path_csv") != "", F.split("path_csv", ",")).otherwise(F.array().cast("array<string>")).alias("path"),
            "time")

    @cached_property
    def routes(self) -> DataFrame:
        """Assigned routes as the serving side sees them."""
        return cut(self.vehicles.select("vehicle_id", F.col("assigned_route").alias("path")), "routes")

    @cached_property
    def route_positions(self) -> DataFrame:
        return self.positions

    @cached_property
    def results(self) -> DataFrame:
        cfg = dispatch.CycleConfig(now_ms=NOW_MS, algorithm="exact")
        return cut(dispatch.optimize_vehicles(self.documents, self.current, self.blocked, self.edges, self.nodes,
                                              self.node_index, cfg), "results")


_PREPARED: dict[tuple[str, str], Inputs] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PREPARED:
        _PREPARED[key] = Inputs(spark, sf_dir)
    return _PREPARED[key]


def forget() -> None:
    """Drop prepared tables, so that a timing includes building them."""
    _PREPARED.clear()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Inputs], DataFrame]):
    QUERIES[build.__name__] = lambda spark, sf_dir: build(inputs(spark, sf_dir))
    return build


def r(name: str, places: int = PLACES):
    return F.round(name, places).alias(name)


def ms(name: str, out: str):
    return F.unix_millis(name).alias(out)


def text(name: str, out: str | None = None):
    return F.concat_ws(",", name).alias(out or name)


# ---- pings --------------------------------------------------------------
@query
def decoded_pings(d: Inputs) -> DataFrame:
    from wayfleet.sources.pings import decode_pings
    fields = ("entity_id", "entity_type", "latitude", "longitude", "speed", "timestamp")
    payload = F.when(F.col("ping_id") % 53 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct(*fields)))
    raw = d.pings.select(F.encode(payload, "UTF-8").alias("value"))
    return traffic.with_coordinates(traffic.keep_entities(decode_pings(raw)))


@query
def encoded_pings(d: Inputs) -> DataFrame:
    """Every message: its key and what its payload says."""
    from wayfleet.sources.pings import encode_pings
    sent = encode_pings(d.pings.select("entity_id", "entity_type", "latitude", "longitude", "speed", "timestamp"))
    return sent.select(F.col("key").cast("string").alias("key"), F.from_json("value", S.PING).alias("p")).select("key", "p.*")


@query
def event_time(d: Inputs) -> DataFrame:
    return traffic.with_event_time(d.pings).select("ping_id", ms("event_time", "event_ms"),
                                                   X.iso_text("event_time").alias("event_text"))


@query
def archive_rows(d: Inputs) -> DataFrame:
    return (traffic.archive_rows(d.matched).withColumn("event_ms", F.unix_millis("event_time"))
            .withColumn("event_date", F.date_format("event_time", "yyyy-MM-dd")).drop("event_time"))


@query
def matched_pings(d: Inputs) -> DataFrame:
    return d.matched.select("ping_id", "edge_id", r("match_distance_m", 3))


@query
def matched_everything(d: Inputs) -> DataFrame:
    """All pings, those without coordinates included."""
    return matching.match_pings(d.pings.select("ping_id", "latitude", "longitude"), d.edge_index).select("ping_id", "edge_id")


@query
def latest_positions(d: Inputs) -> DataFrame:
    return d.positions


@query
def conflated_positions(d: Inputs) -> DataFrame:
    per_second = traffic.conflate_positions(traffic.with_event_time(d.pings))
    return per_second.select("id", F.unix_millis("tick").alias("tick_ms"), "lat", "lon", "speed")


# ---- network ------------------------------------------------------------
@query
def way_segments(d: Inputs) -> DataFrame:
    return network.way_segments(network.drivable(d.ways), d.view("f_nodes")).select(
        "way_id", "pos", "u", "v", "oneway", "road_name", "max_speed_kmh", r("raw_length_m", 3))


@query
def road_edges(d: Inputs) -> DataFrame:
    return d.edges.select("edge_seq", "edge_id", "road_name", "max_speed_kmh", "length_meters",
                          F.col("start_node.node_id").alias("start_id"), F.col("end_node.node_id").alias("end_id"),
                          F.col("start_node.lat").alias("start_lat"), F.col("end_node.lon").alias("end_lon"))


@query
def clipped_edges(d: Inputs) -> DataFrame:
    out = None
    for box in S.DISTRICT_BOXES:
        part = network.clip_edges(d.edges, box).select(F.lit(box).alias("box"), "edge_id", "length_meters")
        out = part if out is None else out.unionByName(part)
    return out


@query
def stored_osm_edges(d: Inputs) -> DataFrame:
    """The network written as OSM XML, read back and cut into edges again."""
    from wayfleet.sources import maps
    path = streamed.folder(d, "osm")
    maps.write_osm(d.view("f_nodes").select("node_id", "lat", "lon"), fixtures.ways(d.spark, d.sf_dir), path)
    nodes, ways = maps.read_osm(d.spark, f"{path}/*")
    edges = network.dedupe_edges(network.valid_edges(network.segment_ways(network.read_way_tags(ways), nodes)))
    return edges.select("edge_seq", "edge_id", "road_name", "max_speed_kmh", "length_meters",
                        F.col("start_node.node_id").alias("start_id"), F.col("end_node.node_id").alias("end_id"),
                        F.col("start_node.lat").alias("start_lat"), F.col("end_node.lon").alias("end_lon"))


@query
def stored_edge_order(d: Inputs) -> DataFrame:
    """Edges written without numbers, as several files, and numbered by the order of the files and their rows when read."""
    from wayfleet.sources import maps
    ordered = d.edges.repartitionByRange(7, "edge_seq").sortWithinPartitions("edge_seq").drop("edge_seq")
    out = None
    for fmt in ("parquet", "json"):
        path = streamed.folder(d, f"edges-{fmt}")
        maps.write_edges(ordered, path, fmt)
        part = maps.read_edges(d.spark, path, fmt).select(F.lit(fmt).alias("format"), "edge_id", F.col("edge_seq").alias("position"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def stored_clipped_edges(d: Inputs) -> DataFrame:
    """The full map written as JSON Lines, clipped box by box into new places and read back."""
    from wayfleet.sources import maps
    full, out = streamed.folder(d, "full-map"), None
    maps.write_edges(d.edges, full, "json")
    for box in S.DISTRICT_BOXES:
        part = maps.clip_edges_job(d.spark, full, streamed.folder(d, f"map-{box}"), box, "json").select(F.lit(box).alias("box"), "edge_id", "length_meters")
        out = part if out is None else out.unionByName(part)
    return out


@query
def road_nodes(d: Inputs) -> DataFrame:
    return network.nodes_of(d.edges)


@query
def graph_tables(d: Inputs) -> DataFrame:
    nodes, edges = network.graph_tables(d.raw_edges)
    rows = edges.select(F.lit("edge").alias("kind"), F.col("edge_id").alias("id"), "length_meters", "max_speed_kmh")
    return rows.unionByName(nodes.select(F.lit("node").alias("kind"), F.col("node_id").alias("id"),
                                         F.lit(None).cast("double").alias("length_meters"),
                                         F.lit(None).cast("double").alias("max_speed_kmh")))


@query
def adjacency(d: Inputs) -> DataFrame:
    return network.adjacency(d.edges)


@query
def edge_ids(d: Inputs) -> DataFrame:
    return network.edge_ids(d.raw_edges)


@query
def edge_endpoints(d: Inputs) -> DataFrame:
    asked = d.updates.select(F.explode("path").alias("edge_id")).distinct()
    return network.edge_endpoints(asked, d.edges)


@query
def components(d: Inputs) -> DataFrame:
    return network.connected_components(d.edges)


@query
def largest_component(d: Inputs) -> DataFrame:
    return network.largest_component(d.edges).select("edge_id")


@query
def edge_positions(d: Inputs) -> DataFrame:
    return network.with_position(d.edges, "edge_seq").select("edge_id", "position")


@query
def nearest_nodes(d: Inputs) -> DataFrame:
    return matching.nearest_node(d.view("f_stops").select("cust_id", "latitude", "longitude"), d.node_index).select("cust_id", "node_id")


@query
def nearest_departures(d: Inputs) -> DataFrame:
    """Nearest node that has an outgoing edge."""
    index = matching.node_index(matching.with_outgoing(d.nodes, d.edges))
    return matching.nearest_node(d.view("f_stops").select("cust_id", "latitude", "longitude"), index).select("cust_id", "node_id")


# ---- traffic state ------------------------------------------------------
@query
def edge_speed(d: Inputs) -> DataFrame:
    return traffic.edge_speed(d.matched, distinct_vehicles=True).select(
        ms("window_start", "start_ms"), ms("window_end", "end_ms"), "edge_id", r("avg_speed"), "vehicle_count", "distinct_vehicles")


@query
def edge_state(d: Inputs) -> DataFrame:
    return d.states


@query
def enriched_windows(d: Inputs) -> DataFrame:
    """Attributes by edge id for all matched windows, unknown edges included."""
    ids = traffic.edge_speed(matching.match_pings(traffic.with_event_time(traffic.keep_entities(d.pings)), d.edge_index)).select("edge_id").distinct()
    return traffic.enrich_edges(ids, d.edges)


@query
def latest_edge_state(d: Inputs) -> DataFrame:
    return traffic.latest_edge_state(d.states)


@query
def blocked_edges(d: Inputs) -> DataFrame:
    return traffic.blocked_edges(d.states)


@query
def live_edge_state(d: Inputs) -> DataFrame:
    as_of = d.matched.agg(F.max("timestamp")).first()[0]
    return traffic.live_edge_state(d.states, as_of).select("edge_id", "avg_speed", "last_updated")


@query
def live_blocked_edges(d: Inputs) -> DataFrame:
    as_of = d.matched.agg(F.max("timestamp")).first()[0]
    return traffic.blocked_edges(d.states, expire_at_ms=as_of)


@query
def state_json(d: Inputs) -> DataFrame:
    from wayfleet.sources.tables import state_as_json, state_from_json
    rows = state_as_json(d.current)
    return state_from_json(rows).join(rows.select(X.after_first_colon("key").alias("edge_id"), "key"), "edge_id").select(
        "key", "avg_speed", "vehicle_count", "is_congested", "updated_at")


@query
def edge_occupancy(d: Inputs) -> DataFrame:
    at = traffic.latest_positions(d.clean, ("Truck", "Bot"), "ping_id").select(
        F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    rows = traffic.edge_occupancy(matching.match_pings(at, d.edge_index), d.edges)
    return rows.select("edge_id", "vehicles", r("density"), r("expected_speed"), r("capacity"), "at_capacity")


@query
def edge_interpolation(d: Inputs) -> DataFrame:
    travelled = F.col("length_meters") * ((F.col("edge_seq") % 10) / 10.0)
    return d.edges.select("edge_id",
                          F.round(geo.interpolate("start_node.lat", "end_node.lat", travelled, "length_meters"), 6).alias("lat"),
                          F.round(geo.interpolate("start_node.lon", "end_node.lon", travelled, "length_meters"), 6).alias("lon"))


# ---- dispatch -----------------------------------------------------------
@query
def seed_routes(d: Inputs) -> DataFrame:
    trucks = d.view("f_stops").agg(F.max("vehicle_no")).first()[0]
    return dispatch.seed_routes(d.edges, trucks).select(
        "vehicle_id", "entity_type", "current_edge_id", text("assigned_route"),
        F.concat_ws(",", "remaining_customers.cust_id").alias("cust_ids"),
        F.aggregate("remaining_customers", F.lit(0.0), lambda a, c: a + c["latitude"], lambda a: F.round(a, 5)).alias("lat_sum"))


@query
def normalized_vehicles(d: Inputs) -> DataFrame:
    return dispatch.normalize_vehicles(d.documents).select(
        "vehicle_id", "entity_id", "entity_type", "current_edge_id", "distance_on_edge", text("assigned_route"),
        F.concat_ws(",", "remaining_customers.cust_id").alias("cust_ids"))


@query
def invalid_inputs(d: Inputs) -> DataFrame:
    return dispatch.validate_inputs(d.vehicles).select("vehicle_id", "error")


@query
def optimization_inputs(d: Inputs) -> DataFrame:
    return dispatch.optimization_inputs(d.documents, d.current, d.blocked, NOW_MS).select(
        "request_id", "vehicle_id", "error", r("speed_kmh"), r("start_cost"), "penalty", "created_at")


@query
def traffic_snapshot(d: Inputs) -> DataFrame:
    return dispatch.traffic_snapshot(d.vehicles, d.current, d.blocked).select(
        F.coalesce("vehicle_id", F.lit("*")).alias("vehicle_id"), "edge_id", "avg_speed", "is_congested")


@query
def snapshot_speed(d: Inputs) -> DataFrame:
    return dispatch.snapshot_speed(d.vehicles, d.current, d.blocked).select("vehicle_id", r("speed_kmh"))


@query
def route_penalty(d: Inputs) -> DataFrame:
    return dispatch.route_penalty(d.vehicles, d.current, d.blocked)


@query
def reroute_candidates(d: Inputs) -> DataFrame:
    return dispatch.reroute_candidates(d.vehicles, d.current, d.blocked)


@query
def start_cost(d: Inputs) -> DataFrame:
    return dispatch.start_cost_h(d.vehicles, d.current).select("vehicle_id", r("start_cost", 6))


@query
def stop_pair_costs(d: Inputs) -> DataFrame:
    return dispatch.stop_pair_costs(d.facts).select("vehicle_id", "from_idx", "to_idx", r("hours", 6))


@query
def route_fitness(d: Inputs) -> DataFrame:
    """The given order, its reverse, and one that misses the first stop."""
    stops = F.col("remaining_customers")
    kinds = F.array(
        F.struct(F.lit("given").alias("kind"), stops.alias("order")),
        F.struct(F.lit("reverse").alias("kind"), F.reverse(stops).alias("order")),
        F.struct(F.lit("short").alias("kind"), F.slice(stops, F.lit(2), F.size(stops)).alias("order")))
    orders = d.vehicles.select("vehicle_id", F.inline(kinds))
    return dispatch.route_fitness(orders, d.facts).select("vehicle_id", "kind", r("fitness"))


@query
def exact_order(d: Inputs) -> DataFrame:
    return d.orders.select("vehicle_id", F.concat_ws(",", "order.cust_id").alias("cust_ids"), r("fitness"))


@query
def ga_init(d: Inputs) -> DataFrame:
    return genetic.ga_init(d.facts, SEARCH).select("vehicle_id", "individual", text("order"))


def _first_generation(d: Inputs) -> DataFrame:
    """One row per vehicle: its first population, scored and ranked."""
    orders = genetic.ga_init(d.facts, SEARCH).groupBy("vehicle_id").agg(
        F.array_sort(F.collect_list(F.struct("individual", "order"))).alias("p"))    # a population, bounded by the configuration
    rows = genetic.dealt(d.facts).join(orders, "vehicle_id").withColumn("population", F.transform("p", lambda x: x["order"]))
    return rows.withColumn("scored", genetic.ranked(
        F.col("population"), genetic.leg_hours(F.col("stops"), F.col("speed_kmh")))).withColumn("n", F.size("stops"))


@query
def ga_selection(d: Inputs) -> DataFrame:
    """The parents of the first generation, best first."""
    parents = _first_generation(d).select("vehicle_id", F.posexplode(genetic.select_parents(F.col("scored"), SEARCH)).alias("rank", "s"))
    return parents.select("vehicle_id", "rank", F.col("s.i").alias("individual"), F.round("s.about", 6).alias("hours"))


@query
def ga_crossover(d: Inputs) -> DataFrame:
    """The children of the first generation before mutation."""
    rows = _first_generation(d).withColumn("parents", genetic.select_parents(F.col("scored"), SEARCH))
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(SEARCH.elite), F.lit(SEARCH.population - 1))))
    bred = genetic.bred_child(F.col("parents"), SEARCH, F.col("vehicle_id"), F.lit(1), F.col("i"), F.col("n"))
    return rows.select("vehicle_id", "i", bred.alias("order")).select("vehicle_id", "i", text("order"))


@query
def ga_mutation(d: Inputs) -> DataFrame:
    """Every individual of the first population after mutation."""
    rows = genetic.ga_init(d.facts, SEARCH).join(genetic.dealt(d.facts).select("vehicle_id", F.size("stops").alias("n")), "vehicle_id")
    mutated = genetic.mutated_child(F.col("order"), SEARCH, F.col("vehicle_id"), F.lit(1), F.col("individual"), F.col("n"))
    return rows.select("vehicle_id", "individual", mutated.alias("order")).select("vehicle_id", "individual", text("order"))


@query
def ga_next_generation(d: Inputs) -> DataFrame:
    """The population that follows the first one."""
    after = genetic.next_generation(F.col("scored"), SEARCH, F.col("vehicle_id"), F.lit(1), F.col("n"))
    return _first_generation(d).select("vehicle_id", F.posexplode(after).alias("individual", "order")).select("vehicle_id", "individual", text("order"))


@query
def ga_order(d: Inputs) -> DataFrame:
    return genetic.ga_optimize(d.facts, SEARCH).select(
        "vehicle_id", F.concat_ws(",", "order.cust_id").alias("cust_ids"), r("fitness"), "generations")


# ---- routing ------------------------------------------------------------
@query
def edge_costs(d: Inputs) -> DataFrame:
    return routing.edge_costs(d.edges, d.current, d.blocked).select("edge_id", "src", "dst", r("cost"))


@query
def static_edge_costs(d: Inputs) -> DataFrame:
    return routing.edge_costs(d.edges).select("edge_id", "src", "dst", r("cost"))


def _start_stop_pairs(d: Inputs) -> DataFrame:
    starts = dispatch.vehicle_starts(d.vehicles, d.edges)
    stops = matching.nearest_node(dispatch.stops_of(d.vehicles), d.node_index)
    return stops.join(starts, "vehicle_id").select(F.col("node").alias("source"), F.col("node_id").alias("target"))


@query
def shortest_path_cost(d: Inputs) -> DataFrame:
    found = routing.shortest_paths(_start_stop_pairs(d), d.costs, d.nodes, with_path=False)
    reached = F.col("cost") < routing.INFINITY
    return found.select("source", "target", reached.alias("reachable"), F.round(F.when(reached, F.col("cost")), PLACES).alias("cost"))


@query
def shortest_path_edges(d: Inputs) -> DataFrame:
    found = routing.shortest_paths(_start_stop_pairs(d), d.costs, d.nodes)
    there = F.col("cost") < routing.INFINITY
    return found.select("source", "target", F.when(there, F.concat_ws(",", "path")).alias("path"), F.when(there, F.col("cost")).alias("cost")).select(
        "source", "target", "path", r("cost"))


@query
def build_routes_cost(d: Inputs) -> DataFrame:
    built = dispatch.new_routes(d.vehicles, d.orders, d.costs, d.nodes, d.edges, d.node_index)
    return built.select("vehicle_id", r("estimated_total_travel_time_s"))


@query
def new_routes(d: Inputs) -> DataFrame:
    return dispatch.new_routes(d.vehicles, d.orders, d.costs, d.nodes, d.edges, d.node_index).select(
        "vehicle_id", text("new_assigned_route"), r("estimated_total_travel_time_s"))


@query
def greedy_order(d: Inputs) -> DataFrame:
    return dispatch.greedy_vehicle_order(d.vehicles, d.costs, d.nodes, d.edges, d.node_index).select(
        "vehicle_id", "stop_idx", "rank", r("cost"))


@query
def planar_greedy_order(d: Inputs) -> DataFrame:
    ends = d.edges.select(F.col("edge_id").alias("current_edge_id"), F.col("end_node.lat").alias("start_lat"),
                          F.col("end_node.lon").alias("start_lon"))
    rows = d.vehicles.join(ends, "current_edge_id").select(
        "vehicle_id", "start_lat", "start_lon",
        F.transform("remaining_customers", lambda c, i: F.struct(
            i.alias("stop_idx"), c["latitude"].alias("latitude"), c["longitude"].alias("longitude"))).alias("stops"))
    return routing.planar_greedy_order(rows).select("vehicle_id", text(F.col("stop_order").cast("array<string>"), "stop_order"))


@query
def request_stops(d: Inputs) -> DataFrame:
    return serving.resolve_request_stops(_requests(d), d.vehicles).select(
        "vehicle_id", F.coalesce(F.size("customers"), F.lit(0)).alias("stops"), "error")


def _requests(d: Inputs) -> DataFrame:
    """Every truck's last position asks for a route; those seen without a fix are refused."""
    return d.positions.select(F.col("id").alias("vehicle_id"), "lat", "lon",
                              F.lit(None).cast(dispatch.EMPTY_STOPS).alias("customers"))


@query
def route_from_position(d: Inputs) -> DataFrame:
    return dispatch.route_from_position(_requests(d), d.vehicles, d.edges, d.nodes, d.node_index).select(
        "vehicle_id", "error", "time", text(F.col("visited").cast("array<string>"), "visited"))


@query
def optimize_vehicles(d: Inputs) -> DataFrame:
    return d.results.select("status", "vehicle_id", "reason", r("fitness"), r("estimated_total_travel_time_s"),
                            text("optimized_customer_order"), "generation_count", "optimized", "timestamp")


@query
def optimize_asked_vehicles(d: Inputs) -> DataFrame:
    """Vehicles named by the route updates, known or not."""
    asked = d.updates.select("vehicle_id").distinct()
    cfg = dispatch.CycleConfig(now_ms=NOW_MS, algorithm="exact")
    return dispatch.optimize_vehicles(d.documents, d.current, d.blocked, d.edges, d.nodes, d.node_index, cfg, asked).select(
        "status", "vehicle_id", "reason")


@query
def result_summary(d: Inputs) -> DataFrame:
    return dispatch.result_summary(d.results)


@query
def upserted_vehicles(d: Inputs) -> DataFrame:
    from wayfleet.sources.tables import upsert_by_key
    changes = d.updates.groupBy("vehicle_id").agg(F.max_by(F.struct("path", "time"), "update_seq").alias("u")).select(
        "vehicle_id", F.col("u.path").alias("new_assigned_route"), F.col("u.time").alias("estimated_total_travel_time"))
    base = d.documents.filter("vehicle_id is not null").withColumn("route_status", F.lit("stale"))
    return upsert_by_key(base, changes, "vehicle_id", reset=("route_status",)).select(
        "vehicle_id", "entity_type", "route_status", text("new_assigned_route"), r("estimated_total_travel_time"))


def _document_table(d: Inputs):
    """Documents in buckets; the newest update of each vehicle is merged in, and merged again."""
    from wayfleet.sources.versions import DocumentTable
    changes = d.updates.groupBy("vehicle_id").agg(F.max_by(F.struct("path", "time"), "update_seq").alias("u")).select(
        "vehicle_id", F.col("u.path").alias("new_assigned_route"), F.col("u.time").alias("estimated_total_travel_time"))
    base = d.documents.filter("vehicle_id is not null").withColumn("route_status", F.lit("stale"))
    table = DocumentTable(d.spark, streamed.folder(d, "documents"), "vehicle_id", base.schema)
    table.create(base)
    for _ in range(2):
        table.merge(changes, reset=("route_status",))
    return table


@query
def merged_documents(d: Inputs) -> DataFrame:
    return _document_table(d).read().select(
        "vehicle_id", "entity_type", "route_status", text("new_assigned_route"), r("estimated_total_travel_time"))


@query
def document_changes(d: Inputs) -> DataFrame:
    """Each change once, with both images, although the updates came twice."""
    return _document_table(d).changes(since=1).select(
        "version", "vehicle_id", "kind", F.col("before.route_status").alias("old_status"),
        F.col("before.new_assigned_route").isNotNull().alias("had_route"), text("after.new_assigned_route", "new_route"),
        F.round("after.estimated_total_travel_time", PLACES).alias("time"))


@query
def stored_results(d: Inputs) -> DataFrame:
    from wayfleet.sources.tables import upsert_by_key
    base = d.documents.filter("vehicle_id is not null")
    return upsert_by_key(base, dispatch.result_changes(d.results), "vehicle_id").select(
        "vehicle_id", "route_status", "last_optimized_at", r("estimated_total_travel_time"),
        F.col("optimization_result.algorithm").alias("algorithm"), F.col("optimization_result.generation_count").alias("generation_count"),
        text("optimization_result.old_assigned_route", "old_route"), text("optimization_result.optimized_customer_order", "customer_order"))


@query
def sampled_edges(d: Inputs) -> DataFrame:
    """15 edges drawn uniformly and 15 by length."""
    even = sampling.sample_edges(d.edges, 15, seed=7).select(F.lit("uniform").alias("kind"), "edge_id")
    return even.unionByName(sampling.sample_edges(d.edges, 15, seed=7, weighted=True).select(F.lit("length").alias("kind"), "edge_id"))


# ---- serving ------------------------------------------------------------
@query
def route_snapshot(d: Inputs) -> DataFrame:
    return serving.route_snapshot(d.documents).select("vehicle_id", text("old_path"), text("new_path"), text("path"))


@query
def merged_routes(d: Inputs) -> DataFrame:
    return serving.merge_routes(d.updates).select("vehicle_id", text("path"), r("time"), X.eta_text("time").alias("eta"))


@query
def vehicle_search(d: Inputs) -> DataFrame:
    return serving.search_routes(serving.merge_routes(d.updates), "  tRUCK_00 ").select("vehicle_id")


@query
def ordered_vehicles(d: Inputs) -> DataFrame:
    rows = serving.numbered_vehicles(serving.merge_routes(d.updates))
    return rows.select("vehicle_id", "place", X.number_in_id("vehicle_id").cast("long").alias("number"), X.short_truck_id("vehicle_id").alias("short_id"))


@query
def vehicle_board(d: Inputs) -> DataFrame:
    return serving.vehicle_board(d.positions, serving.merge_routes(d.updates))


@query
def board_counts(d: Inputs) -> DataFrame:
    return serving.board_counts(d.positions, serving.merge_routes(d.updates), d.nodes, d.edges)


@query
def traffic_feed(d: Inputs) -> DataFrame:
    return serving.traffic_feed(d.current)


@query
def heat_points(d: Inputs) -> DataFrame:
    return serving.heat_points(serving.traffic_feed(d.current), d.edges).select(
        "edge_id", r("mid_lat", 6), r("mid_lon", 6), r("intensity"))


@query
def edge_speed_class(d: Inputs) -> DataFrame:
    return serving.edge_speed_class(d.edges, serving.traffic_feed(d.current))


@query
def route_geometry(d: Inputs) -> DataFrame:
    return serving.route_geometry(d.routes, d.edges)


@query
def route_segments(d: Inputs) -> DataFrame:
    return serving.route_segments(serving.route_geometry(d.routes, d.edges)).select(
        "vehicle_id", "segment_no", text("edge_ids"), F.size("points").alias("points"))


@query
def route_progress(d: Inputs) -> DataFrame:
    return serving.route_progress(d.routes, d.edges, d.positions).select(
        "vehicle_id", F.coalesce("progress", F.lit(-1)).alias("progress"), text("traversed"), text("upcoming"))


@query
def route_bounds(d: Inputs) -> DataFrame:
    return serving.route_bounds(serving.route_geometry(d.routes, d.edges), d.positions)


@query
def typed_values(d: Inputs) -> DataFrame:
    """Tolerant conversions over texts of mixed quality."""
    speed = F.col("speed").cast("string")
    raw = d.pings.select("ping_id", F.when(F.col("ping_id") % 4 == 0, F.concat(speed, F.lit(" km"))).otherwise(speed).alias("number"),
                         F.element_at(F.array(*[F.lit(v) for v in (" YES ", "y", "0", "True", "no")]),
                                      (F.col("ping_id") % 5 + 1).cast("int")).alias("flag"))
    return raw.select("ping_id", F.round(X.to_float("number"), 4).alias("as_float"), X.to_int("number", -1).alias("as_int"),
                      X.to_bool("flag").alias("as_bool"), X.to_bool_strict("flag").alias("as_strict_bool"),
                      X.display_speed(X.to_float("number")).alias("shown"))


# ---- streams ------------------------------------------------------------
@query
def streamed_edge_state(d: Inputs) -> DataFrame:
    return streamed.edge_state(d)


@query
def streamed_archive(d: Inputs) -> DataFrame:
    return streamed.archive(d)


@query
def streamed_match_archive(d: Inputs) -> DataFrame:
    return streamed.match_archive(d)


@query
def streamed_route_changes(d: Inputs) -> DataFrame:
    return streamed.route_changes(d)


@query
def streamed_traffic_job(d: Inputs) -> DataFrame:
    """The same state from the one-call job."""
    return streamed.traffic_job(d)


@query
def streamed_snapshot(d: Inputs) -> DataFrame:
    return streamed.snapshot(d)


@query
def streamed_conflation(d: Inputs) -> DataFrame:
    return streamed.conflation(d).select("id", F.unix_millis("tick").alias("tick_ms"), "lat", "lon", "speed")


@query
def late_ledger(d: Inputs) -> DataFrame:
    return streamed.late_ledger(d)


@query
def versioned_edge_state(d: Inputs) -> DataFrame:
    return streamed.versioned_state(d)


@query
def expiry_events(d: Inputs) -> DataFrame:
    return streamed.expiry_events(d)
