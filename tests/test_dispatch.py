import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from conftest import edge_row
from pyspark.sql import functions as F

from wayfleet.operators import dispatch, evolve, genetic, matching, subsets
from wayfleet.operators.network import nodes_of
from wayfleet.schemas import VEHICLE
from wayfleet.session import task_count
from wayfleet.sources.tables import upsert_by_key

STATE = ("edge_id string, avg_speed double, estimated_travel_time double, vehicle_count int, distance double, max_speed double, "
         "is_congested boolean")


@pytest.fixture(scope="module")
def demo(spark):
    """Two edge states as texts, one blocked edge, one truck with three customers."""
    texts = spark.createDataFrame([("E_105_NgTrai", "25.0", "30.5", "20", "210", "50", "false"),
                                   ("E_106_TaySon", "3.5", "200.0", "120", "700", "50", "true")],
                                  "edge_id string, s string, t string, n string, d string, m string, c string")
    from wayfleet.functions import scalars as X
    state = texts.select("edge_id", X.to_float("s").alias("avg_speed"), X.to_float("t").alias("estimated_travel_time"),
                         X.to_int("n").alias("vehicle_count"), X.to_float("d").alias("distance"), X.to_float("m").alias("max_speed"),
                         X.to_bool("c").alias("is_congested"))
    blocked = spark.createDataFrame([("E_106_TaySon",)], "edge_id string")
    docs = spark.createDataFrame([dict(
        entity_id="Truck_001", edge_id="E_105_NgTrai", distance_on_edge=150.5, assigned_route=["E_105_NgTrai", "E_106_TaySon", None, ""],
        remaining_customers=[("C1", 21.01, 105.80), ("C2", 21.05, 105.80), (None, 1.0, 1.0), ("C3", 21.02, None)])], VEHICLE)
    return state, blocked, dispatch.normalize_vehicles(docs)


def test_normalized(demo):
    v = demo[2].first()
    assert (v.vehicle_id, v.entity_type, v.current_edge_id) == ("Truck_001", "Truck", "E_105_NgTrai")
    assert v.assigned_route == ["E_105_NgTrai", "E_106_TaySon"]
    assert [tuple(c) for c in v.remaining_customers] == [("C1", 21.01, 105.80), ("C2", 21.05, 105.80), ("C3", 21.02, 0.0)]


def test_demo_values(demo):
    state, blocked, vehicles = demo
    assert dispatch.snapshot_speed(vehicles, state, blocked).first().speed_kmh == 14.25
    assert dispatch.route_penalty(vehicles, state, blocked).first().penalty == 1_020_000.0
    r = dispatch.reroute_candidates(vehicles, state, blocked).first()
    assert r.needs_reroute and r.reason == "blocked"
    assert dispatch.start_cost_h(vehicles, state).first().start_cost == 30.5 / 3600
    assert dispatch.traffic_snapshot(vehicles, state, blocked).filter("vehicle_id is not null").count() == 2


def test_trigger_reasons(spark, demo):
    state, _, vehicles = demo
    none = spark.createDataFrame([], "edge_id string")
    assert dispatch.reroute_candidates(vehicles, state, none).first().reason == "congested"
    slow = state.withColumn("is_congested", F.lit(False))
    assert dispatch.reroute_candidates(vehicles, slow, none).first().reason == "slow"
    fine = state.withColumn("avg_speed", F.lit(5.01)).withColumn("is_congested", F.lit(False))
    assert not dispatch.reroute_candidates(vehicles, fine, none).first().needs_reroute
    assert dispatch.snapshot_speed(vehicles, state.limit(0), none).first().speed_kmh == 30.0


def test_first_broken_rule_is_reported(spark):
    rows = spark.createDataFrame([("", "", [(None, 1.0, 1.0)]), ("v", "", []), ("v", "e", [("c", None, 1.0)]), ("v", "e", [])],
                                 "vehicle_id string, current_edge_id string, remaining_customers array<struct<cust_id:string,latitude:double,longitude:double>>"
                                 ).withColumns({"entity_id": F.lit("x"), "entity_type": F.lit("x"), "assigned_route": F.array().cast("array<string>")})
    assert [r.error for r in dispatch.validate_inputs(rows).collect()] == [
        "vehicle_id must not be empty", "current_edge_id must not be empty", "Each customer must have latitude and longitude", None]


# ---- orders -------------------------------------------------------------
def facts_of(spark, groups, speed=30.0):
    rows = [(f"v{i}", [(f"c{i}_{j}", *p) for j, p in enumerate(g)], speed, 0.5, 10.0) for i, g in enumerate(groups)]
    return spark.createDataFrame(rows, "vehicle_id string, stops array<struct<cust_id:string,latitude:double,longitude:double>>, "
                                       "speed_kmh double, start_cost double, penalty double")


def random_groups(sizes, seed=1):
    rng = random.Random(seed)
    return [[(21 + rng.random() * 0.04, 105.8 + rng.random() * 0.05) for _ in range(n)] for n in sizes]


def km(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def test_exact_order_is_the_best_permutation(spark):
    groups = random_groups([1, 2, 3, 5, 6, 7])
    got = {r.vehicle_id: r for r in dispatch.exact_order(facts_of(spark, groups)).collect()}
    for i, g in enumerate(groups):
        best = min(sum(km(a, b) for a, b in zip(p, p[1:])) for p in itertools.permutations(g))
        assert got[f"v{i}"].fitness == pytest.approx(10.5 + best / 30, abs=1e-9)
        assert sorted(c.cust_id for c in got[f"v{i}"].order) == sorted(f"c{i}_{j}" for j in range(len(g)))


def test_exact_order_of_twelve_and_none(spark):
    line = [[(21 + (i * 5 % 12) / 1000, 105.8) for i in range(12)], []]
    got = {r.vehicle_id: r for r in dispatch.exact_order(facts_of(spark, line)).collect()}
    lats = [c.latitude for c in got["v0"].order]
    assert lats in (sorted(lats), sorted(lats, reverse=True))
    assert got["v1"].order == [] and got["v1"].fitness == 0.0


def test_thirteen_stops_are_ordered_and_twenty_are_refused_or_searched(spark):
    groups = [[(21 + (i * 5 % 13) / 1000, 105.8) for i in range(13)], random_groups([5])[0]]
    got = {r.vehicle_id: r for r in dispatch.exact_order(facts_of(spark, groups)).collect()}
    lats = [c.latitude for c in got["v0"].order]
    assert len(got) == 2 and lats in (sorted(lats), sorted(lats, reverse=True))
    large = facts_of(spark, random_groups([20, 3]))
    with pytest.raises(ValueError, match="20 stops"):
        dispatch.exact_order(large)
    assert dispatch.stop_pair_costs(large).count() == 20 * 19 + 3 * 2
    cfg = dispatch.CycleConfig(now_ms=0, search=genetic.SearchConfig(population=10, generations=5))
    found = {r.vehicle_id: (len(r.order), r.algorithm) for r in dispatch.best_orders(large, cfg).collect()}
    assert found == {"v0": (20, "genetic"), "v1": (3, "genetic")}


def test_fitness(spark):
    facts = facts_of(spark, random_groups([4]))
    stops = facts.first().stops
    rows = [("v0", "given", stops), ("v0", "twice", [stops[0]] * 4), ("v0", "short", stops[:3])]
    orders = spark.createDataFrame(rows, "vehicle_id string, k string, order array<struct<cust_id:string,latitude:double,longitude:double>>")
    got = {r.k: r.fitness for r in dispatch.route_fitness(orders, facts).collect()}
    legs = sum(km(a[1:], b[1:]) for a, b in zip(stops, stops[1:])) / 30
    assert got["given"] == pytest.approx(10.5 + legs) and got["twice"] == got["short"] == 1e6


def test_crossover_and_mutation(spark):
    letters = lambda s: F.array(*[F.lit(c) for c in s])
    row = spark.range(1).select(
        genetic.order_crossover(letters("ABCD"), letters("CDAB"), F.lit(1), F.lit(3)),
        genetic.swap_mutation(letters("ABCD"), F.lit(0), F.lit(3), F.lit(True)),
        genetic.swap_mutation(letters("ABCD"), F.lit(0), F.lit(3), F.lit(False))).first()
    assert [list(x) for x in row] == [list("DBCA"), list("DBCA"), list("ABCD")]


def test_genetic_search(spark):
    facts = facts_of(spark, random_groups([0, 1, 2, 5, 7, 14], seed=4))
    cfg = genetic.SearchConfig(population=20, generations=25, mutation_rate=0.2, seed=42)
    got = {r.vehicle_id: r for r in genetic.ga_optimize(facts, cfg, trace=True).collect()}
    exact = {r.vehicle_id: r.fitness for r in dispatch.exact_order(facts).collect()}
    sizes = {r.vehicle_id: len(r.stops) for r in facts.collect()}
    for v, r in got.items():
        assert len({c.cust_id for c in r.order}) == len(r.order) == sizes[v]
        if r.trace:
            assert all(a >= b for a, b in zip(r.trace, r.trace[1:]))       # never gets worse
            assert len(r.trace) == 25
        if v in exact:
            assert r.fitness >= exact[v] - 1e-9
    assert got["v0"].generations == 0 and got["v0"].fitness == 0.0
    assert got["v2"].fitness == pytest.approx(exact["v2"])
    again = {r.vehicle_id: r.order for r in genetic.ga_optimize(facts, cfg).collect()}
    assert all(again[v] == got[v].order for v in got)                      # repeatable
    first = genetic.ga_init(facts, cfg)
    assert first.filter("vehicle_id = 'v4'").select("order").distinct().count() > 10


# ---- the cycle ----------------------------------------------------------
AT = {k: (21.0 + i / 100, 105.8 + (i % 2) / 100) for i, k in enumerate("abcdefgh")}


@pytest.fixture(scope="module")
def town(make_edges):
    ring = "abcdefgh"
    return make_edges([edge_row(2 * i, a, b, AT) for i, (a, b) in enumerate(zip(ring, ring[1:] + ring[0]))])


def test_seed_documents(town):
    docs = {r.vehicle_id: r for r in dispatch.seed_routes(town, 3).collect()}
    assert list(docs) and set(docs) == {"Truck_001", "Truck_002", "Truck_003"}
    second = docs["Truck_002"]                                            # offset 13 % 2 = 1
    assert second.assigned_route == ["E_b_c", "E_c_d", "E_d_e", "E_e_f", "E_f_g", "E_g_h"]
    assert [c.cust_id for c in second.remaining_customers] == ["Cust_T002_1", "Cust_T002_2", "Cust_T002_3"]
    assert second.remaining_customers[0].latitude == AT["c"][0] and second.current_edge_id == "E_b_c"


def test_cycle_isolates_errors_and_falls_back(spark, town):
    nodes = nodes_of(town)
    stop = lambda n: (f"at_{n}", *AT[n])
    docs = spark.createDataFrame([
        dict(vehicle_id="go", edge_id="E_a_b", assigned_route=["E_a_b", "E_b_c"], remaining_customers=[stop("d"), stop("c")]),
        dict(vehicle_id="idle", edge_id="E_a_b", assigned_route=["E_d_e"], remaining_customers=[stop("c")], new_assigned_route=["E_a_b"]),
        dict(vehicle_id="lost", edge_id="E_zz", assigned_route=["E_d_e"], remaining_customers=[stop("c")]),
        dict(vehicle_id="empty", edge_id="E_a_b", assigned_route=["E_d_e"], remaining_customers=[]),
        dict(vehicle_id="wrong", assigned_route=["E_d_e"], remaining_customers=[])], VEHICLE)
    state = spark.createDataFrame([("E_b_c", 4.0, 5.0, 1, 100.0, 36.0, False)], STATE)
    none = spark.createDataFrame([], "edge_id string")
    cfg = dispatch.CycleConfig(now_ms=5)
    results = dispatch.optimize_vehicles(docs, state, none, town, nodes, matching.node_index(nodes), cfg)
    got = {r.vehicle_id: r for r in results.collect()}
    assert (got["go"].status, got["go"].reason) == ("optimized", "slow")
    assert sorted(got["go"].optimized_customer_order) == ["at_c", "at_d"] and got["go"].new_assigned_route[0] == "E_b_c"
    assert got["idle"].status == "skipped" and got["idle"].new_assigned_route is None
    assert got["lost"].new_assigned_route == ["E_d_e"] and got["lost"].estimated_total_travel_time_s is None
    assert got["empty"].fitness == 0.0 and got["empty"].new_assigned_route == ["E_d_e"]
    assert (got["wrong"].status, got["wrong"].reason) == ("error", "current_edge_id must not be empty")
    summary = dispatch.result_summary(results).first()
    assert tuple(summary) == (5, 3, 1, 1)
    stored = {r.vehicle_id: r for r in upsert_by_key(docs, dispatch.result_changes(results), "vehicle_id").collect()}
    assert stored["go"].route_status == "optimized" and stored["idle"].new_assigned_route == ["E_a_b"]
    asked = spark.createDataFrame([("go",), ("nobody",)], "vehicle_id string")
    few = dispatch.optimize_vehicles(docs, state, none, town, nodes, matching.node_index(nodes), cfg, asked)
    assert {(r.vehicle_id, r.status, r.reason) for r in few.collect()} == {("go", "optimized", "slow"), ("nobody", "error", "Vehicle not found")}


def test_upsert(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    changes = spark.createDataFrame([("b", None), ("c", 3)], "k string, n int")
    assert {tuple(r) for r in upsert_by_key(base, changes, "k").collect()} == {("a", 1, "x"), ("b", None, "y"), ("c", 3, None)}
    assert {tuple(r) for r in upsert_by_key(base, changes, "k", reset=("s",)).collect()} == {("a", 1, "x"), ("b", None, None), ("c", 3, None)}
    with pytest.raises(ValueError):
        upsert_by_key(base, changes.withColumn("z", F.lit(1)), "k")


def test_exact_order_meets_no_join_and_breaks_ties_by_the_first_code(spark):
    """The sets of a vehicle stay in one task; unknown legs sort first, as nulls do."""
    square = [(21.0, 105.8), (21.0, 105.8), (21.01, 105.8), (21.01, 105.8)]
    facts = facts_of(spark, [*random_groups([1, 2, 4, 5] * 10, seed=3), square])
    plan = dispatch.exact_order(facts)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "HashAggregate" not in plan
    got = {r.vehicle_id: r for r in dispatch.exact_order(facts).collect()}
    assert len(got) == 41 and [c.cust_id for c in got["v40"].order] == ["c40_0", "c40_1", "c40_2", "c40_3"]
    scored = dispatch.route_fitness(dispatch.exact_order(facts).select("vehicle_id", "order"), facts)
    assert all(r.fitness == pytest.approx(got[r.vehicle_id].fitness, abs=1e-9) for r in scored.collect())
    twice = dispatch.exact_order(facts.unionByName(facts)).collect()
    assert len(twice) == 82 and all(r.order == got[r.vehicle_id].order for r in twice)
    cost, code = subsets.last_stops(np.array([[[0.0, subsets.UNKNOWN], [1.0, 0.0]]]))
    assert cost.tolist() == [[1.0, subsets.UNKNOWN]] and code.tolist() == [[0x10, 0x01]]


def test_search_in_tasks_repeats_the_column_steps(spark):
    """The whole search gives what the steps give when they are taken one by one."""
    cfg = genetic.SearchConfig(population=9, generations=4, mutation_rate=0.4, seed=5)
    facts = facts_of(spark, [*random_groups([1, 2, 3, 6, 9, 9], seed=8), [(21.0, 105.8)] * 4, []])
    got = {r.vehicle_id: r for r in genetic.ga_optimize(facts, cfg, trace=True).collect()}
    rows = facts.filter("size(stops) > 0").withColumn("n", F.size("stops"))
    first = F.transform(F.sequence(F.lit(0), F.lit(cfg.population - 1)), lambda i: genetic.shuffled_order(cfg, F.col("vehicle_id"), i, F.col("n")))
    rows = rows.withColumn("population", first).withColumn("legs", genetic.leg_hours(F.col("stops"), F.col("speed_kmh")))
    best = {}
    for generation in range(1, cfg.generations + 1):
        rows = rows.withColumn("scored", genetic.ranked(F.col("population"), F.col("legs"))).localCheckpoint()
        for r in rows.select("vehicle_id", F.col("scored")[0].alias("top")).collect():
            if r.vehicle_id not in best or r.top.hours < best[r.vehicle_id][0][-1]:
                best[r.vehicle_id] = (best.get(r.vehicle_id, ([],))[0] + [r.top.hours], list(r.top.order))
            else:
                best[r.vehicle_id][0].append(best[r.vehicle_id][0][-1])
        rows = rows.withColumn("population", genetic.next_generation(F.col("scored"), cfg, F.col("vehicle_id"), F.lit(generation), F.col("n")))
    assert len(got) == 8 and (got["v7"].order, got["v7"].generations) == ([], 0)
    for v, (hours, order) in best.items():
        assert got[v].trace == hours and [int(c.cust_id.split("_")[1]) for c in got[v].order] == order
    halves = [0.1234567885, 0.1234567895, 2.0000000005, 1 / 3, 7.0]
    shown = spark.createDataFrame([(h,) for h in halves], "h double").select(F.round("h", 9)).collect()
    assert [x / 1e9 for x in evolve.about(np.array(halves)).tolist()] == [r[0] for r in shown]
    texts = [b"5:v:%d" % i + b"x" * (i % 70) for i in range(300)]
    want = [[int(hashlib.md5(t + s).hexdigest()[:13], 16) for s in (b"", b":12")] for t in texts]
    assert evolve.draws(texts, (b"", b":12")).tolist() == want
    assert evolve.draws(texts[:50], (b"", b":12")).tolist() == want[:50]
    short = [b"5:v:%d" % i for i in range(300)]
    assert evolve.draws(short)[:, 0].tolist() == [int(hashlib.md5(t).hexdigest()[:13], 16) for t in short]


def test_leg_hours_are_worked_out_once_per_row(spark):
    """Legs that come out otherwise each time they are worked out: equal orders have equal hours only if that is done once."""
    legs = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda _: F.transform(F.sequence(F.lit(0), F.lit(2)), lambda _: F.rand(1)))
    population = F.array_repeat(F.array(F.lit(0), F.lit(1), F.lit(2)), 5)
    scored = spark.range(1).select(genetic.ranked(population, legs).alias("s")).first()["s"]
    assert len({s["hours"] for s in scored}) == 1 and [s["i"] for s in scored] == [0, 1, 2, 3, 4]


def test_first_populations_are_dealt_to_all_tasks(spark):
    facts = facts_of(spark, random_groups([3, 4, 5] * 8)).coalesce(1)
    made = genetic.ga_init(facts, genetic.SearchConfig(population=4))
    assert made.rdd.getNumPartitions() == task_count(spark) > 1
    assert made.count() == 24 * 4
