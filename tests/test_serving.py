from conftest import edge_row
from pyspark.sql import functions as F

from wayfleet.operators import sampling, serving

AT = {k: (21.0 + i / 100, 105.8) for i, k in enumerate("abcdef")}


def roads(make_edges):
    return make_edges([edge_row(0, "a", "b", AT), edge_row(2, "b", "c", AT), edge_row(4, "d", "e", AT)])


def paths(spark, *rows):
    return spark.createDataFrame(list(rows), "vehicle_id string, path array<string>")


def test_segments_break_at_jumps(spark, make_edges):
    geometry = serving.route_geometry(paths(spark, ("v", ["E_a_b", "E_b_c", "E_no", "E_d_e"])), roads(make_edges))
    got = {r.segment_no: (r.edge_ids, len(r.points)) for r in serving.route_segments(geometry).collect()}
    assert got == {1: (["E_a_b", "E_b_c"], 3), 2: (["E_d_e"], 2)}


def test_progress(spark, make_edges):
    routes = paths(spark, ("v", ["E_a_b", "E_b_c", "E_d_e"]), ("w", ["E_no"]), ("x", ["E_a_b"]))
    at = spark.createDataFrame([("v", 21.0151, 105.8), ("w", 21.0, 105.8), ("x", None, 105.8)], "id string, lat double, lon double")
    got = {r.vehicle_id: (r.progress, r.traversed, r.upcoming) for r in serving.route_progress(routes, roads(make_edges), at).collect()}
    assert got["v"] == (1, ["E_a_b"], ["E_b_c", "E_d_e"])
    assert got["w"] == (0, [], ["E_no"]) and got["x"] == (None, [], ["E_a_b"])


def test_snapshot_and_merge(spark):
    docs = spark.createDataFrame([("a", ["x"], ["y"], 1.0), ("b", ["x"], [], None), ("c", [], None, None), ("", ["x"], [], None)],
                                 "vehicle_id string, assigned_route array<string>, new_assigned_route array<string>, estimated_total_travel_time double")
    assert {r.vehicle_id: r.path for r in serving.route_snapshot(docs).collect()} == {"a": ["y"], "b": ["x"]}
    log = spark.createDataFrame([(1, "a", ["x"]), (2, "a", []), (1, "b", ["x"]), (2, "b", ["z"])],
                                "update_seq int, vehicle_id string, path array<string>")
    assert {r.vehicle_id: r.path for r in serving.merge_routes(log).collect()} == {"b": ["z"]}


def test_search_and_order(spark):
    rows = paths(spark, ("Truck_10", []), ("Truck_9", []), ("Bot_a", []))
    assert {r.vehicle_id for r in serving.search_routes(rows, " TRUCK_1").collect()} == {"Truck_10"}
    assert serving.search_routes(rows, "  ").count() == 3
    assert [r.vehicle_id for r in serving.order_vehicles(rows).collect()] == ["Bot_a", "Truck_9", "Truck_10"]


def test_heat_and_classes(spark, make_edges):
    traffic = spark.createDataFrame([("E_a_b", 3.0), ("E_b_c", 27.1), ("E_x", 1.0)], "edge_id string, avg_speed double")
    assert [(r.edge_id, round(r.intensity, 6)) for r in serving.heat_points(traffic, roads(make_edges)).collect()] == [("E_a_b", 0.9)]
    got = {r.edge_id: r.speed_class for r in serving.edge_speed_class(roads(make_edges), traffic).collect()}
    assert got == {"E_a_b": "slow", "E_b_c": "fast", "E_d_e": "none"}


def test_requests(spark):
    customers = "customers array<struct<cust_id:string,latitude:double,longitude:double>>"
    req = spark.createDataFrame([("v", 1.0, 1.0, [("own", 1.0, 1.0)]), ("w", 1.0, 1.0, []), ("x", 1.0, 1.0, None), ("y", None, 1.0, None)],
                                f"vehicle_id string, lat double, lon double, {customers}")
    stored = spark.createDataFrame([("v", [("a", 1.0, 1.0)]), ("w", [("b", 1.0, 1.0)])],
                                   f"vehicle_id string, remaining_{customers}")
    got = {r.vehicle_id: ([c.cust_id for c in r.customers or []], r.error) for r in serving.resolve_request_stops(req, stored).collect()}
    assert got == {"v": (["own"], None), "w": (["b"], None), "x": ([], "No customers"), "y": ([], "Missing lat/lon")}


def test_samples_repeat_and_follow_weights(spark, make_edges):
    edges = make_edges([edge_row(i, f"s{i}", f"t{i}", {f"s{i}": (21.0, 105.8), f"t{i}": (21.1, 105.8)}, 1000.0 if i < 20 else 0.001)
                        for i in range(400)])
    even = sampling.sample_edges(edges, 10, seed=3)
    assert sorted(even.collect()) == sorted(sampling.sample_edges(edges.repartition(7), 10, seed=3).collect())
    heavy = sampling.sample_edges(edges, 10, seed=3, weighted=True)
    assert heavy.filter(F.col("length_meters") > 1).count() >= 9
