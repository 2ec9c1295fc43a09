import math

from pyspark.sql import functions as F

from wayfleet.functions import geo
from wayfleet.functions import scalars as X


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def haversine(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 6_371_000.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_distances(spark):
    a, b = (21.01, 105.81), (21.03, 105.84)
    r = one(spark, geo.haversine_m(*a, *b), geo.haversine_m(*b, *a), geo.haversine_km(*a, *b),
            geo.haversine_km(0.0, 0.0, 0.0, 180.0), geo.haversine_m(*a, *a))
    assert math.isclose(r[0], haversine(*a, *b), rel_tol=1e-12) and r[0] == r[1]
    assert math.isclose(r[2] * 1000, r[0], rel_tol=1e-9)
    assert math.isclose(r[3], math.pi * 6371.0) and r[4] == 0.0


def test_point_to_segment(spark):
    r = one(spark,
            geo.point_segment_m(0.5, 1.0, 0.0, 0.0, 1.0, 0.0),       # beside the middle
            geo.point_segment_m(2.0, 0.0, 0.0, 0.0, 1.0, 0.0),       # beyond the end
            geo.point_segment_m(1.0, 1.0, 0.5, 0.5, 0.5, 0.5))       # no length
    assert math.isclose(r[0], haversine(0.5, 1.0, 0.5, 0.0))
    assert math.isclose(r[1], haversine(2.0, 0.0, 1.0, 0.0))
    assert math.isclose(r[2], haversine(1.0, 1.0, 0.5, 0.5))


def test_interpolation_and_midpoint(spark):
    r = one(spark, geo.interpolate(1.0, 3.0, 25.0, 100.0), geo.interpolate(1.0, 3.0, 25.0, 0.0), geo.midpoint(F.lit(1.0), F.lit(2.0)))
    assert tuple(r) == (1.5, 1.0, 1.5)


def test_conversions(spark):
    r = one(spark, X.to_int(F.lit("12.9")), X.to_int(F.lit("x"), 7), X.to_float(F.lit(" 3.5 ")), X.to_float(F.lit(None)),
            X.to_bool(F.lit(" Yes ")), X.to_bool(F.lit("y")), X.to_bool_strict(F.lit("y")), X.to_bool(F.lit(None), True), X.to_str(F.lit(5)))
    assert tuple(r) == (12, 7, 3.5, 0.0, True, True, False, True, "5")


def test_texts(spark):
    r = one(spark, X.truck_id(F.lit(7)), X.seed_customer_id(F.lit(7), F.lit(2)), X.request_key(F.lit("V"), F.lit(5)),
            X.after_first_colon(F.lit("edge:E:1")), X.without_edge_prefix(F.lit("edge:E_1")), X.short_truck_id(F.lit("tRuck_001")),
            X.number_in_id(F.lit("Truck_012")).cast("int"), X.number_in_id(F.lit("none")).cast("int"))
    assert tuple(r) == ("Truck_007", "Cust_T007_2", "OPT_V_5", "E:1", "E_1", "001", 12, 0)


def test_eta_and_shown_speed(spark):
    r = one(spark, X.eta_text(F.lit(None).cast("double")), X.eta_text(F.lit(90.0)), X.eta_text(F.lit(600000.0)),
            X.eta_text(F.lit(float("nan"))), X.display_speed(F.lit(0.4)), X.display_speed(F.lit(0.0)), X.display_speed(F.lit(41.6)))
    assert tuple(r) == ("—", "1.5 phút", "166.7 giờ", "—", 3, 0, 42)


def test_traffic_arithmetic(spark):
    r = one(spark, X.travel_time_s(F.lit(210.0), F.lit(25.0)), X.static_cost_s(F.lit(100.0), F.lit(36.0)),
            X.static_cost_s(F.lit(100.0), F.lit(0.0)), X.static_cost_s(F.lit(0.0), F.lit(0.5)),
            X.is_congested(F.lit(5.0)), X.triggers_reroute(F.lit(5.0)), X.triggers_reroute(F.lit(0.0)),
            X.speed_class(F.lit(None).cast("double")), X.speed_class(F.lit(5.0)), X.speed_class(F.lit(15.0)), X.speed_class(F.lit(15.1)),
            X.expected_speed(F.lit(50.0), F.lit(125.0)), X.expected_speed(F.lit(50.0), F.lit(250.0)), X.edge_capacity(F.lit(100.0)))
    assert math.isclose(r[0], 30.24) and math.isclose(r[1], 10.0) and math.isclose(r[2], 9.0) and math.isclose(r[3], 3.6)
    assert tuple(r)[4:] == (False, True, False, "none", "slow", "medium", "fast", 25.0, 2.5, 25.0)


def test_split_path(spark):
    path = F.array(*[F.lit(x) for x in "abcd"])
    r = one(spark, *X.split_path(path, F.lit(2)), *X.split_path(path, F.lit(None).cast("int")))
    assert [list(x) for x in r] == [["a", "b"], ["c", "d"], [], ["a", "b", "c", "d"]]
