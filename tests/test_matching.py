import numpy as np
import pytest
from conftest import edge_row

from wayfleet.operators import matching, nearest, network, shortlist
from wayfleet.schemas import EDGE

R = 6_371_000.0


def brute(points, segs):
    """Index of the nearest segment per point, and all distances."""
    out = []
    for plat, plon in points:
        a, b = segs[:, :2], segs[:, 2:]
        d = b - a
        sq = (d ** 2).sum(1)
        t = np.where(sq > 0, ((np.array([plat, plon]) - a) * d).sum(1) / np.where(sq > 0, sq, 1), 0)
        t = np.clip(t, 0, 1)
        f = a + t[:, None] * d
        p1, p2 = np.radians(plat), np.radians(f[:, 0])
        h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(f[:, 1] - plon) / 2) ** 2
        out.append(R * 2 * np.arctan2(np.sqrt(h), np.sqrt(1 - h)))
    return np.array(out)


def network_of(spark, segs):
    rows = [edge_row(i, f"{i}s", f"{i}e", {f"{i}s": tuple(map(float, s[:2])), f"{i}e": tuple(map(float, s[2:]))}, edge_id=f"E{i}")
            for i, s in enumerate(segs)]
    return spark.createDataFrame(rows, EDGE)


def streets(rng, n):
    """Short streets, most of them in one dense corner, and a few long ones."""
    start = np.column_stack([21 + rng.beta(0.6, 3, n) * 0.05, 105.8 + rng.beta(0.6, 3, n) * 0.05])
    return np.hstack([start, start + rng.normal(0, 0.0006, (n, 2)) * np.where(rng.random(n) < 0.05, 30, 1)[:, None]])


@pytest.mark.parametrize("options", [
    {}, {"dense_mean": 4, "rows_per_shape": 64}, {"dense_mean": 4, "array_limit": 64}, {"dense_mean": 100_000, "array_limit": 50}])
def test_same_as_comparing_every_pair(spark, options):
    rng = np.random.default_rng(5)
    segs = streets(rng, 700)
    inside = np.column_stack([21 + rng.random(300) * 0.05, 105.8 + rng.random(300) * 0.05])
    outside = np.array([[0.0, 0.0], [0.0, 0.0], [21.4, 105.8], [20.9, 106.4], [-60.0, -170.0]])
    points = np.vstack([inside, segs[:40, :2], outside, inside[:3]])
    index = matching.edge_index(network_of(spark, segs), **options)
    pings = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "i int, latitude double, longitude double")
    got = matching.match_pings(pings, index, with_distance=True).orderBy("i").collect()
    dist = brute(points, segs)
    assert len(got) == len(points)
    for row, d in zip(got, dist):
        assert d[int(row.edge_id[1:])] <= d.min() + 1e-6
        assert abs(row.match_distance_m - d.min()) < 1e-6


def test_batches_on_large_networks_of_long_streets_need_no_deep_cells(spark):
    rng = np.random.default_rng(11)
    segs = np.hstack([rng.random((300, 2)), rng.random((300, 2))]) * 0.05 + [21, 105.8, 21, 105.8]
    segs[7, 2:] = segs[7, :2]                                                # no length
    index = matching.edge_index(network_of(spark, segs), array_limit=100)
    points = np.vstack([21 + rng.random((400, 2)) * 0.05 + [0, 84.8], segs[:30, 2:], np.tile(segs[3, :2], (50, 1))])
    pings = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)] + [(999, None, 105.8)],
                                  "i int, latitude double, longitude double")
    got = matching.match_pings(pings, index, with_distance=True).orderBy("i").collect()
    assert "_deep" not in vars(index) and len(got) == len(points) + 1 and got[-1].edge_id == "UNKNOWN"
    for row, d in zip(got, brute(points, segs)):
        assert row.edge_id == f"E{np.flatnonzero(d <= d.min() + 1e-9)[0]}" and abs(row.match_distance_m - d.min()) < 1e-6


def test_points_keep_few_candidates_and_all_that_tie():
    rng = np.random.default_rng(4)
    a, b = rng.random((2, 3000)), rng.random((2, 3000))
    a[:, :40] = [[0.5], [0.5]]                                               # forty streets leave one node
    d = b - a
    offsets, numbers = shortlist.shortlist("road", np.r_[0.5, rng.random(2000)], np.r_[0.5, rng.random(2000)],
                                           np.vstack([a, d, 1 / (d ** 2).sum(0)[None]]), 2.0 * nearest.METRES_PER_DEGREE, 1e-3)
    assert set(numbers[:offsets[1]]) == set(range(40)) and len(numbers) < 40 + 2000 * 2 and (np.diff(offsets) > 0).all()


def test_streams_match_like_batches_on_networks_beyond_one_array(spark, tmp_path):
    rng = np.random.default_rng(8)
    index = matching.edge_index(network_of(spark, streets(rng, 5000)))
    assert index.n_shapes > nearest.ARRAY_LIMIT and not index.in_one_row
    points = [(i, float(21 + a * 0.06), float(105.8 + b * 0.06)) for i, (a, b) in enumerate(rng.random((60, 2)))]
    points += [(100, 0.0, 0.0), (101, 50.0, 106.0), (102, None, 105.8)]
    pings = spark.createDataFrame(points, "i int, latitude double, longitude double")
    pings.write.parquet(str(tmp_path / "in"))
    stream = matching.match_pings(spark.readStream.schema(pings.schema).parquet(str(tmp_path / "in")), index)
    (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
     .trigger(availableNow=True).start().awaitTermination())
    key = lambda r: r.i
    got = sorted(spark.read.parquet(str(tmp_path / "out")).select("i", "edge_id").collect(), key=key)
    assert got == sorted(matching.match_pings(pings, index).select("i", "edge_id").collect(), key=key)
    assert [r.edge_id == "UNKNOWN" for r in got][-3:] == [False, False, True]


def test_equal_points_keep_their_number_without_a_key(spark):
    rng = np.random.default_rng(1)
    index = matching.edge_index(network_of(spark, streets(rng, 200)), dense_mean=1000, array_limit=20)
    assert index.parts > 1 and not index.in_one_row
    pings = spark.createDataFrame([(21.01, 105.81)] * 5 + [(0.0, 0.0)] * 3, "latitude double, longitude double")
    assert matching.match_pings(pings, index).groupBy("latitude").count().orderBy("latitude").collect()[1]["count"] == 5


def test_first_edge_wins_between_directions_and_at_shared_nodes(spark, make_edges):
    at = {"a": (21.0, 105.8), "b": (21.01, 105.8), "c": (21.02, 105.81)}
    edges = make_edges([edge_row(5, "b", "a", at), edge_row(2, "a", "b", at), edge_row(9, "b", "c", at), edge_row(7, "c", "b", at)])
    index = matching.edge_index(edges)
    pings = spark.createDataFrame([("side", 21.005, 105.801), ("node", 21.01, 105.8), ("none", None, 105.8)],
                                  "n string, latitude double, longitude double")
    got = {r.n: r.edge_id for r in matching.match_pings(pings, index).collect()}
    assert got == {"side": "E_a_b", "node": "E_a_b", "none": "UNKNOWN"}


def test_no_network_means_unknown(spark, make_edges):
    index = matching.edge_index(make_edges([]))
    pings = spark.createDataFrame([(1.0, 2.0)], "latitude double, longitude double")
    assert matching.match_pings(pings, index).first().edge_id == "UNKNOWN"


def test_salts_do_not_change_the_result(spark):
    rng = np.random.default_rng(2)
    index = matching.edge_index(network_of(spark, streets(rng, 300)), dense_mean=8)
    pings = spark.createDataFrame([(i, float(21 + a * 0.05), float(105.8 + b * 0.05)) for i, (a, b) in enumerate(rng.random((200, 2)))],
                                  "i int, latitude double, longitude double")
    plain = matching.match_pings(pings, index).orderBy("i").collect()
    assert plain == matching.match_pings(pings, index, salts=4).orderBy("i").collect()


def test_nearest_nodes(spark):
    rng = np.random.default_rng(3)
    nodes = rng.random((400, 2)) * 0.05 + [21, 105.8]
    table = spark.createDataFrame([(i, f"n{i}", float(a), float(b)) for i, (a, b) in enumerate(nodes)],
                                  "node_seq long, node_id string, lat double, lon double")
    points = np.vstack([rng.random((200, 2)) * 0.06 + [20.995, 105.795], [[0.0, 0.0]]])
    rows = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "i int, latitude double, longitude double")
    got = matching.nearest_node(rows, matching.node_index(table, dense_mean=4)).orderBy("i").collect()
    want = [f"n{((nodes - p) ** 2).sum(1).argmin()}" for p in points]
    assert [r.node_id for r in got] == want


def test_departure_nodes_exclude_sinks(spark, make_edges):
    at = {"a": (21.0, 105.8), "b": (21.01, 105.8)}
    edges = make_edges([edge_row(0, "a", "b", at)])
    index = matching.node_index(matching.with_outgoing(network.nodes_of(edges), edges))
    near_b = spark.createDataFrame([(21.01, 105.8)], "latitude double, longitude double")
    assert matching.nearest_node(near_b, index).first().node_id == "a"
