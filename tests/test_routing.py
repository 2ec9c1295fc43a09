import heapq
import math
import random

import numpy as np
import pytest
from conftest import edge_row

from wayfleet.operators import balls, relax, routing
from wayfleet.operators.network import nodes_of


def solve(arcs, source):
    """Plain single-source costs to compare with."""
    out = {}
    for s, d, c in arcs:
        out.setdefault(s, []).append((d, c))
    best, heap = {source: 0.0}, [(0.0, source)]
    while heap:
        c, n = heapq.heappop(heap)
        if c > best[n]:
            continue
        for d, w in out.get(n, []):
            if c + w < best.get(d, math.inf):
                best[d] = c + w
                heapq.heappush(heap, (c + w, d))
    return best


def cost_table(spark, arcs):
    return spark.createDataFrame([(i, f"E{i}", s, d, float(c)) for i, (s, d, c) in enumerate(arcs)],
                                 "edge_seq long, edge_id string, src string, dst string, cost double")


@pytest.mark.parametrize("n,degree,sources", [(60, 3, 3), (40, 2, 40)])
def test_costs_and_paths(spark, n, degree, sources):
    rng = random.Random(n)
    arcs = [(f"n{i}", f"n{rng.randrange(n)}", rng.uniform(1, 9)) for i in range(n) for _ in range(degree)]
    arcs += [("n0", "n1", 3.0), ("n0", "n1", 2.0), ("x", "y", 1.0)]
    pairs = [(f"n{s}", f"n{t}") for s in range(sources) for t in range(n)] + [("n0", "y"), ("zz", "n0"), ("n0", "zz"), ("y", "x")]
    found = routing.shortest_paths(spark.createDataFrame(pairs, "source string, target string"), cost_table(spark, arcs)).collect()
    assert len(found) == len(set(pairs))
    weight = {f"E{i}": a for i, a in enumerate(arcs)}
    for r in found:
        want = solve(arcs, r.source).get(r.target, math.inf) if r.source != "zz" else math.inf
        assert r.cost == want or math.isclose(r.cost, want)
        if 0 < want < math.inf:
            assert weight[r.path[0]][0] == r.source and weight[r.path[-1]][1] == r.target
            assert all(weight[a][1] == weight[b][0] for a, b in zip(r.path, r.path[1:]))
            assert math.isclose(sum(weight[e][2] for e in r.path), r.cost)
        else:
            assert r.path == []


def test_search_in_tasks_is_that_of_labels(spark, monkeypatch):
    rng = random.Random(3)
    arcs = [(f"n{i}", f"n{rng.randrange(30)}", rng.choice([1.0, 2.0, 0.1])) for i in range(30) for _ in range(3)]     # many ties
    pairs = spark.createDataFrame([(f"n{s}", f"n{t}") for s in range(30) for t in range(0, 30, 3)], "source string, target string")
    costs = cost_table(spark, arcs)

    def refuse(*_):
        raise AssertionError("labels of every node were written for a network that a task can hold")

    def rows(**kw):
        return sorted(map(tuple, routing.shortest_paths(pairs, costs, **kw).collect()))
    with monkeypatch.context() as m:
        m.setattr(routing, "_labels", refuse)
        paths, prices = rows(), rows(with_path=False)
    monkeypatch.setattr(routing, "ARCS_IN_TASK", 0)
    assert rows() == paths and [r[:3] for r in paths] == prices


def random_arcs(nodes, degree, seed, costs):
    rng = np.random.default_rng(seed)
    src, dst = (rng.integers(0, nodes, nodes * degree) for _ in range(2))
    return src, dst, costs(rng, len(src))


def street_arcs(side):
    """A grid of streets of equal length, where nearly every pair has many cheapest paths; the last row is one-way."""
    at = np.arange(side * side).reshape(side, side)
    pairs = np.concatenate([np.c_[at[:, :-1].ravel(), at[:, 1:].ravel()], np.c_[at[:-1].ravel(), at[1:].ravel()]])
    src, dst = np.r_[pairs[:, 0], pairs[at[0, 0]:-side, 1]], np.r_[pairs[:, 1], pairs[at[0, 0]:-side, 0]]
    return src, dst, np.full(len(src), 0.1)


NETWORKS = {
    "random": (400, random_arcs(400, 3, 1, lambda rng, n: rng.uniform(1, 9, n))),
    "ties": (300, random_arcs(300, 3, 2, lambda rng, n: rng.choice([0.1, 0.2, 0.7], n))),
    "sparse": (300, random_arcs(300, 1, 3, lambda rng, n: rng.uniform(1, 9, n))),           # most pairs are not connected
    "streets": (144, street_arcs(12)),
}


@pytest.mark.parametrize("kind", NETWORKS)
@pytest.mark.parametrize("ball,give_up", [(1, 1), (4, 1), (20, 1), (20, 4), (1000, 1)])
def test_search_from_both_ends_is_that_over_all_nodes(kind, ball, give_up, monkeypatch):
    """Same costs to the last bit, same arcs of all cheapest paths."""
    monkeypatch.setattr(balls, "GIVE_UP", give_up)
    nodes, (src, dst, cost) = NETWORKS[kind]
    keep = src != dst
    order = np.lexsort((np.arange(keep.sum()), dst[keep]))
    src, dst, cost = src[keep][order], dst[keep][order], cost[keep][order]
    rng = np.random.default_rng(5)
    pairs = np.unique(rng.integers(0, nodes, (200, 2)), axis=0)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    starts, owner = np.unique(pairs[:, 0], return_inverse=True)
    asked = (starts, owner, pairs[:, 1], nodes, src, dst, cost, True)
    whole, met = relax._whole(*asked), relax._met(*asked, ball)
    for a, b in zip(whole, met, strict=True):
        assert np.array_equal(a, b)
    assert np.isfinite(whole[0]).any()


def test_search_from_both_ends_holds_few_nodes(monkeypatch):
    nodes = 20_000
    src, dst, cost = random_arcs(nodes, 4, 7, lambda rng, n: rng.uniform(1, 9, n))
    order = np.argsort(dst, kind="stable")
    held, clear = [], balls.Searches.clear

    def counted(self):
        held.append(len(self.labels()))
        clear(self)
    monkeypatch.setattr(balls.Searches, "clear", counted)
    starts, goals = np.arange(0, 60), np.arange(1000, 1060)
    by, to, ball = routing._grid(60, 60, nodes, 1)
    assert ball and (by, to) == (1, 1)
    costs, done, *_ = balls.search(starts, np.arange(60), goals, nodes, src[order], dst[order], cost[order], ball, False)
    assert done.all() and sum(held) < 120 * nodes / 10


def test_search_from_both_ends_in_lanes(spark, monkeypatch):
    rng = random.Random(3)
    arcs = [(f"n{i}", f"n{rng.randrange(60)}", rng.choice([1.0, 2.0, 0.1])) for i in range(60) for _ in range(3)]
    pairs = spark.createDataFrame([(f"n{s}", f"n{t}") for s in range(60) for t in range(0, 60, 3)], "source string, target string")
    network = routing.network_of(cost_table(spark, arcs))
    rows = sorted(map(tuple, routing.paths_between(pairs, network).collect()))
    monkeypatch.setattr(routing, "_grid", lambda *_: (2, 3, 4))
    assert sorted(map(tuple, routing.paths_between(pairs, network).collect())) == rows


def test_grid_of_lanes():
    assert routing._grid(1000, 1000, 1025, 8) == (32, 1, 0)                 # small network: whole searches from the sources
    by, to, ball = routing._grid(58_004, 19_200, 60_011, 8)
    assert (by, to) == (8, 1) and ball > 200                                # the fewer ends are searched from in each lane
    by, to, ball = routing._grid(10_000, 100_000, 60_011, 8)
    assert ball and by < to
    by, to, ball = routing._grid(10**7, 10**7, 10**6, 8)
    assert 10**7 * 2 * ball <= routing.HELD_IN_TASK * to                    # what a task holds stays bounded


def test_lane_keys_fill_all_partitions(spark):
    keys = spark.range(1).select(routing._lane_keys(spark, 13).alias("k")).first().k
    rows = spark.createDataFrame([(k,) for k in keys], "k int").repartition(13, "k")
    assert sorted(map(len, rows.rdd.glom().collect())) == [1] * 13


def test_long_chain(spark):
    arcs = [(f"{i:03d}", f"{i + 1:03d}", 1.0) for i in range(60)]
    r = routing.shortest_paths(spark.createDataFrame([("000", "060")], "source string, target string"), cost_table(spark, arcs)).first()
    assert r.cost == 60.0 and r.path == [f"E{i}" for i in range(60)]


AT = {k: (21.0 + i / 100, 105.8) for i, k in enumerate("abcdef")}


def test_live_costs(spark, make_edges):
    edges = make_edges([edge_row(0, "a", "b", AT), edge_row(2, "b", "c", AT), edge_row(4, "c", "d", AT), edge_row(6, "d", "e", AT, limit=0.0)])
    state = spark.createDataFrame([("E_a_b", 42.0, False), ("E_b_c", 0.0, False), ("E_c_d", 7.0, True)],
                                  "edge_id string, estimated_travel_time double, is_congested boolean")
    live = {r.edge_id: r.cost for r in routing.edge_costs(edges, state).collect()}
    assert live == {"E_a_b": 42.0, "E_b_c": 10.0, "E_d_e": pytest.approx(9.0)}
    blocked = spark.createDataFrame([("E_a_b",)], "edge_id string")
    assert {r.edge_id for r in routing.edge_costs(edges, None, blocked).collect()} == {"E_b_c", "E_c_d", "E_d_e"}


def setup(spark, make_edges):
    edges = make_edges([edge_row(0, "a", "b", AT), edge_row(2, "b", "c", AT, 50.0), edge_row(4, "c", "a", AT), edge_row(6, "b", "a", AT, 500.0),
                        edge_row(8, "e", "f", AT)])
    return routing.edge_costs(edges), nodes_of(edges)


def test_routes_skip_what_cannot_be_reached(spark, make_edges):
    costs, nodes = setup(spark, make_edges)
    starts = spark.createDataFrame([("v", "a"), ("w", "e"), ("x", None)], "vehicle_id string, node string")
    stops = spark.createDataFrame([("v", 0, "c"), ("v", 1, "e"), ("v", 2, "c"), ("v", 3, "b"), ("w", 0, "a"), ("x", 0, "a")],
                                  "vehicle_id string, stop_idx int, node_id string")
    got = {r.vehicle_id: (r.path, round(r.total_cost, 6), r.visited) for r in routing.build_routes(starts, stops, costs, nodes).collect()}
    assert got["v"] == (["E_a_b", "E_b_c", "E_c_a", "E_a_b"], 35.0, [0, 2, 3])
    assert got["w"] == ([], 0.0, []) and got["x"] == ([], 0.0, [])


@pytest.mark.parametrize("limit", [12, 1])
def test_stops_in_order_ask_for_one_leg_each(spark, make_edges, monkeypatch, limit):
    """All legs are priced for the vehicle only that has to leave a stop out."""
    monkeypatch.setattr(routing, "PAIR_LIMIT", limit)
    costs, nodes = setup(spark, make_edges)
    starts = spark.createDataFrame([("v", "a"), ("u", "b")], "vehicle_id string, node string")
    stops = spark.createDataFrame([("v", 0, "b"), ("v", 1, "c"), ("v", 2, "a"), ("v", 3, "c"), ("u", 0, "c"), ("u", 1, "f"), ("u", 2, "a"), ("u", 3, None)],
                                  "vehicle_id string, stop_idx int, node_id string")
    asked, search = [], routing.paths_between

    def watched(pairs, *rest):
        asked.append({tuple(r) for r in pairs.select("source", "target").collect()})
        return search(pairs, *rest)
    monkeypatch.setattr(routing, "paths_between", watched)
    got = {r.vehicle_id: (r.path, r.visited) for r in routing.build_routes(starts, stops, costs, nodes).collect()}
    assert got == {"v": (["E_a_b", "E_b_c", "E_c_a", "E_a_b", "E_b_c"], [0, 1, 2, 3]), "u": (["E_b_c", "E_c_a"], [0, 2])}
    assert asked[0] == {("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "f"), ("f", "a")}
    assert set().union(*asked[1:]) <= {(s, t) for s in "bcfa" for t in "cfa"} - asked[0]


@pytest.mark.parametrize("limit", [12, 1])
def test_greedy_keeps_or_drops_the_unreachable(spark, make_edges, monkeypatch, limit):
    monkeypatch.setattr(routing, "PAIR_LIMIT", limit)                     # 1: every leg is priced on demand
    costs, nodes = setup(spark, make_edges)
    starts = spark.createDataFrame([("v", "a")], "vehicle_id string, node string")
    stops = spark.createDataFrame([("v", 0, "e"), ("v", 1, "c"), ("v", 2, "b"), ("v", 3, "b"), ("v", 4, "f")],
                                  "vehicle_id string, stop_idx int, node_id string")
    ranks = {r.stop_idx: r["rank"] for r in routing.greedy_order(starts, stops, costs, nodes).collect()}
    assert ranks == {2: 1, 3: 2, 1: 3, 0: 4, 4: 5}
    r = routing.greedy_routes(starts, stops, costs, nodes).first()
    assert r.path == ["E_a_b", "E_b_c"] and r.visited == [2, 3, 1] and r.total_cost == pytest.approx(15.0)


def test_planar_order(spark):
    rows = spark.sql("""select 'v' as vehicle_id, 0d as start_lat, 0d as start_lon, array(
        named_struct('stop_idx', 0, 'latitude', 5d, 'longitude', 0d), named_struct('stop_idx', 1, 'latitude', 1d, 'longitude', 0d),
        named_struct('stop_idx', 2, 'latitude', 2d, 'longitude', 0d)) as stops""")
    assert routing.planar_greedy_order(rows).first().stop_order == [1, 2, 0]
