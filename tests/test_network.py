import pytest
from conftest import edge_row

from wayfleet.operators import network
from wayfleet.sources import maps

AT = {"a": (21.0, 105.80), "b": (21.01, 105.81), "c": (21.02, 105.82), "d": (21.5, 105.9)}

OSM = """<?xml version="1.0"?><osm>
<node id="1" lat="21.0" lon="105.80"/><node id="2" lat="21.01" lon="105.81"/><node id="3" lat="21.01" lon="105.81"/>
<way id="10"><nd ref="1"/><nd ref="2"/><nd ref="3"/><nd ref="9"/><tag k="highway" v="primary"/><tag k="maxspeed" v="50 mph"/>
  <tag k="maxspeed" v="60"/><tag k="oneway" v="yes"/><tag k="name" v="First"/><tag k="name" v="Last"/></way>
<way id="11"><nd ref="2"/><nd ref="1"/><tag k="highway" v="residential"/><tag k="oneway" v="-1"/></way>
<way id="12"><nd ref="1"/><nd ref="2"/><tag k="highway" v="footway"/></way>
<way id="13"><nd ref="3"/><nd ref="1"/><tag k="highway" v="tertiary"/></way>
</osm>"""


def test_map_file_to_edges(spark, tmp_path):
    path = tmp_path / "map.osm"
    path.write_text(OSM)
    nodes, ways = maps.read_osm(spark, str(path))
    edges = network.segment_ways(network.read_way_tags(ways), nodes)
    rows = {(r.edge_id, r.road_name, r.max_speed_kmh) for r in edges.collect()}
    # 2-3 has no length, 3-9 has no node, way 12 may not be driven, way 11 is turned round.
    assert rows == {("E_1_2", "Last", 60.0), ("E_1_2", "Đường không tên", 40.0),
                    ("E_3_1", "Đường không tên", 40.0), ("E_1_3", "Đường không tên", 40.0)}
    kept = network.dedupe_edges(edges).filter("edge_id = 'E_1_2'").first()
    assert kept.road_name == "Đường không tên"                       # last definition wins


def test_long_ways_number_every_edge_once(spark):
    n = 3000
    nodes = spark.createDataFrame([(str(i), 21 + i / 1e5, 105.8) for i in range(n)], "node_id string, lat double, lon double")
    ways = spark.createDataFrame([(7, [str(i) for i in range(n)], "primary", "no", "long", 40.0), (8, ["0", "2"], "primary", "no", "next", 40.0)],
                                 "way_id long, refs array<string>, highway string, oneway string, road_name string, max_speed_kmh double")
    edges = network.segment_ways(ways, nodes)
    assert edges.count() == edges.select("edge_seq").distinct().count() == 2 * (n - 1) + 2
    assert edges.filter("road_name = 'long'").agg({"edge_seq": "max"}).first()[0] < edges.filter("road_name = 'next'").agg({"edge_seq": "min"}).first()[0]


def test_clip_job_keeps_the_source(spark, make_edges, tmp_path):
    edges = make_edges([edge_row(0, "a", "b", AT), edge_row(2, "b", "d", AT)])
    full = str(tmp_path / "full")
    maps.write_edges(edges, full)
    clipped = maps.clip_edges_job(spark, full, str(tmp_path / "clip"), "DongDa")
    assert [r.edge_id for r in clipped.collect()] == ["E_a_b"]
    assert maps.read_edges(spark, full).count() == 2
    with pytest.raises(ValueError):
        maps.clip_edges_job(spark, full, full, "DongDa")


def test_edge_array_file(spark, tmp_path):
    path = tmp_path / "edges.json"
    path.write_text('[{"edge_id":"E_1_2","max_speed_kmh":40,"start_node":{"node_id":"1","lat":1,"lon":2},'
                    '"end_node":{"node_id":"2","lat":1,"lon":3},"length_meters":5},{"edge_id":"E_x","start_node":null}]')
    edges = maps.read_edges(spark, str(path), "json_array")
    assert edges.count() == 2 and edges.select("edge_seq").distinct().count() == 2
    assert [r.edge_id for r in network.valid_edges(edges).collect()] == ["E_1_2"]


def test_nodes_sinks_and_endpoints(spark, make_edges):
    edges = make_edges([edge_row(0, "a", "b", AT), edge_row(2, "b", "c", AT)])
    assert [r.node_id for r in network.nodes_of(edges).orderBy("node_seq").collect()] == ["a", "b", "c"]
    links = {(r.node_id, r.to_node) for r in network.adjacency(edges).collect()}
    assert links == {("a", "b"), ("b", "c"), ("c", None)}
    asked = spark.createDataFrame([("E_a_b",), ("E_zz",)], "edge_id string")
    ends = {r.edge_id: (r.start_id, r.end_id) for r in network.edge_endpoints(asked, edges).collect()}
    assert ends == {"E_a_b": ("a", "b"), "E_zz": (None, None)}
    assert network.has_edges(edges) and not network.has_edges(edges.limit(0))


def test_positions_follow_the_order(spark):
    df = spark.range(0, 5000).selectExpr("(id * 7919) % 5000 * 3 as k")
    rows = network.with_position(df, "k").orderBy("k").collect()
    assert [r.position for r in rows] == list(range(5000))


def test_components_of_a_long_chain_and_islands(spark):
    chain = spark.range(0, 300).selectExpr("lpad(id, 4, '0') as a", "lpad(id + 1, 4, '0') as b")
    island = spark.createDataFrame([("x", "y"), ("z", "y")], "a string, b string")
    parts = network.components_of_links(chain.unionByName(island))
    sizes = {r.component: r["count"] for r in parts.groupBy("component").count().collect()}
    assert sizes == {"0000": 301, "x": 3}


def test_largest_component(spark, make_edges):
    edges = make_edges([edge_row(0, "a", "b", AT), edge_row(2, "b", "c", AT),
                        edge_row(4, "d", "d2", {**AT, "d2": (21.6, 105.9)})])
    assert {r.edge_id for r in network.largest_component(edges).collect()} == {"E_a_b", "E_b_c"}
