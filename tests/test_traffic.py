from datetime import datetime, timezone

import pytest
from conftest import edge_row

from wayfleet.operators import matching, traffic
from wayfleet.sources import pings as P
from wayfleet.sources import tables
from wayfleet.streaming import jobs

T0 = 1_704_067_200_000
AT = {"a": (21.0, 105.80), "b": (21.01, 105.80), "c": (21.0, 105.85), "d": (21.01, 105.85)}
PING = "entity_id string, entity_type string, latitude double, longitude double, speed double, timestamp long"


@pytest.fixture(scope="module")
def roads(make_edges):
    return make_edges([edge_row(0, "a", "b", AT, 210.0, 50.0), edge_row(2, "c", "d", AT, 700.0, 50.0)])


def ping(who, second, speed, lon=105.80, kind="Truck", lat=21.005):
    return (who, kind, lat, lon, speed, T0 + int(second * 1000))


def test_windows_by_hand(spark, roads):
    rows = spark.createDataFrame([ping("t1", 10, 10.0), ping("t1", 12, 20.0), ping("b", 11, 3.0, kind="Walker"),
                                  ping("t2", 10, 5.0, lat=None)], PING)
    matched = matching.match_pings(traffic.clean_pings(rows), matching.edge_index(roads))
    got = {int((r.window_start.replace(tzinfo=timezone.utc) - datetime(2024, 1, 1, tzinfo=timezone.utc)).total_seconds()):
           (r.avg_speed, r.vehicle_count, r.distinct_vehicles) for r in traffic.edge_speed(matched, distinct_vehicles=True).collect()}
    assert got == {3: (15.0, 2, 1), 6: (15.0, 2, 1), 9: (15.0, 2, 1), 12: (20.0, 1, 1)}


def test_state_payload_and_limits(spark, roads):
    rows = spark.createDataFrame([ping("t1", 0, 25.0), ping("t2", 0, 0.0, 105.85), ping("t3", 100, 4.9, 105.85)], PING)
    matched = matching.match_pings(traffic.clean_pings(rows), matching.edge_index(roads))
    states = traffic.edge_state(matched, roads)
    row = states.filter("edge_id = 'E_a_b'").first()
    assert (row.avg_speed, row.vehicle_count, row.distance, row.max_speed, row.estimated_travel_time) == (25.0, 1, 210.0, 50.0, 30.24)
    assert not row.is_congested and row.updated_at.startswith("2024-01-01T00:00:")
    assert states.filter("avg_speed = 0").isEmpty()                       # a stopped edge is not published
    assert [r.edge_id for r in traffic.blocked_edges(states).collect()] == ["E_c_d"]
    last = traffic.state_of(states, "E_c_d").first().last_updated
    for after, alive in ((119_000, True), (120_000, False), (121_000, False)):
        assert traffic.live_edge_state(states, last + after).filter("edge_id = 'E_c_d'").isEmpty() is not alive
    assert traffic.blocked_edges(states, expire_at_ms=last + 120_000).isEmpty()
    assert traffic.blocked_edges(states).count() == 1                     # but it stays blocked by default


def test_unknown_edges_get_defaults(spark, roads):
    ids = spark.createDataFrame([("E_a_b",), ("E_zz",)], "edge_id string")
    got = {r.edge_id: (r.edge_length_m, r.edge_max_speed, r.road_name) for r in traffic.enrich_edges(ids, roads).collect()}
    assert got == {"E_a_b": (210.0, 50.0, "road"), "E_zz": (500.0, 40.0, "UNKNOWN")}


def test_positions_and_ticks(spark):
    rows = spark.createDataFrame([ping("t1", 0.1, 1.0), ping("t1", 0.9, 2.0), ping("t1", 1.0, 3.0), ping("b", 0, 9.0, kind="Bot")], PING)
    assert [(r.id, r.speed) for r in traffic.latest_positions(rows).collect()] == [("t1", 3.0)]
    ticks = traffic.conflate_positions(traffic.with_event_time(rows)).orderBy("tick").collect()
    assert [r.speed for r in ticks] == [2.0, 3.0]


def test_occupancy(spark, roads):
    rows = spark.createDataFrame([("E_a_b",)] * 60 + [("UNKNOWN",)], "edge_id string")
    r = traffic.edge_occupancy(rows, roads).first()
    assert (r.vehicles, round(r.density, 3), r.expected_speed, r.capacity, r.at_capacity) == (60, 285.714, 2.5, 52.5, True)


def test_malformed_payloads_are_dropped(spark):
    raw = spark.createDataFrame([('{"entity_id":"t","entity_type":"Truck","latitude":1.5,"longitude":2,"speed":3,"timestamp":4}',),
                                 ("{broken",), ('{"entity_type":"Truck","latitude":1}',)], "value string")
    assert [r.entity_id for r in traffic.clean_pings(P.decode_pings(raw)).collect()] == ["t"]


# ---- streams ------------------------------------------------------------
def feed(spark, folder, name, rows):
    part = folder / name
    P.encode_pings(spark.createDataFrame(rows, PING)).select("value").coalesce(1).write.text(str(part))


def stream_of(spark, folder):
    (folder / "empty").mkdir(parents=True, exist_ok=True)
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    return P.decode_pings(reader.load(str(folder)))


def test_stream_equals_batch_and_restarts(spark, roads, tmp_path):
    index = matching.edge_index(roads)
    source, state, archive = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "archive")
    source.mkdir()
    first = [ping(f"t{i}", i, 4.0 + i) for i in range(6)]
    second = [ping(f"t{i}", 6 + i, 8.0 + i, 105.85) for i in range(6)]
    feed(spark, source, "1", first)

    def run():
        matched = jobs.matched_stream(stream_of(spark, source), index)
        a = jobs.start_edge_state(matched, roads, state, str(tmp_path / "c1"), every=None)
        b = jobs.start_archive(matched, archive, str(tmp_path / "c2"), every=None)
        a.awaitTermination(), b.awaitTermination()

    run()
    feed(spark, source, "2", second)
    run()                                                                 # goes on from its checkpoint
    rows = spark.createDataFrame(first + second, PING)
    batch = traffic.latest_edge_state(traffic.edge_state(matching.match_pings(traffic.clean_pings(rows), index), roads))
    assert sorted(tables.read_state(spark, state).collect()) == sorted(batch.collect())
    assert spark.read.parquet(archive).count() == 12


def test_late_pings_are_archived_but_not_averaged(spark, roads, tmp_path):
    index = matching.edge_index(roads)
    source, state, archive = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "archive")
    source.mkdir()
    steps = [[ping("t1", 0, 10.0)], [ping("t2", 300, 20.0)], [ping("t3", 1, 50.0)]]
    for i, rows in enumerate(steps):
        feed(spark, source, str(i), rows)
        matched = jobs.matched_stream(stream_of(spark, source), index)
        jobs.start_edge_state(matched, roads, state, str(tmp_path / "c1"), every=None).awaitTermination()
        jobs.start_archive(matched, archive, str(tmp_path / "c2"), every=None).awaitTermination()
    assert spark.read.parquet(archive).count() == 3
    log = spark.read.parquet(state)
    assert log.agg({"vehicle_count": "max"}).first()[0] == 1 and log.filter("avg_speed > 20").isEmpty()


def test_replayed_batch_changes_nothing_and_compaction_keeps_rows(spark, roads, tmp_path):
    rows = spark.createDataFrame([ping("t1", 0, 10.0), ping("t2", 30, 4.0)], PING)
    windows = traffic.edge_speed(matching.match_pings(traffic.clean_pings(rows), matching.edge_index(roads)))
    path = str(tmp_path / "state")
    publish = jobs.publish_edge_state(roads, path)
    publish(windows, 0)
    before = tables.read_state(spark, path).collect()
    publish(windows, 0)
    publish(windows.limit(0), 1)                                          # an empty batch is skipped
    assert tables.read_state(spark, path).collect() == before
    assert tables.compact_state(spark, path, str(tmp_path / "small")).collect() == before
    older = windows.filter("window_end < timestamp'2024-01-01 00:00:20'")
    publish(older, 2)                                                     # an older window arriving later
    assert tables.read_state(spark, path).collect() == before


def test_one_call_archives_and_publishes(spark, roads, tmp_path):
    """A network beyond one array, in one call; the same as the batch operators."""
    index = matching.edge_index(roads, array_limit=1, dense_mean=1000)
    source = tmp_path / "in"
    source.mkdir()
    rows = [ping("t1", 0, 10.0), ping("t2", 1, 10.0, 105.85), ping("t3", 1, 1.0, 0.0, lat=0.0), ping("t1", 40, 30.0)]
    feed(spark, source, "1", rows)
    for query in jobs.start_traffic(stream_of(spark, source), index, roads, str(tmp_path / "job"), every=None):
        query.awaitTermination()
    matched = matching.match_pings(traffic.clean_pings(spark.createDataFrame(rows, PING)), index)
    want = traffic.archive_rows(matched).select("entity_id", "timestamp", "edge_id")
    got = spark.read.parquet(str(tmp_path / "job" / "archive")).select("entity_id", "timestamp", "edge_id")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 4
    state = traffic.latest_edge_state(traffic.edge_state(matched, roads)).select("edge_id", "avg_speed", "vehicle_count", "last_updated")
    assert sorted(tables.read_state(spark, str(tmp_path / "job" / "state")).select(*state.columns).collect()) == sorted(state.collect())


def test_key_value_form(spark):
    states = spark.createDataFrame([("E_1", 25.0, 20, 210.0, 50.0, 30.5, False, "t", 5)],
                                   "edge_id string, avg_speed double, vehicle_count long, distance double, max_speed double, "
                                   "estimated_travel_time double, is_congested boolean, updated_at string, last_updated long")
    rows = tables.state_as_json(states)
    assert rows.first().key == "edge:E_1" and tables.state_from_json(rows).collect() == states.collect()
