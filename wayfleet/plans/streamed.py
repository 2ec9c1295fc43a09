"""The streaming jobs run to the end over the ping view, written out as payload files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.schemas import EDGE_STATE, VEHICLE
from wayfleet.session import scratch_dir
from wayfleet.sources import pings, tables
from wayfleet.sources.versions import StateTable
from wayfleet.streaming import expiry, jobs, late

SLICES, FILES = 4, 4        # of a stream that has to come in several batches, and files of each


def folder(d, name: str) -> str:
    return f"{scratch_dir(d.spark)}/wayfleet/{name}-{uuid.uuid4().hex}"


def _payload_stream(d) -> DataFrame:
    path = folder(d, "payloads")
    rows = d.pings.select("entity_id", "entity_type", "latitude", "longitude", "speed", "timestamp")
    pings.encode_pings(rows).select("value").write.text(path)
    return pings.decode_pings(pings.read_payload_files(d.spark, path))


def _matched_stream(d, decoded: DataFrame, files: int | None = None) -> DataFrame:
    """Row by row while one candidate row serves every ping; beyond that each batch is matched and archived first.

    ``files``: of each batch of the archive, and of each trigger that reads it.
    """
    if d.edge_index.in_one_row:
        return jobs.matched_stream(decoded, d.edge_index)
    out = folder(d, "matched-archive")
    jobs.start_match_archive(decoded, d.edge_index, out, folder(d, "ckpt"), every=None, files=files).awaitTermination()
    return jobs.archived_stream(d.spark, out, files)


def edge_state(d) -> DataFrame:
    out = folder(d, "stream-state")
    matched = _matched_stream(d, _payload_stream(d))
    jobs.start_edge_state(matched, d.edges, out, folder(d, "ckpt"), every=None).awaitTermination()
    return tables.read_state(d.spark, out)


def traffic_job(d) -> DataFrame:
    """State published by the one-call job: match in the batch, archive, average, publish."""
    out = folder(d, "traffic-job")
    for query in jobs.start_traffic(_payload_stream(d), d.edge_index, d.edges, out, every=None):
        query.awaitTermination()
    return tables.read_state(d.spark, f"{out}/state")


def snapshot(d) -> DataFrame:
    """The traffic feed that a periodic reader takes from the published state."""
    out = folder(d, "stream-state")
    matched = _matched_stream(d, _payload_stream(d))
    jobs.start_edge_state(matched, d.edges, out, folder(d, "ckpt"), every=None).awaitTermination()
    return jobs.traffic_snapshot_rows(d.spark, out)


def conflation(d) -> DataFrame:
    """Newest position per truck and second, as the stream gives them out."""
    out = folder(d, "stream-positions")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    (jobs.conflated_stream(_payload_stream(d)).writeStream.outputMode("update").foreachBatch(write)
     .option("checkpointLocation", folder(d, "ckpt")).trigger(availableNow=True).start().awaitTermination())
    return d.spark.read.parquet(out).drop("batch")


def archive(d) -> DataFrame:
    out = folder(d, "stream-archive")
    jobs.start_archive(_matched_stream(d, _payload_stream(d)), out, folder(d, "ckpt"), every=None).awaitTermination()
    return _daily(d.spark.read.parquet(out))


def match_archive(d) -> DataFrame:
    out = folder(d, "match-archive")
    jobs.start_match_archive(_payload_stream(d), d.edge_index, out, folder(d, "ckpt"), every=None).awaitTermination()
    return _daily(d.spark.read.parquet(out).withColumn("event_date", F.to_date("event_time")))


def _daily(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "edge_id").agg(
        F.count(F.lit(1)).alias("pings"), F.round(F.sum("speed"), 2).alias("speed_sum"))


def route_changes(d) -> DataFrame:
    """Every logged route update as a document, read back as a stream of effective routes."""
    log, out = folder(d, "route-log"), folder(d, "route-feed")
    (d.updates.select("vehicle_id", F.col("path").alias("new_assigned_route"), F.col("time").alias("estimated_total_travel_time"),
                      F.array(F.concat(F.lit("old_"), "vehicle_id")).alias("assigned_route")).write.parquet(log))
    changes = jobs.route_changes(d.spark.readStream.schema(VEHICLE).parquet(log))
    (changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(d, "ckpt"))
     .trigger(availableNow=True).start().awaitTermination())
    return d.spark.read.parquet(out).groupBy("vehicle_id", F.concat_ws(",", "path").alias("path")).agg(F.count(F.lit(1)).alias("changes"))


def _in_slices(rows: DataFrame, time: str, write) -> None:
    """Write ``rows`` in order of time, slice by slice, each as the same number of files: one trigger's worth."""
    cuts = rows.approxQuantile(time, [i / SLICES for i in range(1, SLICES)], 0.01)
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = rows.where(F.lit(True) if low is None else F.col(time) > low).where(F.lit(True) if high is None else F.col(time) <= high)
        write(part.repartition(FILES))


class _Replayed(StateTable):
    """A table whose every batch comes twice, and which is compacted in between."""

    def publish(self, rows: DataFrame, batch_id: int) -> int:
        version = super().publish(rows, batch_id)
        if super().publish(rows.limit(0), batch_id) != version:
            raise AssertionError("a replayed batch made a version")
        return self.compact() if batch_id == 1 else version


def versioned_state(d) -> DataFrame:
    """State from at least three micro-batches, each replayed, with a compaction between them."""
    path = folder(d, "sliced-payloads")
    rows = d.pings.where("timestamp is not null").select("entity_id", "entity_type", "latitude", "longitude", "speed", "timestamp")
    _in_slices(rows.withColumn("value", F.to_json(F.struct(*rows.columns))), "timestamp", lambda part: part.select("value").write.mode("append").text(path))
    raw = pings.read_payload_files(d.spark, path, per_trigger=FILES)
    table = _Replayed(d.spark, folder(d, "versioned-state"), "edge_id", "last_updated", EDGE_STATE)
    matched = _matched_stream(d, pings.decode_pings(raw), FILES)
    jobs.start_versioned_state(matched, d.edges, table, folder(d, "ckpt"), every=None).awaitTermination()
    if len(table.versions()) < 4 or not table.manifest()["base"]:
        raise AssertionError("fewer than three batches and a compaction")
    return table.read()


def expiry_events(d) -> DataFrame:
    """Published states in several batches; what expired by the end of the stream."""
    expiry.use_rocksdb(d.spark)
    path, out = folder(d, "sliced-states"), folder(d, "expiry")
    _in_slices(d.states.select("edge_id", "last_updated", "is_congested"), "last_updated", lambda part: part.write.mode("append").parquet(path))
    states = d.spark.readStream.schema("edge_id string, last_updated long, is_congested boolean").option("maxFilesPerTrigger", FILES).parquet(path)
    (expiry.expiry_events(states).writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(d, "ckpt"))
     .trigger(availableNow=True).start().awaitTermination())
    return d.spark.read.schema(expiry.EVENT).parquet(out)


LATE_ROW = "entity_id string, edge_id string, speed double, timestamp long, event_time timestamp"


def late_ledger(d) -> DataFrame:
    """Pings that arrive in four batches, some a batch after their time: rows in time and late rows of each edge and window."""
    path = folder(d, "late-pings")
    columns = [c.split(" ")[0] for c in LATE_ROW.split(", ")]
    first, last = d.matched.agg(F.min("timestamp"), F.max("timestamp")).first()
    own = F.floor((F.col("timestamp") - F.lit(first)) * SLICES / F.lit(last - first + 1))
    arrived = F.least(own + (F.col("timestamp") % 7 == 0).cast("long"), F.lit(SLICES - 1))
    for part in range(SLICES):
        d.matched.where(arrived == part).select(*columns).repartition(FILES).write.mode("append").parquet(path)
    pings_in = d.spark.readStream.schema(LATE_ROW).option("maxFilesPerTrigger", FILES).parquet(path)
    ledger = late.LateLedger(d.spark, folder(d, "late-ledger"))
    late.start_ledger(pings_in, ledger, folder(d, "ckpt"), every=None).awaitTermination()
    kept = ledger.rows(LATE_ROW)
    windows = kept.groupBy("edge_id", F.window("event_time", "10 seconds").alias("w")).agg(
        F.count_if(~F.col("late")).alias("in_time"), F.count_if("late").alias("late"),
        F.coalesce(F.max("behind_ms"), F.lit(0)).alias("most_behind_ms"))
    return windows.select("edge_id", F.unix_millis("w.start").alias("start_ms"), "in_time", "late", "most_behind_ms")
