"""The two streaming queries over pings, and the route change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfleet import schemas as S
from wayfleet.operators import serving, traffic
from wayfleet.operators.matching import match_pings
from wayfleet.operators.nearest import NearestIndex
from wayfleet.sources import tables
from wayfleet.sources.versions import StateTable


def _triggered(writer, every: str | None):
    """A fixed cadence, or everything available now and stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def _finished(spark, folder: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def matched_stream(pings: DataFrame, index: NearestIndex, salts: int = 1) -> DataFrame:
    """Clean and match a stream of decoded pings, row by row.

    Streams are not re-planned while they run: give ``salts`` when the candidates
    are too large to broadcast and single cells are hot.
    """
    return match_pings(traffic.clean_pings(pings), index, salts)


def start_archive(matched: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    """Append every matched ping, late ones included, by day."""
    rows = traffic.archive_rows(matched).withColumn("event_date", F.to_date("event_time"))
    writer = (rows.writeStream.format("parquet").outputMode("append").partitionBy("event_date")
              .option("path", path).option("checkpointLocation", checkpoint))
    return _triggered(writer, every).start()


def start_match_archive(pings: DataFrame, index: NearestIndex, path: str, checkpoint: str,
                        every: str | None = "30 seconds", files: int | None = None) -> StreamingQuery:
    """Match inside each micro-batch, for networks too large to match row by row.

    Every batch owns one folder, of ``files`` files if given, and a replay leaves a
    finished folder alone, so ``archived_stream`` sees each row once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch={batch_id}"
        if not _finished(batch.sparkSession, folder):
            rows = traffic.archive_rows(match_pings(traffic.clean_pings(batch), index))
            (rows.repartition(files) if files else rows).write.mode("overwrite").parquet(folder)

    writer = pings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def start_traffic(pings: DataFrame, index: NearestIndex, edges: DataFrame, folder: str,
                  every: str | None = "3 seconds", delay: str = S.WATERMARK_DELAY) -> list[StreamingQuery]:
    """The whole job over decoded pings of a topic or of files: match once, archive, then publish edge state.

    Pings are matched inside each batch, so the network may be of any size; the
    state query reads the archive that the first one writes. With ``every`` None both
    run to the end of what is there.
    """
    archive = f"{folder}/archive"
    matching = start_match_archive(pings, index, archive, f"{folder}/archive-progress", every)
    if every is None:
        matching.awaitTermination()
    else:
        _made(pings.sparkSession, archive)
    matched = archived_stream(pings.sparkSession, archive)
    return [matching, start_edge_state(matched, edges, f"{folder}/state", f"{folder}/state-progress", every, delay)]


def _made(spark, folder: str) -> None:
    """The folder, empty if nothing has written to it yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def archived_stream(spark, path: str, per_trigger: int | None = None) -> DataFrame:
    """Stream over an archive written by ``start_match_archive``, ``per_trigger`` files at a time if given."""
    schema = ("entity_id string, entity_type string, latitude double, longitude double, speed double, "
              "timestamp long, event_time timestamp, edge_id string")
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).parquet(path)


def speed_stream(matched: DataFrame, delay: str = S.WATERMARK_DELAY) -> DataFrame:
    return traffic.edge_speed(matched.withWatermark("event_time", delay))


def publish_edge_state(edges: DataFrame, path: str):
    """Batch writer: window rows to published state, one folder per batch; errors fail the batch."""
    def publish(windows: DataFrame, batch_id: int) -> None:
        windows = windows.persist()          # looked at twice: for being empty, and to be written
        if not windows.isEmpty():
            states = traffic.edge_state_rows(traffic.enrich_edges(traffic.publishable(windows), edges))
            tables.write_state_batch(states, batch_id, path)
        windows.unpersist()
    return publish


def start_edge_state(matched: DataFrame, edges: DataFrame, path: str, checkpoint: str,
                     every: str | None = "3 seconds", delay: str = S.WATERMARK_DELAY) -> StreamingQuery:
    """Sliding edge speeds in update mode, published batch by batch."""
    writer = (speed_stream(matched, delay).writeStream.outputMode("update")
              .foreachBatch(publish_edge_state(edges, path)).option("checkpointLocation", checkpoint))
    return _triggered(writer, every).start()


def start_versioned_state(matched: DataFrame, edges: DataFrame, table: StateTable, checkpoint: str,
                          every: str | None = "3 seconds", delay: str = S.WATERMARK_DELAY) -> StreamingQuery:
    """Sliding edge speeds in update mode into a versioned table: readers see complete batches only, and a batch that comes again changes nothing."""
    def publish(windows: DataFrame, batch_id: int) -> None:
        table.publish(traffic.edge_state_rows(traffic.enrich_edges(traffic.publishable(windows), edges)), batch_id)

    writer = (speed_stream(matched, delay).writeStream.outputMode("update")
              .foreachBatch(publish).option("checkpointLocation", checkpoint))
    return _triggered(writer, every).start()


def conflated_stream(pings: DataFrame, delay: str = S.WATERMARK_DELAY) -> DataFrame:
    """Newest position per truck and second."""
    return traffic.conflate_positions(traffic.with_event_time(pings).withWatermark("event_time", delay))


def route_changes(updates: DataFrame) -> DataFrame:
    """Each appended document's effective route, as it arrives."""
    return serving.effective_route(updates)


def traffic_snapshot_rows(spark, state_path: str) -> DataFrame:
    """The full traffic feed as of now, for a periodic reader."""
    return serving.traffic_feed(tables.read_state(spark, state_path))
