"""A ledger of late rows: what a windowed stream would drop, kept beside what it takes.

Each micro-batch is written once, cut by the watermark that the batches before it
left.  Rows in time and late rows are the whole input, and the ledger says how far
behind the watermark each late row was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfleet import schemas as S
from wayfleet.streaming.jobs import _finished, _triggered

PROGRESS = "batch long, rows long, late long, high_ms long"


def _behind(high_ms: int | None, delay_ms: int):
    """Milliseconds behind the watermark, null for rows in time; rows without a time are in time, as no watermark passes them."""
    if high_ms is None:
        return F.lit(None).cast("long")
    behind = F.lit(high_ms - delay_ms) - F.unix_millis("event_time")
    return F.when(behind > 0, behind)


class LateLedger:
    """``folder``: rows/batch=N/late=..., and one progress row for each finished batch.

    A batch is finished with its progress row. One that comes again after that is left
    alone; one that was cut off before it is written anew. Readers take finished batches only.
    """

    def __init__(self, spark: SparkSession, folder: str, delay_ms: int = S.WATERMARK_DELAY_MS):
        self.spark, self.folder, self.delay_ms = spark, folder, delay_ms

    def _progress(self, batch_id: int) -> str:
        return f"{self.folder}/progress/batch={batch_id}"

    def _high(self, batch_id: int) -> int | None:
        """Greatest event time before this batch; the row of the batch before it carries it on."""
        if batch_id == 0:
            return None
        return self.spark.read.schema(PROGRESS).parquet(self._progress(batch_id - 1)).first()["high_ms"]

    def take(self, batch: DataFrame, batch_id: int) -> None:
        if _finished(self.spark, self._progress(batch_id)):
            return
        high = self._high(batch_id)
        seen = Observation(f"late-{batch_id}")
        rows = (batch.withColumn("behind_ms", _behind(high, self.delay_ms)).withColumn("late", F.col("behind_ms").isNotNull())
                .observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("late"),
                         F.max(F.unix_millis("event_time")).alias("high_ms")))
        rows.write.mode("overwrite").partitionBy("late").parquet(f"{self.folder}/rows/batch={batch_id}")
        found = seen.get
        highs = [h for h in (high, found["high_ms"]) if h is not None]
        done = Row(batch=batch_id, rows=found["rows"], late=found["late"], high_ms=max(highs) if highs else None)
        self.spark.createDataFrame([done], PROGRESS).coalesce(1).write.mode("overwrite").parquet(self._progress(batch_id))

    def progress(self) -> DataFrame:
        """One row for each finished batch: rows, late rows, greatest event time so far."""
        return self.spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").parquet(f"{self.folder}/progress")

    def rows(self, schema: str) -> DataFrame:
        """All rows of finished batches with batch, late and behind_ms; ``schema`` is that of the stream."""
        written = (self.spark.read.schema(f"{schema}, behind_ms long, batch long, late boolean")
                   .option("basePath", f"{self.folder}/rows").parquet(f"{self.folder}/rows"))
        return written.join(self.progress().select("batch"), "batch", "left_semi")


def start_ledger(rows: DataFrame, ledger: LateLedger, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    """Write a stream with ``event_time`` into the ledger, batch by batch."""
    writer = rows.writeStream.foreachBatch(ledger.take).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()
