"""Expiry of edge state as a stream of events, by keyed state and event-time timers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wayfleet import schemas as S

EVENT = "edge_id string, event string, at_ms long, last_updated long"
_ROW = Row("edge_id", "event", "at_ms", "last_updated")
#: State with timers needs this provider.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return spark


class EdgeExpiry(StatefulProcessor):
    """One edge: its newest published state, and a timer for the moment that state expires.

    A state that comes after the moment tells that the edge was expired in between, also
    when both arrive in one batch; so the events follow the data, not the batches.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "last_updated long, is_congested boolean")

    def _events(self, edge: str, last_updated: int, congested: bool) -> list[Row]:
        at = last_updated + self.ttl_ms
        return [_ROW(edge, "expired", at, last_updated)] + ([_ROW(edge, "unblocked", at, last_updated)] if congested else [])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.newest.get()
        old, was = (int(held[0]), bool(held[1])) if held else (None, False)
        now, congested, found = old, was, []
        for at, jam in sorted({(int(r["last_updated"]), bool(r["is_congested"])) for r in rows}):
            if now is not None and at < now:
                continue                                    # older than what is known
            if now is not None and at >= now + self.ttl_ms:
                found += self._events(key[0], now, congested)
            now, congested = at, jam
        if (now, congested) != (old, was):
            self.newest.update((now, congested))
        if now != old:
            if old is not None:
                self.handle.deleteTimer(old + self.ttl_ms)
            self.handle.registerTimer(now + self.ttl_ms)
        return iter(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, found = self.newest.get(), []
        if held and expiredTimerInfo.getExpiryTimeInMs() == held[0] + self.ttl_ms:
            found = self._events(key[0], int(held[0]), bool(held[1]))
            self.newest.clear()
        return iter(found)

    def close(self) -> None:
        pass


def expiry_events(states: DataFrame, ttl_seconds: int = S.STATE_TTL_SECONDS, delay: str = S.WATERMARK_DELAY) -> DataFrame:
    """(edge_id, event, at_ms, last_updated) of a stream of published states.

    ``expired`` when no newer state came in time, ``unblocked`` besides if the edge was congested. Events
    come once the watermark has passed the moment. Needs ``use_rocksdb``.
    """
    rows = (states.select("edge_id", "last_updated", "is_congested", F.timestamp_millis("last_updated").alias("event_time"))
            .withWatermark("event_time", delay))
    return rows.groupBy("edge_id").transformWithState(
        EdgeExpiry(ttl_seconds * 1000), outputStructType=EVENT, outputMode="Append", timeMode="EventTime")
