"""Keyed state within streams: what a run knows of a key is kept in the state store, and let go by a timer.

`latest_by_key` is the incremental run as a stream: of each key the newest content is remembered; a micro-batch's rows of
a key give one row that says whether they brought a new key, another content or nothing new. Where nothing has come for
`horizon`, a timer at that event time lets the state go and says so, so state is bounded by what the horizon holds, not by
all keys that ever came. Rows behind the watermark are late: they are left out, as Spark's own aggregates leave them out.

`first_seen` passes on the first of rows that are equal in some columns, within the watermark.

The state store must be the one that keeps state outside the heap (RocksDB's); `keyed_state` sets it.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "at timestamp, tie string, content string"


def keyed_state(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def _utc(at: datetime) -> datetime:
    """A time with its zone: what Spark hands over without one is in the worker's local time."""
    return at.astimezone(timezone.utc)


def _ms(at: datetime) -> int:
    return (_utc(at) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(milliseconds=1)


class Latest(StatefulProcessor):
    """State of a key: time, tie-break and content of its newest row. One row at a time is held, whatever a key brings."""

    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.newest.get() if self.newest.exists() else None
        best, n = before, 0
        for row in rows:
            n += 1
            if best is None or (_utc(row.at), row.tie) > (_utc(best[0]), best[1]):
                best = (row.at, row.tie, row.content)
        if best is not before:
            if before is not None:
                self.handle.deleteTimer(_ms(before[0]) + self.horizon_ms)
            self.newest.update(tuple(best))
            self.handle.registerTimer(_ms(best[0]) + self.horizon_ms)
        outcome = "inserted" if before is None else "unchanged" if best[2] == before[2] else "updated"
        yield Row(key=key[0], at=best[0], content=best[2], n=n, outcome=outcome)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last = self.newest.get()
        self.newest.clear()
        yield Row(key=key[0], at=last[0], content=last[2], n=0, outcome="expired")

    def close(self) -> None:
        pass


def latest_by_key(stream: DataFrame, key: str, at: str, tie: str, content: str, delay: str, horizon: timedelta) -> DataFrame:
    """A stream of (key, at, content, n, outcome): for each micro-batch and key one row with the newest content after it,
    the number of rows that were on time and inserted, updated or unchanged; and expired ones as their time comes. Of
    rows at the same time the one with the greatest tie counts. Null keys are a key."""
    keyed_state(stream.sparkSession)
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key).alias("key"), F.col(at).cast("timestamp").alias("at"), F.col(tie).cast("string").alias("tie"), F.col(content).cast("string").alias("content"))
    processor = Latest(horizon // timedelta(milliseconds=1))
    return rows.withWatermark("at", delay).groupBy("key").transformWithState(processor, f"key {kind}, at timestamp, content string, n long, outcome string", "Append", "EventTime")


def first_seen(stream: DataFrame, at: str, delay: str, columns: list[str]) -> DataFrame:
    """The stream without rows that are equal in these columns to one that came before, as long as the watermark keeps
    it."""
    keyed_state(stream.sparkSession)
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(columns)
