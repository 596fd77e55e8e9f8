"""Keyed state over event streams: bursts by a ring buffer, health of hosts by event-time timers.

Both need the RocksDB state store (`rocksdb` sets it while a query starts; the query's checkpoint remembers it). Within
a trigger a key's rows are put in order; between triggers they count as they arrive, so files are to arrive in order of
time. A key's rows of one trigger are in one task: `maxFilesPerTrigger` bounds them. Null keys are a key of their own.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from waymark.operators.logs import IDLE_S, health_after, is_blocked

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """The state store that keyed processors need, for the queries started inside."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _ordered(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(["at", "event_id"], kind="stable")


class BurstProcessor(StatefulProcessor):
    """Marks failures whose message names a block, and those that come quickly after others of their key."""

    def __init__(self, most: int, least: int, micros: int, ttl_ms: int | None):
        self.most, self.least, self.micros, self.ttl_ms = most, least, micros, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getListState("last", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _ordered(rows)
        ring = deque((row[0] for row in self.last.get()), maxlen=self.most)
        marks = []
        for at, worded in zip(frame["at"].tolist(), frame["worded"].tolist(), strict=True):
            if self.ttl_ms is not None and ring and at - ring[-1] > self.ttl_ms * 1000:
                ring.clear()
            if not worded:
                ring.append(at)
            marks.append(worded or (len(ring) >= self.least and at - ring[0] < self.micros))
        if ring:
            self.last.put([(at,) for at in ring])
            if self.ttl_ms is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(ring[-1] // 1000 + self.ttl_ms)
        yield pd.DataFrame({"key": frame["key"], "event_id": frame["event_id"], "blocked": marks})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def streaming_bursts(failures: DataFrame, key: str, most: int = 10, least: int = 5, minutes: int = 5, ttl: str | None = None) -> DataFrame:
    """(key, event_id, blocked) of a stream of failures: a block word, or `least` of the last `most` plain failures of the
    key within some minutes.

    ttl ("24 hours"): a key's buffer is forgotten so long (of event time) after its last failure, and failures that come
    later than that are dropped; state then does not grow with the keys ever seen. Without it, state stays.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp")).alias("at")
    failures = failures if ttl is None else failures.withWatermark("ts", ttl)
    rows = failures.select("ts", F.col(key).cast("long").alias("key"), "event_id", at, is_blocked(F.col("error_message")).alias("worded"))
    life = None if ttl is None else int(pd.Timedelta(ttl).total_seconds() * 1000)
    processor = BurstProcessor(most, least, minutes * 60_000_000, life)
    out = "key long, event_id long, blocked boolean"
    marked = rows.groupBy("key").transformWithStateInPandas(processor, out, "Append", "None" if ttl is None else "EventTime")
    return marked.withColumnRenamed("key", key)


HEALTH = "score long, failures long, active boolean, last long, n long, version long"


class HealthProcessor(StatefulProcessor):
    """Folds the outcomes of a host; a timer switches one that is off on again after an idle hour of event time."""

    def init(self, handle) -> None:
        self.handle = handle
        self.health = handle.getValueState("health", HEALTH)

    def _row(self, key: tuple, state: tuple) -> pd.DataFrame:
        self.health.update(state)
        score, failures, active, last, n, version = state
        return pd.DataFrame([(key[0], score, failures, active, n, version)], columns=["key", "score", "failures", "active", "n", "version"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _ordered(rows)
        score, failures, active, last, n, version = self.health.get() if self.health.exists() else (100, 0, True, 0, 0, 0)
        state = (score, failures, active, last / 1e6)
        score, failures, active, _ = health_after(state, frame["ok"].tolist(), [at / 1e6 for at in frame["at"].tolist()])
        last = int(frame["at"].iloc[-1])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not active:
            self.handle.registerTimer(last // 1000 + IDLE_S * 1000 + 1)
        yield self._row(key, (score, failures, active, last, n + len(frame), version + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.health.exists():
            score, failures, active, last, n, version = self.health.get()
            if not active:
                yield self._row(key, (score, 0, True, last, n, version + 1))

    def close(self) -> None:
        pass


def streaming_health(log: DataFrame, host: Column, ok: Column, late: str = "10 minutes") -> DataFrame:
    """(host, score, failures, active, n, version) after each change; log: a stream with ts and event_id. Of a host's rows
    the one with the greatest version counts. Outcomes later than the watermark are dropped."""
    at = F.unix_micros("ts").alias("at")
    rows = log.withWatermark("ts", late).select("ts", host.cast("long").alias("key"), "event_id", at, ok.alias("ok"))
    out = "key long, score long, failures long, active boolean, n long, version long"
    return rows.groupBy("key").transformWithStateInPandas(HealthProcessor(), out, "Update", "EventTime").withColumnRenamed("key", "host")
