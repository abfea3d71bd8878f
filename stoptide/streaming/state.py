"""State kept per key over a stream: the latest row of each key with a timer, and tumbling hours.

``latest_values`` keeps one row a key, whatever the number of rows: rows come in any order, the largest
(time, tie) wins, and a key that is silent for so long, by the watermark, is told once and forgotten.
It runs on ``transformWithState``; the session's state store must be RocksDB, which that operator needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = pd.Timestamp(0)


def _micros(t: pd.Timestamp) -> int:
    t = t.tz_convert("UTC").tz_localize(None) if t.tzinfo else t
    return (t - EPOCH) // pd.Timedelta(microseconds=1)


class LatestValue(StatefulProcessor):
    """One (time, tie, value, count) a key; told when the key's timer expires."""

    def __init__(self, silent_ms: int, key_names: list[str]) -> None:
        self.silent_ms, self.key_names = silent_ms, key_names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", StructType([StructField(x, LongType()) for x in ("time", "tie", "value", "n")]))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = self.latest.get() if self.latest.exists() else None
        best, n = (tuple(now[:3]), now[3]) if now is not None else (None, 0)
        for part in rows:
            n += len(part)
            top = part.sort_values(["event_time", "tie"]).iloc[-1]
            found = (_micros(top["event_time"]), int(top["tie"]), None if pd.isna(top["value"]) else int(top["value"]))
            if best is None or found[:2] > best[:2]:
                best = found
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(best[0] // 1000 + self.silent_ms)
        self.latest.update((*best, n))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        time, tie, value, n = self.latest.get()
        self.latest.clear()
        yield pd.DataFrame({**{c: [k] for c, k in zip(self.key_names, key, strict=True)}, "last_seen": [EPOCH + pd.Timedelta(microseconds=time)], "tie": [tie], "value": pd.array([value], dtype="Int64"), "n_rows": [n]})

    def close(self) -> None:
        pass


def latest_values(rows: DataFrame, keys: list[str], value: str, tie: str, silent_s: int = 3600, delay: str = "10 minutes", time: str = "event_time") -> DataFrame:
    """(keys, last_seen, tie, value, n_rows): the latest row of each key once it has been silent for ``silent_s`` seconds of event time.

    A key that comes back later starts anew. ``value`` and ``tie`` are whole numbers; null times are
    dropped. Rows later than the watermark are dropped before the state sees them.
    """
    d = rows.filter(F.col(time).isNotNull()).select(*keys, F.col(time).cast("timestamp").alias("event_time"), F.col(tie).cast("long").alias("tie"), F.col(value).cast("long").alias("value")).withWatermark("event_time", delay)
    schema = ", ".join(f"{k} {dict(rows.dtypes)[k]}" for k in keys) + ", last_seen timestamp, tie bigint, value bigint, n_rows bigint"
    return d.groupBy(*keys).transformWithStateInPandas(LatestValue(1000 * silent_s, keys), schema, "Append", "eventTime")


def hourly(rows: DataFrame, delay: str = "10 minutes", time: str = "event_time", size: str = "1 hour", keys: tuple[str, ...] = ()) -> DataFrame:
    """(window_start, keys, n_rows, first_seen, last_seen) of each tumbling window, told once the watermark has passed it; later rows are dropped."""
    w = rows.withWatermark(time, delay).groupBy(F.window(time, size), *keys)
    out = w.agg(F.count("*").alias("n_rows"), F.min(time).alias("first_seen"), F.max(time).alias("last_seen"))
    return out.select(F.col("window.start").alias("window_start"), *keys, "n_rows", "first_seen", "last_seen")
