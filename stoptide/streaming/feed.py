"""The feed as a stream: duplicates dropped within a watermark, latest value and presence per trip and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicated(rows: DataFrame, delay: str = "2 hours", time: str = "event_time") -> DataFrame:
    """Each (time, trip, stop) once within the watermark, so state stays bounded."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([time, "trip_id", "stop_sequence"])


def last_appearance(rows: DataFrame, delay: str = "2 hours", window: str = "1 day", time: str = "event_time") -> DataFrame:
    """The latest held value of each trip and stop per window, all fields from the same row."""
    w = rows.withWatermark(time, delay).groupBy(F.window(time, window), "trip_id", "stop_sequence")
    out = w.agg(F.max(F.struct(F.col(time).alias("t"), "held_s")).alias("l"))
    return out.select(F.col("window.start").alias("window_start"), "trip_id", "stop_sequence", F.col("l.t").alias("last_seen"), F.col("l.held_s").alias("held_s"))


def sessions(rows: DataFrame, key: str = "trip_id", gap: str = "300 seconds", delay: str = "2 hours", time: str = "event_time") -> DataFrame:
    """Stretches of a key's rows without a gap; what lies between two of them is an outage."""
    out = rows.withWatermark(time, delay).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
