"""When a stop stands in its trip's list, as intervals of the trip's own snapshots.

A feed repeats each trip's list of stops in every snapshot. What matters is where a stop enters and
leaves, so rows (trip, snapshot, stop) become one interval per stretch of consecutive snapshots of the
trip; lists are never gathered. All windows share one partitioning by trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def intervals(rows: DataFrame, trip: str = "trip_key", time: str = "ts", stop: str = "stop_seq") -> DataFrame:
    """(trip, stop, first_i, last_i, first_ts, last_ts, next_ts, front, last_of_trip) of each stretch.

    Snapshots are the trip's own, numbered from 1 in order of time; a row without a stop only says that
    the trip was there. ``next_ts`` is the trip's snapshot after the stretch (null at the trip's end),
    ``front`` the smallest stop of its last snapshot. Repeated rows count once; null trips or times not.
    """
    by_trip = Window.partitionBy(trip)
    by_time = by_trip.orderBy(time)
    known = rows.filter(F.col(trip).isNotNull() & F.col(time).isNotNull()).select(trip, time, stop).repartition(trip).distinct()
    # later snapshots first, so that the nearest later one is a running minimum
    later = by_trip.orderBy(F.col(time).desc()).rangeBetween(Window.unboundedPreceding, -1)
    placed = known.select(
        trip, time, stop, F.dense_rank().over(by_time).alias("_i"), F.min(time).over(later).alias("_next"), F.min(stop).over(Window.partitionBy(trip, time)).alias("_front")
    )
    n = F.max("_i").over(by_trip)
    runs = placed.withColumn("_n", n).filter(F.col(stop).isNotNull()).withColumn("_run", F.col("_i") - F.row_number().over(Window.partitionBy(trip, stop).orderBy("_i")))
    out = runs.groupBy(trip, stop, "_run").agg(
        F.min("_i").alias("first_i"),
        F.max("_i").alias("last_i"),
        F.min(time).alias("first_ts"),
        F.max(time).alias("last_ts"),
        F.max_by("_next", "_i").alias("next_ts"),
        F.max_by("_front", "_i").alias("front"),
        F.max("_n").alias("_n"),
    )
    return out.withColumn("last_of_trip", F.col("last_i") == F.col("_n")).drop("_run", "_n")


def drops(stretches: DataFrame, trip: str = "trip_key", stop: str = "stop_seq") -> DataFrame:
    """(trip, stop, last_ts, first_ts, kind, n_together): stops that leave while their trip stays, between two consecutive snapshots."""
    gone = stretches.filter("NOT last_of_trip").withColumn("n_together", F.count("*").over(Window.partitionBy(trip, "last_i")))
    kind = F.when(F.col("n_together") > 1, "multi_drop").when(F.col(stop) == F.col("front"), "clean").otherwise("not_from_front")
    return gone.select(trip, stop, "last_ts", F.col("next_ts").alias("first_ts"), kind.alias("kind"), "n_together")


def reappearances(stretches: DataFrame, trip: str = "trip_key", stop: str = "stop_seq") -> DataFrame:
    """(trip, stop, reappear_ts) of stops that left more than once: every entry after an absence within the trip's snapshots.

    A stop that enters after the trip's first snapshot counts as absent before.
    """
    left = F.sum(F.when(F.col("last_of_trip"), 0).otherwise(1)).over(Window.partitionBy(trip, stop))
    return stretches.withColumn("_left", left).filter("_left > 1 AND first_i > 1").select(trip, stop, F.col("first_ts").alias("reappear_ts"))


def trace(rows: DataFrame, key: str, trip: str = "trip_key", time: str = "ts", stop: str = "stop_seq") -> DataFrame:
    """(ts, stop, what) of one trip in order: every stop that enters or leaves its list, and the trip's end."""
    s = intervals(rows.filter(F.col(trip) == key), trip, time, stop)
    entered = s.select(F.col("first_ts").alias("ts"), F.col(stop), F.when(F.col("first_i") == 1, "listed").otherwise("enters").alias("what"))
    left = s.select(F.coalesce("next_ts", "last_ts").alias("ts"), F.col(stop), F.when(F.col("last_of_trip"), "stays to the end").otherwise("leaves").alias("what"))
    return entered.union(left).orderBy("ts", "what", stop)
