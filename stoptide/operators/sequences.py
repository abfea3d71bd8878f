"""Operators on ordered rows: latest per key, runs, gaps, drops, as-of, clipping, expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole row with the largest order columns of each key.

    A max over a struct combines in each task before the shuffle, so a hot key sends one row a task.
    Null order values lose; ties beyond the order columns go to the largest remaining columns.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    top = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_top"))
    return top.select(*(F.col(c) if c in keys else F.col(f"_top.{c}").alias(c) for c in df.columns))


def with_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str = "run") -> DataFrame:
    """Numbers the islands of equal consecutive values; a null equals a null."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = df.withColumn("_v", value).withColumn("_rn", F.row_number().over(w))
    turned = (F.col("_rn") == 1) | ~F.col("_v").eqNullSafe(F.lag("_v").over(w))
    return marked.withColumn(name, F.sum(turned.cast("long")).over(w)).drop("_v", "_rn")


def feed_gaps(times: DataFrame, start: int, end: int, longest: int = 300, column: str = "header_s", bucket_s: int = 86400) -> DataFrame:
    """Stretches of more than ``longest`` seconds without a time, the window's edges included.

    Times are compared within buckets in parallel; only each bucket's first and last time meet in
    one ordered pass, so the single task sees two rows a bucket however many times there are.
    """
    t = times.select(F.col(column).alias("t")).filter(F.col("t").isNotNull()).distinct().withColumn("_b", F.floor(F.col("t") / bucket_s))
    inner = t.select(F.lag("t").over(Window.partitionBy("_b").orderBy("t")).alias("gap_start_s"), F.col("t").alias("gap_end_s"))
    edges = t.groupBy("_b").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    across = edges.select(F.lag("hi").over(Window.orderBy("_b")).alias("gap_start_s"), F.col("lo").alias("gap_end_s"))
    ends = edges.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo IS NOT NULL")
    out = inner.union(across).withColumn("kind", F.lit("between"))
    out = out.union(ends.select(F.lit(start).cast("long"), "lo", F.lit("before_first"))).union(ends.select("hi", F.lit(end).cast("long"), F.lit("after_last")))
    return out.withColumn("gap_s", F.col("gap_end_s") - F.col("gap_start_s")).filter(F.col("gap_s") > longest).select("gap_start_s", "gap_end_s", "gap_s", "kind")


def drop_events(timeline: DataFrame, key: str = "trip_key", ts: str = "ts", stops: str = "stop_seqs") -> DataFrame:
    """Stops that leave a trip's list between consecutive snapshots: clean, not_from_front or multi_drop."""
    w = Window.partitionBy(key).orderBy(ts)
    d = timeline.select(key, F.col(ts).alias("last_ts"), F.lead(ts).over(w).alias("first_ts"), F.col(stops).alias("_a"), F.lead(stops).over(w).alias("_b"))
    d = d.filter("first_ts IS NOT NULL").withColumn("_gone", F.array_except("_a", "_b")).withColumn("n_together", F.size("_gone"))
    kind = F.when(F.col("n_together") > 1, "multi_drop").when(F.col("stop_seq") == F.array_min("_a"), "clean").otherwise("not_from_front")
    return d.withColumn("stop_seq", F.explode("_gone")).withColumn("kind", kind).select(key, "stop_seq", "last_ts", "first_ts", "kind", "n_together")


def one_file_per_time(rows: DataFrame, time: str = "header_timestamp", file: str = "snapshot_file") -> DataFrame:
    """All rows of the smallest file name of each time: duplicates are whole files, not rows."""
    kept = rows.groupBy(time).agg(F.min(file).alias(file))
    return rows.join(kept, [time, file], "left_semi")


def clip_overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    """Seconds that two spans share, never negative."""
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))


def passages(pings: DataFrame, radius: float, keys: Sequence[str] = ("trip", "stop_seq"), ts: str = "ts", distance: str = "distance") -> DataFrame:
    """Visits within a radius: islands of consecutive pings inside, with the last time inside and the first outside after."""
    w = Window.partitionBy(*keys).orderBy(ts)
    d = with_runs(pings.withColumn("_in", F.col(distance) <= radius), keys, [ts], F.col("_in")).withColumn("_next", F.lead(ts).over(w))
    v = d.filter("_in").groupBy(*keys, "run").agg(F.min(ts).alias("first_in"), F.max(ts).alias("last_in"), F.max(F.struct(ts, "_next")).alias("_l"), F.count("*").alias("n"))
    return v.select(*keys, "first_in", "last_in", F.col("_l._next").alias("first_out"), "n")


def held_summary(rows: DataFrame, keys: Sequence[str] = ("trip", "stop_seq"), ts: str = "ts", held: str = "held") -> DataFrame:
    """Per key: when the clock first reached the held value, the value then, changes after, and the drift."""
    w = Window.partitionBy(*keys).orderBy(ts)
    d = rows.withColumn("_c", ~F.col(held).eqNullSafe(F.lag(held).over(w)) | (F.row_number().over(w) == 1))
    d = d.withColumn("_t", F.min(F.when(F.col(ts) >= F.col(held), F.col(ts))).over(Window.partitionBy(*keys)))
    return d.groupBy(*keys).agg(
        F.max("_t").alias("t_cross"),
        F.max(F.when(F.col(ts) == F.col("_t"), F.col(held))).alias("value_at_cross"),
        F.count_if(F.col("_c") & (F.col(ts) > F.col("_t"))).alias("changes_after"),
        (F.max_by(held, ts) - F.max(F.when(F.col(ts) == F.col("_t"), F.col(held)))).alias("drift"),
    )
