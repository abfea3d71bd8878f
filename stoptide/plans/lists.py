"""Queries on the lists of true snapshots: drops, their widths, repeats, reappearances, trips' last lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.catalog import register
from stoptide.functions.dialect import DUCK, SPARK, Spark
from stoptide.operators.presence import drops, intervals, reappearances
from stoptide.plans.engine import frame, oracle

#: A stop stays in its trip's list so long after a row of it, in seconds.
LISTED_S = 86_400
WEEK_S = 604_800


def _rows(d: Spark) -> str:
    """(trip_key, ts, stop_seq): the list in every snapshot of a trip, a trip being a vehicle's week."""
    by = "PARTITION BY trip_key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    latest = ", ".join(f"max(CASE WHEN stop_sequence = {k} THEN ts END) OVER ({by}) AS t{k}" for k in range(1, 6))
    stops = " UNION ALL ".join(f"SELECT trip_key, ts, {k} AS stop_seq FROM {{latest_calls}} WHERE ts - t{k} < {LISTED_S}" for k in range(1, 6)) if d.name == "duck" else ""
    key = f"{d.text('trip_id')} || ':' || {d.text(d.idiv('header_s', str(WEEK_S)))}"
    base = f"SELECT trip_key, ts, {latest} FROM (SELECT {key} AS trip_key, header_s AS ts, stop_sequence FROM {{feed}}) f"
    if d.name == "duck":
        return stops.replace("{latest_calls}", f"({base}) l")
    listed = ", ".join(f"CASE WHEN ts - t{k} < {LISTED_S} THEN {k} END" for k in range(1, 6))
    return f"SELECT trip_key, ts, explode(array_compact(array({listed}))) AS stop_seq FROM ({base}) l"


#: The plain definition: lists in order, each beside the next; a stop is gone if the next list lacks it.
_LISTS = f"""
WITH listed AS ({_rows(DUCK)}),
lists AS (SELECT trip_key, ts, list(DISTINCT stop_seq ORDER BY stop_seq) AS seqs FROM listed GROUP BY trip_key, ts),
beside AS (SELECT trip_key, ts, seqs, lead(ts) OVER (PARTITION BY trip_key ORDER BY ts) AS next_ts, lead(seqs) OVER (PARTITION BY trip_key ORDER BY ts) AS next_seqs, lag(seqs) OVER (PARTITION BY trip_key ORDER BY ts) AS before_seqs FROM lists),
each_stop AS (SELECT *, unnest(seqs) AS stop_seq FROM beside),
gone AS (SELECT *, count(*) OVER (PARTITION BY trip_key, ts) AS n_together FROM each_stop WHERE next_seqs IS NOT NULL AND NOT list_contains(next_seqs, stop_seq)),
drops AS (SELECT trip_key, stop_seq, ts AS last_ts, next_ts AS first_ts, CASE WHEN n_together > 1 THEN 'multi_drop' WHEN stop_seq = seqs[1] THEN 'clean' ELSE 'not_from_front' END AS kind, n_together FROM gone),
repeats AS (SELECT trip_key, stop_seq, count(*) AS n_drops, min(last_ts) AS first_drop, max(last_ts) AS last_drop FROM drops GROUP BY trip_key, stop_seq HAVING count(*) > 1),
back AS (SELECT e.trip_key, e.stop_seq, e.ts AS reappear_ts FROM each_stop e JOIN repeats r ON e.trip_key = r.trip_key AND e.stop_seq = r.stop_seq WHERE e.before_seqs IS NOT NULL AND NOT list_contains(e.before_seqs, e.stop_seq))
"""


def _stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals(frame(spark, sf_dir, _rows(SPARK)))


@register("snapshot_drops", oracle(f"{_LISTS} SELECT * FROM drops"))
def snapshot_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stop that leaves its trip's list between two consecutive snapshots: clean, not from the front, or several together."""
    return drops(_stretches(spark, sf_dir))


@register(
    "snapshot_drop_widths",
    oracle(f"{_LISTS} SELECT kind, count(*) AS n, {', '.join(f'quantile_cont(first_ts - last_ts, {p}) AS p{int(100 * p)}' for p in (0.5, 0.95, 0.99))}, max(first_ts - last_ts) AS widest FROM drops GROUP BY kind"),
)
def snapshot_drop_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How wide the window is in which a stop leaves, by kind."""
    width = F.col("first_ts") - F.col("last_ts")
    return drops(_stretches(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("n"), *(F.percentile(width, p).alias(f"p{int(100 * p)}") for p in (0.5, 0.95, 0.99)), F.max(width).alias("widest"))


@register("snapshot_repeat_drops", oracle(f"{_LISTS} SELECT * FROM repeats"))
def snapshot_repeat_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops that leave more than once, with the first and last time."""
    d = drops(_stretches(spark, sf_dir)).groupBy("trip_key", "stop_seq")
    return d.agg(F.count("*").alias("n_drops"), F.min("last_ts").alias("first_drop"), F.max("last_ts").alias("last_drop")).filter("n_drops > 1")


@register("snapshot_reappearances", oracle(f"{_LISTS} SELECT trip_key, reappear_ts, count(*) AS n_stops, string_agg(cast(stop_seq AS varchar), ',' ORDER BY stop_seq) AS stops FROM back GROUP BY trip_key, reappear_ts"))
def snapshot_reappearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops that come back together in one snapshot, of those that leave more than once."""
    d = reappearances(_stretches(spark, sf_dir)).groupBy("trip_key", "reappear_ts")
    return d.agg(F.count("*").alias("n_stops"), F.array_join(F.transform(F.array_sort(F.collect_list("stop_seq")), lambda x: x.cast("string")), ",").alias("stops"))


@register(
    "snapshot_last_lists",
    oracle(f"{_LISTS} SELECT kind, count(*) AS trips, cast(sum(n) AS bigint) AS stops FROM (SELECT len(seqs) AS n, CASE WHEN len(seqs) = 1 AND seqs[1] = 5 THEN 'final_only' WHEN len(seqs) >= 2 THEN 'two_plus' ELSE 'other' END AS kind FROM beside WHERE next_ts IS NULL) x GROUP BY kind"),
)
def snapshot_last_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How trips leave the feed: with the final stop only, with two or more, or otherwise."""
    last = _stretches(spark, sf_dir).filter("last_of_trip").groupBy("trip_key").agg(F.count("*").alias("n"), F.min("stop_seq").alias("seq"))
    kind = F.when((F.col("n") == 1) & (F.col("seq") == 5), "final_only").when(F.col("n") >= 2, "two_plus").otherwise("other")
    return last.groupBy(kind.alias("kind")).agg(F.count("*").alias("trips"), F.sum("n").alias("stops"))
