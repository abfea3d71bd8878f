"""Queries at the engine's edges: feed messages decoded, hours present and missing, clock changes by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.catalog import register
from stoptide.functions.dialect import DUCK, SPARK, TZ, Spark
from stoptide.plans.engine import frame, oracle
from stoptide.sources.analogs import TABLES
from stoptide.sources.footers import footers, partition_counts
from stoptide.sources.realtime import as_messages, decoded, hours_present
from stoptide.sources.scratch import new_folder
from stoptide.sources.warehouse import write_partition


def _updates(d: Spark) -> str:
    """The events as the rows of hourly feed messages: every 37th update has no stop, every 10th no uncertainty."""
    stops = "snapshot_file % 37 <> 0"
    day = "date_format(start_date, 'yyyyMMdd')" if d.name == "spark" else "strftime(start_date, '%Y%m%d')"
    return f"""
    SELECT {d.idiv('header_s', '3600')} * 3600 AS header_timestamp, {d.text('trip_id')} AS trip_id, {day} AS start_date, cast(NULL AS {'string' if d.name == 'spark' else 'varchar'}) AS route_id,
        CASE WHEN trip_relationship = 'CANCELED' THEN 'CANCELED' ELSE 'SCHEDULED' END AS trip_schedule_relationship, header_s AS tu_timestamp,
        CASE WHEN {stops} THEN stop_sequence END AS stop_sequence, CASE WHEN {stops} THEN 'S' || {d.text('stop_sequence')} END AS stop_id,
        CASE WHEN {stops} THEN CASE WHEN snapshot_file % 11 = 0 THEN 'SKIPPED' ELSE 'SCHEDULED' END END AS stop_schedule_relationship,
        CASE WHEN {stops} THEN held_s END AS departure_time, CASE WHEN {stops} THEN cast(value_s - 200 AS int) END AS departure_delay,
        CASE WHEN {stops} AND uncertainty_present THEN 0 END AS departure_uncertainty
    FROM {{feed}}"""


_UPDATE_COLUMNS = ("header_timestamp", "trip_id", "start_date", "route_id", "trip_schedule_relationship", "tu_timestamp", "stop_sequence", "stop_id", "stop_schedule_relationship", "departure_time", "departure_delay", "departure_uncertainty")
_UPDATE_SQL = f"SELECT {', '.join(_UPDATE_COLUMNS)}, departure_time IS NOT NULL AS departure_time_present, departure_uncertainty IS NOT NULL AS departure_uncertainty_present FROM ({_updates(DUCK)}) u"


@register("feed_messages_decoded", oracle(_UPDATE_SQL))
def feed_messages_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as messages, one per hour, and decoded again: every trip update and stop of each."""
    rows = frame(spark, sf_dir, _updates(SPARK))
    messages = as_messages(rows, F.concat(F.lit("hour-"), F.col("header_timestamp").cast("string"), F.lit(".pb")))
    out = decoded(messages)
    return out.select(*_UPDATE_COLUMNS, "departure_time_present", "departure_uncertainty_present")


def _positions(d: Spark) -> str:
    return f"""
    SELECT {d.idiv('header_s', '3600')} * 3600 AS header_timestamp, CASE WHEN snapshot_file % 9 <> 0 THEN {d.text('trip_id')} END AS trip_id, 'V' || {d.text('trip_id')} AS vehicle_id, header_s AS vehicle_timestamp,
        CASE WHEN snapshot_file % 5 <> 0 THEN 56 + {d.double('value_s')} / 1024 END AS latitude, CASE WHEN snapshot_file % 5 <> 0 THEN 14 - {d.double('value_s')} / 2048 END AS longitude,
        CASE stop_sequence WHEN 1 THEN 'INCOMING_AT' WHEN 2 THEN 'STOPPED_AT' WHEN 3 THEN 'IN_TRANSIT_TO' END AS current_status, stop_sequence AS current_stop_sequence
    FROM {{feed}}"""


_POSITION_COLUMNS = ("header_timestamp", "trip_id", "vehicle_id", "vehicle_timestamp", "current_status", "current_stop_sequence")


@register(
    "vehicle_messages_decoded",
    oracle(f"SELECT {', '.join(_POSITION_COLUMNS)}, cast(latitude AS float)::double AS latitude, cast(longitude AS float)::double AS longitude, latitude IS NOT NULL AS latitude_present FROM ({_positions(DUCK)}) p"),
)
def vehicle_messages_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle positions written as messages, one per hour, and decoded again; places have 32 bits."""
    rows = frame(spark, sf_dir, _positions(SPARK))
    messages = as_messages(rows, F.concat(F.lit("hour-"), F.col("header_timestamp").cast("string"), F.lit(".pb")), "vehicles")
    return decoded(messages, "vehicles").select(*_POSITION_COLUMNS, "latitude", "longitude", "latitude_present")


def _hour_rows(d: Spark) -> str:
    """The local hours of the feed as files of a date and hour, with their rows as size."""
    return f"SELECT {d.local_date('header_s')} AS service_date, {d.local_hour('header_s')} AS hour, count(*) AS length FROM {{feed}} GROUP BY {d.local_date('header_s')}, {d.local_hour('header_s')}, trip_id % 3"


@register(
    "staged_hours",
    oracle(
        f"SELECT e.service_date, e.hour, coalesce(n, 0) AS n_files, coalesce(bytes, 0) AS bytes, n IS NOT NULL AS present FROM (SELECT DISTINCT service_date, cast(h AS int) AS hour FROM ({_hour_rows(DUCK)}) a, (SELECT unnest(range(24)) AS h) b) e "
        f"LEFT JOIN (SELECT service_date, hour, count(*) AS n, cast(sum(length) AS bigint) AS bytes FROM ({_hour_rows(DUCK)}) c GROUP BY ALL) f ON e.service_date = f.service_date AND e.hour = f.hour"
    ),
)
def staged_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour of each date of the feed, with what is there and whether anything is."""
    files = frame(spark, sf_dir, _hour_rows(SPARK))
    return hours_present(files, files)


_TABLE_ROWS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES)


@register("table_row_counts", _TABLE_ROWS)
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each table by its files' footers; no data is read."""
    files = footers(spark, [f"{sf_dir}/{t}.parquet" for t in TABLES]).filter("problem IS NULL")
    return files.groupBy(F.regexp_extract("path", r"/(\w+)\.parquet", 1).alias("table_name")).agg(F.sum("n_rows").alias("n_rows"))


@register("partition_roundtrip_counts", oracle("SELECT start_date AS service_date, count(*) AS n_rows FROM {feed} GROUP BY start_date"))
def partition_roundtrip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written by date, and the rows of each date by footers and folder names."""
    path = new_folder(spark, "feed")
    rows = frame(spark, sf_dir, "SELECT start_date AS service_date, snapshot_file, trip_id, stop_sequence, held_s FROM {feed}")
    write_partition(rows.repartition("service_date"), path)
    return partition_counts(footers(spark, path)).select("service_date", "n_rows")


# ---------------------------------------------------------------- clock changes by date


def _change_days(d: Spark, first: str, last: str) -> str:
    """(day): the local days between two dates that aren't 24 hours long, from the zone's own rules."""
    days = f"explode(sequence({first}, {last}))" if d.name == "spark" else f"unnest(generate_series(cast({first} AS timestamp), cast({last} AS timestamp), INTERVAL 1 DAY))"
    spans = "{spans}" if d.name == "spark" else "spans"
    return f"SELECT day FROM (SELECT cast(day AS date) AS day FROM (SELECT {days} AS day FROM {spans}) x) y WHERE {d.utc_of('day', 24)} - {d.utc_of('day', 0)} <> 86400"


def _departures(d: Spark) -> str:
    """Every stop's nominal time on its day, from 00:00 to 29:59."""
    hour, minute = f"{d.pad2('l_partkey % 30')}", f"{d.pad2('l_suppkey % 60')}"
    return f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate AS date) AS day, {hour} || ':' || {minute} || ':00' AS hms FROM {{lineitem}}"


def _flagged(d: Spark, departures: str, changes: str, day: str) -> str:
    """The day a nominal time falls on, joined to the days that change the clock; 2 and 3 o'clock of those are ambiguous."""
    hour = f"cast({d.part('hms', ':', 1)} AS int)"
    return f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, e.day, hms, c.day IS NOT NULL AND hour_ % 24 IN (2, 3) AS ambiguous
    FROM (SELECT *, {hour} AS hour_, {day} AS clock_day FROM {departures} x) e LEFT JOIN {changes} c ON e.clock_day = c.day"""


_PLAIN_FLAGS = f"""
WITH departures AS ({_departures(DUCK)}), spans AS (SELECT min(day) AS lo, max(day) + 1 AS hi FROM departures), changes AS ({_change_days(DUCK, 'lo', 'hi')})
{_flagged(DUCK, 'departures', 'changes', "day + cast(split_part(hms, ':', 1) AS int) // 24")}"""


@register("stop_times_ambiguous", oracle(_PLAIN_FLAGS))
def stop_times_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stop event with whether its nominal time is ambiguous on its date, or on the next for hours from 24 on."""
    departures = frame(spark, sf_dir, _departures(SPARK))
    spans = departures.agg(F.min("day").alias("lo"), F.date_add(F.max("day"), 1).alias("hi")).filter("lo IS NOT NULL")
    changes = spark.sql(_change_days(SPARK, "lo", "hi"), spans=spans)
    text = _flagged(SPARK, "{departures}", "{changes}", "date_add(day, int(cast(split_part(hms, ':', 1) AS int) div 24))")
    return spark.sql(text, departures=departures, changes=changes)


@register("ambiguous_by_day", oracle(f"SELECT day, count(*) AS n_stops, count(CASE WHEN ambiguous THEN 1 END) AS n_ambiguous FROM ({_PLAIN_FLAGS}) f GROUP BY day HAVING count(CASE WHEN ambiguous THEN 1 END) > 0"))
def ambiguous_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days with ambiguous stop events, and how many there are."""
    d = stop_times_ambiguous(spark, sf_dir).groupBy("day")
    return d.agg(F.count("*").alias("n_stops"), F.count_if("ambiguous").alias("n_ambiguous")).filter("n_ambiguous > 0")
