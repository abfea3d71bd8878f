"""Scans, the schedule, feed rows and their last appearance, gaps and feed quality."""

from __future__ import annotations

from stoptide.functions import measures as m
from stoptide.functions.dialect import Spark
from stoptide.plans.engine import stated


def hms_seconds(d: Spark, text: str) -> str:
    """Seconds of an HH:MM:SS text, hours over 23 included."""
    h, mi, s = (f"cast({d.part(text, ':', k)} AS bigint)" for k in (1, 2, 3))
    return f"({h} * 3600 + {mi} * 60 + {s})"


def hms_text(d: Spark) -> str:
    """A schedule text with hours 0 to 29 from a row's keys."""
    return f"({d.pad2('l_partkey % 30')} || ':' || {d.pad2('l_suppkey % 60')} || ':00')"


@stated
def scan_filter_project(d: Spark) -> str:
    """Range and list filters with three columns of sixteen: both reach the scan."""
    return f"SELECT l_orderkey, l_quantity, cast(l_shipdate AS date) AS ship_date FROM {{lineitem}} WHERE l_quantity BETWEEN 10 AND 12 AND l_returnflag IN ('A', 'R') AND l_shipdate >= {d.day('1997-01-01')}"


@stated
def active_service(d: Spark) -> str:
    """Services by weekday flag, without removed and with added ones; a service may not be removed by null."""
    window = f"o_orderdate >= {d.day('1997-03-01')} AND o_orderdate < {d.day('1997-04-01')}"
    return f"""
    SELECT service_id FROM (
        SELECT c_custkey AS service_id FROM {{customer}} WHERE c_mktsegment = 'BUILDING'
            AND c_custkey NOT IN (SELECT o_custkey FROM {{orders}} WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL AND {window})
        UNION SELECT o_custkey FROM {{orders}} WHERE o_orderstatus = 'O' AND {window}) x"""


@stated
def trip_scope(d: Spark) -> str:
    """Scope by operator with the number of operator rows; a missing operator is in scope."""
    return "SELECT t.trip_id, c.c_name AS operator, count(*) OVER (PARTITION BY t.trip_id) AS n_operator_rows, c.c_name IS NULL OR t.route_id % 5 <> 0 AS in_scope FROM {trips} t LEFT JOIN (SELECT c_nationkey, min(c_name) AS c_name FROM {customer} WHERE c_nationkey % 3 <> 0 GROUP BY c_nationkey) c ON t.route_id = c.c_nationkey"


@stated
def trip_stop_bounds(d: Spark) -> str:
    """First and last sequence and the number of stops of each trip."""
    return "SELECT trip_id, first_seq, last_seq, n_stops FROM {bounds}"


@stated
def first_final_stop(d: Spark) -> str:
    """The first and the final stop of each trip and their times."""
    return f"SELECT trip_id, {d.earliest('stop_id', 'stop_sequence')} AS first_stop, {d.latest('stop_id', 'stop_sequence')} AS final_stop, {d.earliest('scheduled_s', 'stop_sequence')} AS first_s, {d.latest('scheduled_s', 'stop_sequence')} AS final_s FROM {{stop_events}} GROUP BY trip_id"


@stated
def snapshot_dedup(d: Spark) -> str:
    """All rows of one file, the smallest name, per header time."""
    return "SELECT f.header_s, f.snapshot_file, f.trip_id FROM {feed} f JOIN {snapshots} s ON f.header_s = s.header_s AND f.snapshot_file = s.canonical_file"


@stated
def trip_last_appearance(d: Spark) -> str:
    """First and last time of each trip in the feed, and its last relationship."""
    return f"SELECT trip_id, min(header_s) AS first_seen, max(header_s) AS last_seen, {d.latest('trip_relationship', 'header_s')} AS last_relationship FROM (SELECT trip_id, header_s, min(trip_relationship) AS trip_relationship FROM {{feed}} GROUP BY trip_id, header_s) x GROUP BY trip_id"


LAST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trip_id, stop_sequence ORDER BY header_s DESC, snapshot_file DESC) AS rn FROM {feed}) r WHERE rn = 1) z"
#: A maximum combines before the shuffle, so a hot key sends one row a task.
LAST_ROW = "(SELECT trip_id, stop_sequence, t.* FROM (SELECT trip_id, stop_sequence, max(struct(header_s, snapshot_file, stop_relationship, uncertainty_present, uncertainty, held_s)) AS t FROM {feed} GROUP BY trip_id, stop_sequence) r) z"


def _last_fields(rows: str) -> str:
    return f"SELECT trip_id, stop_sequence, header_s AS last_seen, stop_relationship, CASE WHEN uncertainty_present THEN uncertainty END AS uncertainty, held_s, CASE WHEN held_s IS NULL THEN NULL ELSE uncertainty_present AND uncertainty = 0 END AS marker FROM {rows}"


@stated(plainly=lambda d: _last_fields(LAST))
def stop_last_appearance(d: Spark) -> str:
    """All fields of the latest row of each trip and stop; a held value only where it is present."""
    return _last_fields(LAST_ROW)


@stated
def trip_status(d: Spark) -> str:
    """Trips per status and outage flag."""
    return "SELECT trip_status, in_scope, no_data_in_outage, count(*) AS trips FROM {trips} GROUP BY trip_status, in_scope, no_data_in_outage"


@stated
def stop_event_status(d: Spark) -> str:
    """Every stop event with position, times, status and delay."""
    return "SELECT trip_id, stop_sequence, stop_position, status, delay_s, scheduled_s, held_s, is_timing_stop FROM {stop_events}"


@stated
def dst_ambiguous_flags(d: Spark) -> str:
    """Nominal times at 2 or 3 o'clock, by whether they fall on the date or the day after."""
    hour = f"cast({d.part('hms', ':', 1)} AS int)"
    return f"SELECT {hour} >= 24 AS next_day, {hour} % 24 IN (2, 3) AS ambiguous, count(*) AS n FROM (SELECT {hms_text(d)} AS hms FROM {{lineitem}}) x GROUP BY {hour} >= 24, {hour} % 24 IN (2, 3)"


@stated
def timing_stop_flag(d: Spark) -> str:
    """The timepoint text as a flag: 1, empty and null are true, 0 is false, anything else is null."""
    return "SELECT timepoint, CASE WHEN timepoint IS NULL OR timepoint IN ('1', '') THEN true WHEN timepoint = '0' THEN false END AS is_timing_stop, count(*) AS n FROM (SELECT CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '1' WHEN 2 THEN '' WHEN 3 THEN '0' ELSE 'x' END AS timepoint FROM {lineitem}) t GROUP BY timepoint"


@stated
def scheduled_time_utc(d: Spark) -> str:
    """Schedule texts as epochs: seconds from twelve hours before local noon, which is right on days that change the clock."""
    return f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, hms, {d.utc_of('day', 12)} - 43200 + {hms_seconds(d, 'hms')} AS scheduled_s FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate AS date) AS day, {hms_text(d)} AS hms FROM {{lineitem}}) x"


@stated
def local_hour_conversion(d: Spark) -> str:
    """Epochs as local wall time, date and hour."""
    return f"SELECT snapshot_file, {d.local('header_s')} AS local_time, {d.local_date('header_s')} AS local_day, {d.local_hour('header_s')} AS local_hour FROM {{feed}}"


@stated
def feed_gaps(d: Spark) -> str:
    """Outages between snapshots and at the window's edges."""
    return "SELECT service_date, gap_start_s, gap_end_s, gap_s, kind FROM {gaps}"


def _inside(key: str, spans: str) -> str:
    return f"SELECT s.{key}, EXISTS (SELECT 1 FROM {{gaps}} g WHERE g.gap_start_s <= s.lo AND g.gap_end_s >= s.hi) AS in_outage FROM ({spans}) s"


def _inside_by_day(key: str, spans: str) -> str:
    """Outages stand under each day they touch and never overlap, so a span's first day finds the only one that can hold it."""
    days = "(SELECT gap_start_s, gap_end_s, explode(sequence(gap_start_s div 86400, gap_end_s div 86400)) AS day_ FROM {gaps}) g"
    return f"SELECT s.{key}, g.day_ IS NOT NULL AS in_outage FROM ({spans}) s LEFT JOIN {days} ON s.lo div 86400 = g.day_ AND g.gap_start_s <= s.lo AND g.gap_end_s >= s.hi"


ROW_SPANS = "SELECT snapshot_file, header_s AS lo, header_s + 300 AS hi FROM {feed}"
TRIP_SPANS = "SELECT trip_id, min(held_s) AS lo, min(held_s) + 1200 AS hi FROM {feed} GROUP BY trip_id"


@stated(plainly=lambda d: _inside("snapshot_file", ROW_SPANS))
def outage_flag(d: Spark) -> str:
    """Whether the five minutes after a row lie inside an outage."""
    return _inside_by_day("snapshot_file", ROW_SPANS)


@stated(plainly=lambda d: _inside("trip_id", TRIP_SPANS))
def trip_outage_flag(d: Spark) -> str:
    """Whether a trip's span lies inside an outage."""
    return _inside_by_day("trip_id", TRIP_SPANS)


@stated
def gap_clip_overlap(d: Spark) -> str:
    """Minutes of outage per date within the day and between 6 and 22 local."""
    return f"SELECT service_date, cast(sum(gap_s) AS bigint) AS outage_s, round(cast(sum(greatest(0, least(gap_end_s, {d.utc_of('service_date', 22)}) - greatest(gap_start_s, {d.utc_of('service_date', 6)}))) AS double) / 60, 2) AS minutes_06_22 FROM {{clipped}} GROUP BY service_date"


@stated
def largest_gap_per_day(d: Spark) -> str:
    """The longest clipped outage of each date; the earlier one on ties."""
    return "SELECT service_date, gap_start_s, gap_end_s, gap_s FROM (SELECT *, row_number() OVER (PARTITION BY service_date ORDER BY gap_s DESC, gap_start_s ASC) AS rn FROM {clipped}) x WHERE rn = 1"


@stated
def feed_quality(d: Spark) -> str:
    """Files, distinct snapshots, duplicates, longest gap and gaps over 300 s, and hours without snapshots, per date."""
    day = d.local_date("header_s")
    return f"""
    SELECT a.service_date, a.archive_files, a.distinct_snapshots, a.archive_files - a.distinct_snapshots AS duplicate_snapshots, a.first_s, a.last_s, b.max_gap_s, b.gaps_over_300s, 24 - a.hours AS hours_missing
    FROM (SELECT {day} AS service_date, count(DISTINCT snapshot_file) AS archive_files, count(DISTINCT header_s) AS distinct_snapshots, min(header_s) AS first_s, max(header_s) AS last_s, count(DISTINCT {d.local_hour('header_s')}) AS hours FROM {{feed}} GROUP BY {day}) a
    JOIN (SELECT service_date, max(gap_s) AS max_gap_s, {m.count_if('gap_s > 300')} AS gaps_over_300s FROM (SELECT {day} AS service_date, header_s - lag(header_s) OVER (PARTITION BY {day} ORDER BY header_s) AS gap_s FROM {{snapshots}}) y GROUP BY service_date) b
    ON a.service_date = b.service_date"""


@stated
def schedule_mismatch(d: Spark) -> str:
    """Rows whose schedule by the feed isn't ours; rows without status drop, ambiguous ones are left out."""
    return f"""
    SELECT count(*) AS updates, count(DISTINCT {d.tup('trip_id', 'stop_sequence')}) AS stop_events
    FROM (SELECT trip_id, stop_sequence, held_s - value_s AS feed_s, header_s - 200 + CASE WHEN snapshot_file % 53 = 0 THEN 60 ELSE 0 END AS own_s,
            CASE WHEN snapshot_file % 11 = 0 THEN NULL WHEN snapshot_file % 13 = 0 THEN 'dst_ambiguous' ELSE 'observed' END AS status FROM {{feed}}) x
    WHERE feed_s IS DISTINCT FROM own_s AND status <> 'dst_ambiguous'"""


@stated
def unmatched_trips(d: Spark) -> str:
    """Distinct feed trips that aren't scheduled."""
    return "SELECT count(DISTINCT f.trip_id) AS unmatched FROM {feed} f WHERE NOT EXISTS (SELECT 1 FROM {customer} c WHERE c.c_custkey = f.trip_id)"


@stated
def prior_day_rows(d: Spark) -> str:
    """Rows of another start date than the first; null dates count as neither."""
    return "SELECT start_date = (SELECT min(start_date) FROM {feed}) AS own_date, count(*) AS n, count(DISTINCT trip_id) AS trips FROM {feed} WHERE start_date IS NOT NULL GROUP BY start_date = (SELECT min(start_date) FROM {feed})"
