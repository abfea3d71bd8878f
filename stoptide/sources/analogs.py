"""Transit relations over the driver's star schema: trips, stop events, feed rows, gaps, pings, pairs.

Each relation is a function of the dialect and may refer to tables and earlier relations in braces.
Where order matters over all rows, Spark's text compares within days, and only days' edges meet in one
place; the oracle's is the plain window.
"""

from __future__ import annotations

from collections.abc import Callable

from stoptide.functions import measures as m
from stoptide.functions.dialect import Spark

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")
RELATIONS: dict[str, Callable[[Spark], str]] = {}
#: Feed window and outage length of the gap relation, in seconds.
WINDOW_START, WINDOW_END, GAP_S = 1704063600, 1706662800, 300


def relation(f: Callable[[Spark], str]) -> Callable[[Spark], str]:
    RELATIONS[f.__name__] = f
    return f


@relation
def trips(d: Spark) -> str:
    return """
    SELECT *, CASE WHEN trip_status = 'no_realtime_data' THEN o_orderstatus = 'O' END AS no_data_in_outage
    FROM (SELECT cast(o_orderdate AS date) AS service_date, o_orderkey AS trip_id, c_nationkey AS route_id,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 2 END AS direction_id,
        o_orderpriority <> '5-LOW' AS in_scope,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'out_of_scope' WHEN o_orderkey % 40 = 0 THEN 'cancelled'
             WHEN o_orderkey % 40 = 1 THEN 'no_realtime_data' ELSE 'in_feed' END AS trip_status, o_orderstatus
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey) t"""


@relation
def stop_rows(d: Spark) -> str:
    """The trip's id has its name before rows are brought together by it: the join with trips then takes that partitioning over."""
    return """
    SELECT trip_id, stop_id, l_partkey, l_quantity, is_timing_stop, count(*) OVER (PARTITION BY trip_id) AS n_stops,
        cast(row_number() OVER (PARTITION BY trip_id ORDER BY l_linenumber, l_partkey, stop_id, l_extendedprice) AS int) AS stop_sequence
    FROM (SELECT l_orderkey AS trip_id, l_suppkey AS stop_id, l_partkey, l_quantity, l_linestatus = 'O' AS is_timing_stop, l_linenumber, l_extendedprice FROM {lineitem}) l"""


@relation
def bounds(d: Spark) -> str:
    return "SELECT trip_id, min(stop_sequence) AS first_seq, max(stop_sequence) AS last_seq, count(*) AS n_stops FROM {stop_rows} GROUP BY trip_id"


@relation
def stop_events(d: Spark) -> str:
    if d.name == "spark":  # sequences are counted from 1, so a trip's ends need no join
        ends, place, last = "{stop_rows} s", "s.stop_sequence = 1", "s.stop_sequence = s.n_stops"
    else:
        ends, place, last = "{stop_rows} s JOIN {bounds} b ON s.trip_id = b.trip_id", "s.stop_sequence = b.first_seq", "s.stop_sequence = b.last_seq"
    return f"""
    SELECT service_date, trip_id, route_id, direction_id, in_scope, trip_status, stop_sequence, stop_id, stop_position, is_timing_stop,
        scheduled_s, scheduled_s + delay_c AS held_s, status, CASE WHEN status = 'observed' THEN delay_c END AS delay_s, l_partkey
    FROM (SELECT *, CASE WHEN is_final THEN NULL WHEN NOT in_scope THEN 'out_of_scope' WHEN trip_status = 'cancelled' THEN 'cancelled'
            WHEN l_partkey % 50 = 1 THEN 'skipped' WHEN l_partkey % 97 = 2 THEN 'dst_ambiguous'
            WHEN trip_status = 'no_realtime_data' OR l_partkey % 20 = 0 THEN 'unobserved' ELSE 'observed' END AS status
        FROM (SELECT t.service_date, t.trip_id, t.route_id, t.direction_id, t.in_scope, t.trip_status, s.stop_sequence, s.stop_id, s.is_timing_stop, s.l_partkey,
                CASE WHEN {place} THEN 'first' WHEN {last} THEN 'final' ELSE 'intermediate' END AS stop_position,
                {last} AS is_final,
                {d.day_epoch('t.service_date')} + 60 * (s.l_partkey % 1440) AS scheduled_s,
                cast(s.l_quantity AS bigint) * 10 - 120 AS delay_c
            FROM {ends} JOIN {{trips}} t ON s.trip_id = t.trip_id) x) y"""


@relation
def day_types(d: Spark) -> str:
    return f"""
    SELECT service_date, {d.month('service_date')} AS month, {d.day_type('service_date')} AS day_type
    FROM (SELECT DISTINCT service_date FROM {{trips}}) x"""


@relation
def day_expanded(d: Spark) -> str:
    kinds = d.explode("'all'", "day_type")
    return f"SELECT service_date, month, {kinds} AS day_type FROM {{day_types}}"


@relation
def complete(d: Spark) -> str:
    return f"SELECT month, count(DISTINCT service_date) AS n_dates, count(DISTINCT service_date) = {d.last_day('month')} AS month_complete FROM {{day_types}} GROUP BY month"


@relation
def set_events(d: Spark) -> str:
    pair = d.explode_if("is_timing_stop", "'all_stops'", "'timing_stops'")
    return f"SELECT service_date, trip_id, route_id, stop_id, scheduled_s, status, delay_s, {pair} AS stop_set FROM {{stop_events}} WHERE stop_position <> 'final' AND in_scope"


@relation
def categories(d: Spark) -> str:
    return "SELECT n_nationkey AS route_id, n_name AS route_name, r_name AS category, CASE WHEN r_name = 'EUROPE' THEN n_name END AS town FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'"


@relation
def stations(d: Spark) -> str:
    return f"""
    SELECT s_suppkey AS stop_id, s_name AS stop_name, CASE WHEN s_suppkey % 3 = 0 THEN {d.text('s_suppkey')} ELSE 'N' || {d.text('s_nationkey')} END AS station_id,
        CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE n_name END AS station_name
    FROM {{supplier}} LEFT JOIN {{nation}} ON s_nationkey = n_nationkey"""


@relation
def departures(d: Spark) -> str:
    """Stop events that tables measure, each with what it stands for; windows that nobody asks for are pruned."""
    marks = ", ".join(f"{m.stands(x)} AS {name}" for name, x in (("stands", ""), ("stands_route", "route_id"), ("stands_hour", "hour_local")))
    return f"SELECT *, {marks} FROM (SELECT *, {d.local_hour('scheduled_s')} AS hour_local FROM {{stop_events}} WHERE stop_position <> 'final' AND in_scope) v"


@relation
def station_departures(d: Spark) -> str:
    return f"SELECT *, {m.stands('station_id')} AS stands_station FROM (SELECT v.*, st.station_id FROM {{departures}} v JOIN {{stations}} st ON v.stop_id = st.stop_id) w"


@relation
def positions(d: Spark) -> str:
    """Where a station's stops stood on each date: some dates lack a position."""
    return f"""
    SELECT DISTINCT e.month, e.service_date, s.station_id, CASE WHEN s.k % 4 <> 0 THEN 56 + s.k * 0.001 + cast(day(e.service_date) AS double) / 1000 END AS lat, CASE WHEN s.k % 4 <> 0 THEN 14 + s.k * 0.001 END AS lon
    FROM (SELECT station_id, min(stop_id) AS k FROM {{stations}} GROUP BY station_id) s CROSS JOIN (SELECT month, service_date FROM {{day_types}} WHERE cast(day(service_date) AS int) % 9 = 1) e"""


@relation
def latest_positions(d: Spark) -> str:
    """The latest of a month's positions of each station, which has one on all of its dates or on none: only the
    month's last such date is paired with stations, so that no task holds stations times dates."""
    return """
    SELECT e.month, s.station_id, CASE WHEN s.k % 4 <> 0 THEN 56 + s.k * 0.001 + cast(day(e.service_date) AS double) / 1000 END AS lat, CASE WHEN s.k % 4 <> 0 THEN 14 + s.k * 0.001 END AS lon
    FROM (SELECT station_id, min(stop_id) AS k FROM {stations} GROUP BY station_id) s CROSS JOIN (SELECT month, max(service_date) AS service_date FROM {day_types} WHERE cast(day(service_date) AS int) % 9 = 1 GROUP BY month) e"""


def month_day(d: Spark, x: str) -> str:
    """The day of the feed's month that a date of the schedule is dealt to."""
    if d.name == "spark":
        return f"date_add({d.day('2024-01-01')}, cast({d.day_epoch(x)} / 86400 % 30 AS int))"
    return f"({d.day('2024-01-01')} + cast({d.day_epoch(x)} // 86400 % 30 AS int))"


@relation
def month_days(d: Spark) -> str:
    """The schedule's dates dealt over the days of the feed's month, so that both sides of a daily table meet."""
    return f"SELECT service_date, trip_date, {d.day_type('service_date')} AS day_type FROM (SELECT {month_day(d, 'trip_date')} AS service_date, trip_date FROM (SELECT DISTINCT service_date AS trip_date FROM {{trips}}) x) y"


@relation
def feed(d: Spark) -> str:
    return f"""
    SELECT header_s, event_id AS snapshot_file, user_id AS trip_id, start_date, stop_sequence, header_s + value_s - 200 AS held_s, value_s,
        event_id % 10 <> 0 AS uncertainty_present, CASE WHEN event_id % 10 <> 0 THEN 0 END AS uncertainty,
        CASE WHEN event_id % 37 = 0 THEN 'SKIPPED' ELSE 'SCHEDULED' END AS stop_relationship,
        CASE WHEN event_id % 41 = 0 THEN 'CANCELED' ELSE 'SCHEDULED' END AS trip_relationship, event_type, event_value
    FROM (SELECT event_id, user_id, event_type, cast(ts AS date) AS start_date, {d.ts_epoch('ts')} AS header_s, cast(floor(value) AS bigint) AS value_s, value AS event_value,
            CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS stop_sequence
        FROM {{events}}) x"""


@relation
def snapshots(d: Spark) -> str:
    return "SELECT header_s, min(snapshot_file) AS canonical_file, count(*) AS n_files FROM {feed} GROUP BY header_s"


@relation
def day_edges(d: Spark) -> str:
    return f"SELECT day_, lo, hi, n, lag(hi) OVER (ORDER BY day_) AS before_hi, coalesce(sum(n) OVER (ORDER BY day_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_n FROM (SELECT {d.idiv('header_s', '86400')} AS day_, min(header_s) AS lo, max(header_s) AS hi, count(*) AS n FROM {{snapshots}} GROUP BY {d.idiv('header_s', '86400')}) x"


@relation
def steps(d: Spark) -> str:
    """Snapshots with the one before and their number in order."""
    if d.name == "duck":
        return "SELECT header_s, lag(header_s) OVER (ORDER BY header_s) AS before_s, row_number() OVER (ORDER BY header_s) AS i FROM {snapshots}"
    return """
    SELECT s.header_s, coalesce(s.inner_s, e.before_hi) AS before_s, e.before_n + s.k AS i
    FROM (SELECT header_s, header_s div 86400 AS day_, lag(header_s) OVER (PARTITION BY header_s div 86400 ORDER BY header_s) AS inner_s, row_number() OVER (PARTITION BY header_s div 86400 ORDER BY header_s) AS k FROM {snapshots}) s
    JOIN {day_edges} e ON s.day_ = e.day_"""


@relation
def gaps(d: Spark) -> str:
    return f"""
    SELECT gap_start_s, gap_end_s, gap_end_s - gap_start_s AS gap_s, kind, {d.local_date('gap_start_s')} AS service_date FROM (
        SELECT before_s AS gap_start_s, header_s AS gap_end_s, 'between' AS kind FROM {{steps}}
        UNION ALL SELECT {WINDOW_START} AS gap_start_s, min(header_s) AS gap_end_s, 'before_first' AS kind FROM {{snapshots}}
        UNION ALL SELECT max(header_s) AS gap_start_s, {WINDOW_END} AS gap_end_s, 'after_last' AS kind FROM {{snapshots}}) g
    WHERE gap_end_s - gap_start_s > {GAP_S}"""


@relation
def clipped(d: Spark) -> str:
    return f"""
    SELECT service_date, day_start, day_end, greatest(gap_start_s, day_start) AS gap_start_s, least(gap_end_s, day_end) AS gap_end_s,
        least(gap_end_s, day_end) - greatest(gap_start_s, day_start) AS gap_s
    FROM (SELECT *, {d.utc_of('service_date', 0)} AS day_start, {d.utc_of('service_date', 24)} AS day_end FROM {{gaps}}) x
    WHERE greatest(gap_start_s, day_start) < least(gap_end_s, day_end)"""


@relation
def runs(d: Spark) -> str:
    """Scheduled trips of the feed's days: every customer is a trip of each day, two to fourteen minutes long.

    Spark takes the days by a join: what an explode adds is in no estimate of size, so that joins with this
    relation would broadcast it, thirty times the customers.
    """
    if d.name == "spark":
        source = "SELECT c_custkey AS trip_id, c_nationkey, date_add(DATE '2024-01-01', cast(k AS int)) AS service_date FROM {customer} CROSS JOIN (SELECT id AS k FROM range(30)) n"
    else:
        source = "SELECT c_custkey AS trip_id, c_nationkey, cast(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS date) AS service_date FROM {customer}"
    return f"""
    SELECT service_date, trip_id, scheduled_stops, first_s, first_s + 120 + 120 * (trip_id % 7) AS last_s, in_scope
    FROM (SELECT service_date, trip_id, 2 + trip_id % 7 AS scheduled_stops, c_nationkey % 11 <> 0 AS in_scope, {d.utc_of('service_date', 0)} + 600 * (trip_id * 7 % 140) AS first_s
        FROM ({source}) x) r"""


@relation
def pings(d: Spark) -> str:
    return "SELECT user_id AS vehicle_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE user_id % 50 END AS trip_id, header_s, event_type AS stop, event_id, event_value AS distance_m FROM (SELECT snapshot_file AS event_id, trip_id AS user_id, header_s, event_type, event_value FROM {feed}) x"


@relation
def timing(d: Spark) -> str:
    w = "OVER (PARTITION BY service_date, trip_id ORDER BY stop_sequence)"
    return f"""
    SELECT service_date, trip_id, route_id, direction_id, stop_sequence, stop_id, status, delay_s, scheduled_s, row_number() {w} AS timing_index,
        lead(stop_id) {w} AS next_stop_id, lead(status) {w} AS next_status, lead(delay_s) {w} AS next_delay, lead(stop_sequence) {w} AS next_sequence
    FROM {{stop_events}} WHERE in_scope AND is_timing_stop AND stop_position <> 'final'"""


@relation
def pairs(d: Spark) -> str:
    return """
    SELECT *, next_delay - delay_s AS delta, status IN ('observed', 'unobserved') AND next_status IN ('observed', 'unobserved') AS pair_eligible,
        status = 'observed' AND next_status = 'observed' AS pair_observed
    FROM {timing} WHERE next_stop_id IS NOT NULL"""


@relation
def journeys(d: Spark) -> str:
    return f"""
    SELECT e.service_date, e.trip_id, e.route_id, e.direction_id, c.category, min(e.scheduled_s) - {d.day_epoch('e.service_date')} AS start_s, dt.day_type,
        md5({d.list_by("e.stop_id || ':' || e.is_timing_stop" if d.name == 'duck' else "concat(e.stop_id, ':', e.is_timing_stop)", 'e.stop_sequence', '|')}) AS pattern
    FROM {{stop_events}} e JOIN {{day_types}} dt ON e.service_date = dt.service_date LEFT JOIN {{categories}} c ON e.route_id = c.route_id
    WHERE e.in_scope GROUP BY e.service_date, e.trip_id, e.route_id, e.direction_id, c.category, dt.day_type"""
