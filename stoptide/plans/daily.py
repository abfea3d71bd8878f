"""The daily tables' trip rows, checks across all published tables, and what the feed's studies count beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.catalog import register
from stoptide.functions import measures as m
from stoptide.functions.dialect import DUCK, SPARK, Spark
from stoptide.plans import tabs
from stoptide.plans.engine import frame, oracle, stated
from stoptide.sources.scratch import new_folder

# ---------------------------------------------------------------- trips


def _trip_rows(d: Spark, outage: str) -> str:
    """Scheduled trips beside what the feed last said of them; cancelled is the last row's word."""
    seen = f"SELECT trip_id, start_date, min(header_s) AS first_seen_s, max(header_s) AS last_seen_s, count(*) AS n_rows, {d.latest('trip_relationship', d.tup('header_s', 'snapshot_file'))} AS said FROM {{feed}} GROUP BY trip_id, start_date"
    status = "CASE WHEN NOT r.in_scope THEN 'out_of_scope' WHEN f.trip_id IS NULL THEN 'no_realtime_data' WHEN f.said = 'CANCELED' THEN 'cancelled' ELSE 'in_feed' END"
    base = f"SELECT r.*, f.first_seen_s, f.last_seen_s, coalesce(f.n_rows, 0) AS n_rows, {status} AS trip_status FROM {{runs}} r LEFT JOIN ({seen}) f ON r.trip_id = f.trip_id AND r.service_date = f.start_date"
    return outage.replace("BASE", f"({base})")


_COLUMNS = "b.service_date, b.trip_id, b.scheduled_stops, b.first_s, b.last_s, b.in_scope, b.first_seen_s, b.last_seen_s, b.n_rows, b.trip_status"


@stated(
    plainly=lambda d: _trip_rows(
        d,
        f"SELECT {_COLUMNS}, CASE WHEN b.trip_status = 'no_realtime_data' THEN EXISTS (SELECT 1 FROM {{gaps}} g WHERE g.gap_start_s <= b.first_s AND b.last_s <= g.gap_end_s) END AS no_data_in_outage FROM BASE b",
    )
)
def trip_rows(d: Spark) -> str:
    """Every scheduled trip with its span, when the feed first and last showed it, its status, and whether one without data lies in an outage.

    Outages stand under each day they touch and don't overlap, so a span's first day finds the only one that can hold it.
    """
    days = "(SELECT gap_start_s, gap_end_s, explode(sequence(gap_start_s div 86400, gap_end_s div 86400)) AS day_ FROM {gaps}) g"
    inside = f"SELECT {_COLUMNS}, CASE WHEN b.trip_status = 'no_realtime_data' THEN g.day_ IS NOT NULL END AS no_data_in_outage FROM BASE b LEFT JOIN {days} ON b.first_s div 86400 = g.day_ AND g.gap_start_s <= b.first_s AND b.last_s <= g.gap_end_s"
    return _trip_rows(d, inside)


@stated
def trip_row_summary(d: Spark) -> str:
    """Trips by date, status and outage flag."""
    return f"SELECT service_date, trip_status, no_data_in_outage, count(*) AS trips, cast(sum(n_rows) AS bigint) AS feed_rows FROM ({trip_rows(d) if d.name == 'spark' else _trip_rows(d, f'SELECT {_COLUMNS}, CASE WHEN b.trip_status = {chr(39)}no_realtime_data{chr(39)} THEN EXISTS (SELECT 1 FROM {{gaps}} g WHERE g.gap_start_s <= b.first_s AND b.last_s <= g.gap_end_s) END AS no_data_in_outage FROM BASE b')}) t GROUP BY service_date, trip_status, no_data_in_outage"


# ---------------------------------------------------------------- checks across tables

EVENTS = (*m.EVENT_COUNTS, "observed_trips")
TRIPS = tuple(m.TRIP_COUNTS)
#: Each published table: its statement, its key, and the counts it has.
TABLES = {
    "network_monthly": (tabs.network_monthly, "", (*EVENTS, *TRIPS)),
    "route_monthly": (tabs.route_monthly, "route_id", (*EVENTS, *TRIPS)),
    "station_monthly": (tabs.station_monthly, "station_id", EVENTS),
    "hour_monthly": (tabs.hour_monthly, "hour_local", EVENTS),
    "category_monthly": (tabs.category_monthly, "route_category", (*EVENTS, *TRIPS)),
    "route_daily": (tabs.route_daily, "route_id", (*EVENTS, *TRIPS)),
}
_COUNTED = "service_date, trip_id, route_id, is_timing_stop, status, delay_s"
#: What the tables are made of, and the columns of it that their counts need.
STORED = {
    "trips": "service_date, trip_id, route_id, direction_id, in_scope, trip_status, no_data_in_outage",
    "departures": f"{_COUNTED}, stop_id, hour_local, stands, stands_route, stands_hour",
    "station_departures": f"{_COUNTED}, station_id, stands_station",
}
MONTHLY = tuple(t for t in TABLES if t != "route_daily")


def _checks() -> list[tuple[str, str, str, str, tuple[str, ...], str, tuple[str, ...]]]:
    """(name, table, part, whole, keys, what is wrong, columns): part is summed and must be, or not exceed, whole."""
    out = []
    for t in ("route_monthly", "station_monthly", "hour_monthly", "category_monthly"):
        columns = tuple(x for x in TABLES[t][2] if x != "observed_trips") if t == "category_monthly" else ("eligible_departures", "observed_departures")
        out.append((f"{t} sums to the network", t, f"origin = '{t}'", "origin = 'network_monthly'", ("month", "day_type", "stop_set"), "<>", columns))
    out.append(("dates sum to the month", "route_daily", "origin = 'route_daily'", "origin = 'route_monthly' AND day_type = 'all'", ("month", "stop_set", "key"), "<>", TABLES["route_daily"][2]))
    for t in MONTHLY:
        out.append((f"{t}: day types sum to all", t, f"origin = '{t}' AND day_type <> 'all'", f"origin = '{t}' AND day_type = 'all'", ("month", "stop_set", "key"), "<>", TABLES[t][2]))
    for t in TABLES:
        keys = ("service_date", "key") if t == "route_daily" else ("month", "day_type", "key")
        out.append((f"{t}: timing stops are some of all stops", t, f"origin = '{t}' AND stop_set = 'timing_stops'", f"origin = '{t}' AND stop_set = 'all_stops'", keys, ">", EVENTS))
        if TABLES[t][2] != EVENTS:
            out.append((f"{t}: trips are the same for both stop sets", t, f"origin = '{t}' AND stop_set = 'timing_stops'", f"origin = '{t}' AND stop_set = 'all_stops'", keys, "<>", TRIPS))
    return out


def _facts(d: Spark, t: str, statement: str) -> str:
    """A published table's counts under common names."""
    _, key, columns = TABLES[t]
    daily, text = t == "route_daily", "string" if d.name == "spark" else "varchar"
    counts = ", ".join(f"cast({x} AS bigint) AS {x}" if x in columns else f"cast(NULL AS bigint) AS {x}" for x in (*EVENTS, *TRIPS))
    return f"SELECT '{t}' AS origin, {'service_date' if daily else 'cast(NULL AS date)'} AS service_date, {d.month('service_date') if daily else 'month'} AS month, day_type, stop_set, {f'cast({key} AS {text})' if key else repr('')} AS key, {counts} FROM ({statement}) t"


def _plain_consistency() -> str:
    tables = ", ".join(f"{t} AS MATERIALIZED ({_facts(DUCK, t, TABLES[t][0](DUCK))})" for t in TABLES)
    rows = []
    for name, t, part, whole, keys, wrong, columns in _checks():
        other = "network_monthly" if "network_monthly" in whole else "route_monthly" if "route_monthly" in whole else t
        k = ", ".join(keys)
        for x in columns:
            sides = [f"(SELECT {k}, sum({x}) AS s FROM {source} WHERE {where} GROUP BY {k}) {alias}" for source, where, alias in ((t, part, "a"), (other, whole, "b"))]
            on = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in keys)
            rows.append(f"SELECT '{name}: {x}' AS check_name, count(CASE WHEN a.s {wrong} b.s THEN 1 END) AS violations, count(*) AS compared FROM {sides[0]} JOIN {sides[1]} ON {on}")
    return f"WITH {tables}\n" + "\nUNION ALL ".join(rows)


@register("table_consistency", oracle(_plain_consistency()))
def table_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check across the published tables, with violations and how many keys were compared.

    Trips and departures are stored once, with what stands for a trip, so that a table is an aggregation
    of stored rows. Each table is made once from them by its own statement and its counts are stored; a
    check is one aggregation over those few rows, all of its columns together.
    """
    path, made = new_folder(spark, "published"), {}
    for name, columns in STORED.items():
        at = new_folder(spark, name)
        frame(spark, sf_dir, f"SELECT {columns} FROM {{{name}}}", made).write.parquet(at)
        made[name] = spark.read.parquet(at)
    for t in TABLES:
        frame(spark, sf_dir, _facts(SPARK, t, TABLES[t][0](SPARK)), made).write.mode("append").partitionBy("origin").parquet(path)
    facts, out = spark.read.parquet(path), None
    for name, _, part, whole, keys, wrong, columns in _checks():
        sides = [F.sum(F.when(F.expr(where), F.col(x))).alias(f"{side}{i}") for i, x in enumerate(columns) for side, where in (("a", part), ("b", whole))]
        both = facts.filter(f"({part}) OR ({whole})").groupBy(*keys).agg(*sides, F.count_if(F.expr(part)).alias("n_a"), F.count_if(F.expr(whole)).alias("n_b")).filter("n_a > 0 AND n_b > 0")

        def broken(i: int, wrong: str = wrong) -> Column:
            return F.count_if(F.expr(f"a{i} {wrong} b{i}")).alias(f"v{i}")

        counted = both.agg(F.count("*").alias("compared"), *(broken(i) for i in range(len(columns))))
        pairs = ", ".join(f"'{name}: {x}', v{i}" for i, x in enumerate(columns))
        rows = counted.selectExpr("compared", f"stack({len(columns)}, {pairs}) AS (check_name, violations)").select("check_name", "violations", "compared")
        out = rows if out is None else out.union(rows)
    return out


# ---------------------------------------------------------------- the feed's studies


@stated
def trip_level_distribution(d: Spark) -> str:
    """Observations of a trip in a snapshot by its relationship, the trips behind them, and how many of those are scheduled."""
    seen = "SELECT DISTINCT header_s, trip_id, start_date, trip_relationship FROM {feed}"
    return f"SELECT s.trip_relationship, count(*) AS observations, count(DISTINCT {d.tup('s.trip_id', 's.start_date')}) AS trips, count(DISTINCT CASE WHEN r.trip_id IS NOT NULL THEN {d.tup('s.trip_id', 's.start_date')} END) AS scheduled FROM ({seen}) s LEFT JOIN {{runs}} r ON s.trip_id = r.trip_id AND s.start_date = r.service_date GROUP BY s.trip_relationship"


@stated
def schedule_coverage(d: Spark) -> str:
    """Scheduled trips per date that the feed shows, and those it never does."""
    seen = "SELECT DISTINCT trip_id, start_date FROM {feed}"
    return f"SELECT r.service_date, count(*) AS scheduled, count(s.trip_id) AS seen, count(*) - count(s.trip_id) AS never_seen, {m.share('count(s.trip_id)', 'count(*)')} AS seen_share FROM {{runs}} r LEFT JOIN ({seen}) s ON r.trip_id = s.trip_id AND r.service_date = s.start_date GROUP BY r.service_date"


def _plain_appearance(d: Spark) -> str:
    qs = ", ".join(f"{d.quantile('f.header_s - f.held_s', q / 100, 'true')} AS p{q}" for q in (5, 25, 50, 75, 95))
    marks = "SELECT trip_id, start_date, stop_sequence, min(CASE WHEN uncertainty_present THEN header_s END) AS first_marked, max(CASE WHEN NOT uncertainty_present THEN header_s END) AS last_plain FROM {feed} GROUP BY trip_id, start_date, stop_sequence"
    return f"""
    SELECT (SELECT count(*) FROM ({marks}) a WHERE first_marked IS NOT NULL) AS n_appears, (SELECT count(*) FROM ({marks}) b WHERE last_plain > first_marked) AS n_then_disappears, count(*) AS n_rows, {qs}
    FROM ({marks}) s JOIN {{feed}} f ON f.trip_id = s.trip_id AND f.start_date = s.start_date AND f.stop_sequence = s.stop_sequence AND f.header_s = s.first_marked"""


@stated(plainly=_plain_appearance)
def marker_appearance(d: Spark) -> str:
    """Stops whose marker appears, those where it goes again, and how long after the held time it first shows: one pass by window."""
    by = "OVER (PARTITION BY trip_id, start_date, stop_sequence)"
    qs = ", ".join(f"{d.quantile('header_s - held_s', q / 100, 'header_s = first_marked')} AS p{q}" for q in (5, 25, 50, 75, 95))
    rows = f"SELECT *, min(CASE WHEN uncertainty_present THEN header_s END) {by} AS first_marked, max(CASE WHEN NOT uncertainty_present THEN header_s END) {by} AS last_plain, row_number() OVER (PARTITION BY trip_id, start_date, stop_sequence ORDER BY header_s, snapshot_file) AS k FROM {{feed}}"
    return f"SELECT {m.count_if('k = 1 AND first_marked IS NOT NULL')} AS n_appears, {m.count_if('k = 1 AND last_plain > first_marked')} AS n_then_disappears, {m.count_if('header_s = first_marked')} AS n_rows, {qs} FROM ({rows}) w"


@stated
def ping_guardrails(d: Spark) -> str:
    """Pings outside their trip's window of 30 minutes before to 90 after, the trips they belong to, and the time between a vehicle's pings."""
    spans = "(SELECT trip_id, service_date, first_s - 1800 AS lo, last_s + 5400 AS hi FROM {runs}) w"
    once = f"(SELECT DISTINCT trip_id, trip_id % 50 AS vehicle_id, start_date, header_s FROM {{feed}}) p"
    joined = f"SELECT p.trip_id, p.vehicle_id, p.header_s, p.header_s BETWEEN w.lo AND w.hi AS in_window FROM {once} JOIN {spans} ON p.trip_id = w.trip_id AND p.start_date = w.service_date"
    steps = f"SELECT header_s - lag(header_s) OVER (PARTITION BY vehicle_id ORDER BY header_s) AS step_s FROM (SELECT DISTINCT vehicle_id, header_s FROM ({joined}) a) b"
    qs = ", ".join(f"{d.quantile('step_s', q / 100, 'step_s IS NOT NULL')} AS step_p{q}" for q in (5, 25, 50, 75, 95))
    counts = f"SELECT count(*) AS n_total, {m.count_if('NOT in_window')} AS n_outside, {m.share(m.count_if('NOT in_window'), 'count(*)')} AS share_outside, count(DISTINCT trip_id) AS n_trips, count(DISTINCT CASE WHEN NOT in_window THEN trip_id END) AS n_trips_outside FROM ({joined}) c"
    return f"SELECT * FROM ({counts}) x CROSS JOIN (SELECT count(step_s) AS n_steps, {qs} FROM ({steps}) s) y"
