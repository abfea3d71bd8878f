"""The journey study's remaining results, and labels of routes from the latest names."""

from __future__ import annotations

from stoptide.functions import measures as m
from stoptide.functions.dialect import Spark
from stoptide.plans.engine import stated
from stoptide.plans.study import RECURRING, _ambiguous, _recurring

#: The part of the day that is looked at, in seconds, as starts here lie early; how many a category shows (a fixed value).
PEAK, SHOWN = "BETWEEN 10800 AND 64799", 15
#: Observed trips that a group needs here; the study asks for 20 of a month's dates.
LEAST_TRIPS = 2
ON_TIME = f"BETWEEN {m.EARLY} AND {m.LATE}"


def _safe(d: Spark) -> str:
    on = " AND ".join(f"r.{k.strip()} = a.{k.strip()}" for k in RECURRING.split(","))
    return f"(SELECT r.*, {m.share('r.observed', 'r.eligible')} AS coverage, {m.share('r.on_time', 'r.observed')} AS punctuality FROM ({_recurring(d)}) r WHERE NOT EXISTS (SELECT 1 FROM ({_ambiguous()}) a WHERE {on}))"


FLOOR = f"observed_trips >= {LEAST_TRIPS} AND coverage >= 0.9"


def _by_category(d: Spark, rows: str, order: str) -> str:
    """The first of each category, in a total order."""
    named = f"SELECT coalesce(c.category, 'Unmapped') AS category, s.* FROM {rows} s LEFT JOIN {{categories}} c ON s.route_id = c.route_id"
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {order}) AS rank_ FROM ({named}) n) r WHERE rank_ <= {SHOWN}"


@stated
def recurring_candidates(d: Spark) -> str:
    """Per category the peak's recurring departures that are late on the most dates, of those that pass the floor."""
    return _by_category(d, f"(SELECT * FROM {_safe(d)} x WHERE {FLOOR} AND start_s {PEAK})", "late_dates DESC, route_id ASC NULLS LAST, direction_id ASC NULLS LAST, start_s ASC, day_type ASC")


def _segments(d: Spark, keys: str, where: str) -> str:
    qs = f"{d.quantile('delta', 0.5, 'pair_observed')} AS median_change, {d.quantile('delta', 0.9, 'pair_observed')} AS p90_change"
    late = f"{m.count_if(f'pair_observed AND delay_s <= {m.LATE} AND next_delay > {m.LATE}')} AS became_late, {m.count_if(f'pair_observed AND delay_s > {m.LATE} AND next_delay <= {m.LATE}')} AS recovered_below_late"
    both = "(SELECT p.*, j.start_s, j.day_type FROM {pairs} p JOIN {journeys} j ON p.service_date = j.service_date AND p.trip_id = j.trip_id) b"
    return f"SELECT {keys}, {m.count_if('pair_eligible')} AS eligible_pairs, {m.count_if('pair_observed')} AS observed_pairs, count(DISTINCT {d.tup('service_date', 'trip_id')}) FILTER (WHERE pair_observed) AS trips, {qs}, {late} FROM {both} WHERE {where} GROUP BY {keys}"


@stated
def segment_candidates(d: Spark) -> str:
    """Per category the weekday peak's sections in which most departures become late, of those that pass the floor."""
    rows = f"(SELECT *, {m.share('observed_pairs', 'eligible_pairs')} AS coverage FROM ({_segments(d, 'route_id, stop_id, next_stop_id', f"day_type = 'weekday' AND start_s {PEAK}")}) g)"
    order = "became_late DESC, route_id ASC, stop_id ASC, next_stop_id ASC"
    return _by_category(d, f"(SELECT * FROM {rows} h WHERE trips >= {LEAST_TRIPS} AND coverage >= 0.9)", order)


#: The departures looked at closely: route, direction and hour of start.
FOCUS = "day_type = 'weekday' AND ((route_id = 7 AND direction_id = 1) OR (route_id = 11 AND direction_id = 0))"


@stated
def focus_keys(d: Spark) -> str:
    """The focus departures' recurring groups."""
    return f"SELECT * FROM {_safe(d)} s WHERE {FOCUS}"


@stated
def focus_pairs(d: Spark) -> str:
    """The focus departures' sections: pairs, the change of delay, and how many turn late or on time."""
    both = "(SELECT t.*, j.day_type FROM {timing} t JOIN {journeys} j ON t.service_date = j.service_date AND t.trip_id = j.trip_id) b"
    eligible = "status IN ('observed', 'unobserved') AND next_status IN ('observed', 'unobserved')"
    observed = "status = 'observed' AND next_status = 'observed'"
    turns = f"{m.count_if(f'{observed} AND delay_s {ON_TIME} AND next_delay > {m.LATE}')} AS ontime_to_late, {m.count_if(f'{observed} AND delay_s > {m.LATE} AND next_delay {ON_TIME}')} AS late_to_ontime"
    return f"SELECT route_id, stop_id, next_stop_id, {m.count_if(eligible)} AS eligible_pairs, {m.count_if(observed)} AS observed_pairs, {d.quantile('next_delay - delay_s', 0.5, observed)} AS median_change, {turns} FROM {both} WHERE {FOCUS} AND next_stop_id IS NOT NULL GROUP BY route_id, stop_id, next_stop_id"


@stated
def day_profiles(d: Spark) -> str:
    """The focus departures stop by stop on every date."""
    return f"SELECT t.service_date, t.route_id, j.start_s, t.trip_id, t.timing_index, t.stop_id, t.status, t.delay_s FROM {{timing}} t JOIN (SELECT * FROM {{journeys}} WHERE {FOCUS}) j ON t.service_date = j.service_date AND t.trip_id = j.trip_id"


@stated
def same_pattern_times(d: Spark) -> str:
    """One route and direction over the day: its recurring departures that pass the floor, by start."""
    return f"SELECT start_s, observed, observed_trips, observed_dates, late_dates, coverage, punctuality, median_delay FROM {_safe(d)} s WHERE route_id = 7 AND direction_id = 1 AND day_type = 'weekday' AND {FLOOR}"


@stated
def section_start_hours(d: Spark) -> str:
    """One route's sections by the hour in which the journey starts, of weekdays, with the floor."""
    keys = f"route_id, direction_id, {d.idiv('start_s', '3600')}"
    return f"SELECT route_id, direction_id, start_hour, eligible_pairs, observed_pairs, trips, median_change, p90_change, became_late, recovered_below_late FROM (SELECT *, {m.share('observed_pairs', 'eligible_pairs')} AS coverage FROM ({_segments(d, keys, "day_type = 'weekday' AND route_id = 11").replace(f"SELECT {keys}", f"SELECT route_id, direction_id, {d.idiv('start_s', '3600')} AS start_hour", 1)}) g) h WHERE trips >= {LEAST_TRIPS} AND coverage >= 0.9"


# ---------------------------------------------------------------- labels from the latest names


def _names(d: Spark) -> str:
    """Stops and their parents as each year's schedule has them: every third stop changes its name, every fifth its parent."""
    year = "cast(year(service_date) AS int)"
    name = f"CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' ' || {d.text('y')} ELSE s_name END"
    parent = "CASE WHEN s_suppkey % 4 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN s_suppkey - 1 - y % 2 ELSE s_suppkey - s_suppkey % 2 END"
    return f"(SELECT s_suppkey AS stop_id, {name} AS stop_name, {parent} AS parent_station, y FROM (SELECT s_suppkey, s_name, y FROM {{supplier}} CROSS JOIN (SELECT DISTINCT {year} AS y FROM {{day_types}}) t) z)"


def _stations(d: Spark) -> str:
    """Each stop with its station by the latest values; a parent that isn't a stop has no name."""
    latest = f"(SELECT stop_id, {d.latest('stop_name', 'y')} AS stop_name, {d.latest('parent_station', 'y')} AS parent_station FROM {_names(d)} n GROUP BY stop_id)"
    return f"(SELECT a.stop_id, coalesce(a.parent_station, a.stop_id) AS station_id, b.stop_name AS station_name FROM {latest} a LEFT JOIN {latest} b ON coalesce(a.parent_station, a.stop_id) = b.stop_id)"


@stated
def station_names(d: Spark) -> str:
    """Every stop's station and its name, from the most recent schedule that has a value."""
    return f"SELECT stop_id, station_id, station_name FROM {_stations(d)} s"


def _route_labels(d: Spark) -> str:
    """A route's commonest pattern as first and last station; a station without a name leaves the route without a label."""
    pattern = f"SELECT route_id, trip_id, direction_id, {d.list_by('stop_id', 'stop_sequence')} AS pattern_key, {d.earliest('stop_id', 'stop_sequence')} AS first_stop, {d.latest('stop_id', 'stop_sequence')} AS last_stop, min(scheduled_s) AS earliest FROM {{stop_events}} GROUP BY route_id, trip_id, direction_id"
    counted = f"SELECT route_id, pattern_key, min(first_stop) AS first_stop, min(last_stop) AS last_stop, min(direction_id) AS direction_id, count(*) AS n_trips, min(earliest) AS earliest FROM ({pattern}) x GROUP BY route_id, pattern_key"
    top = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY n_trips DESC, earliest ASC, direction_id ASC NULLS LAST, pattern_key ASC) AS rn FROM ({counted}) y) z WHERE rn = 1)"
    # regions stand for short names, so that routes share labels where their stations do
    label = "r.r_name || ' · ' || substr(a.station_name, 1, 10) || ' – ' || substr(b.station_name, 1, 10)"
    return f"SELECT p.route_id, r.r_name AS short_name, {label} AS label FROM {top} p JOIN {{nation}} n ON p.route_id = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey JOIN {_stations(d)} a ON p.first_stop = a.stop_id JOIN {_stations(d)} b ON p.last_stop = b.stop_id"


@stated(
    plainly=lambda d: f"WITH raw AS ({_route_labels(d)}), met AS (SELECT label, count(DISTINCT route_id) AS n FROM raw GROUP BY label HAVING count(DISTINCT route_id) > 1) "
    "SELECT raw.route_id, raw.short_name, CASE WHEN met.n > 1 THEN raw.label || ' (' || raw.route_id || ')' ELSE raw.label END AS route_label FROM raw LEFT JOIN met ON met.label = raw.label"
)
def route_labels(d: Spark) -> str:
    """Routes with their label; labels that several routes bear get the route's id, and a missing one stays missing."""
    return f"SELECT route_id, short_name, CASE WHEN label IS NOT NULL AND count(*) OVER (PARTITION BY label) > 1 THEN concat(label, ' (', route_id, ')') ELSE label END AS route_label FROM ({_route_labels(d)}) raw"
