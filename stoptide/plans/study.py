"""Journey studies: patterns, recurring departures, adjacent pairs and what becomes of delays."""

from __future__ import annotations

from stoptide.functions import measures as m
from stoptide.functions.dialect import Spark
from stoptide.plans.engine import stated
from stoptide.plans.tabs import measured


@stated
def pattern_signature(d: Spark) -> str:
    """The digest of each trip's stops and timing flags in order."""
    return "SELECT trip_id, pattern FROM {journeys}"


@stated
def journeys(d: Spark) -> str:
    """In-scope journeys with start seconds, day type and category."""
    return "SELECT service_date, trip_id, route_id, direction_id, coalesce(category, 'Unmapped') AS category, start_s, day_type FROM {journeys}"


@stated
def timing_sequence(d: Spark) -> str:
    """Timing stops with the next one's attributes, taken before anything is filtered."""
    return "SELECT trip_id, stop_sequence, timing_index, next_stop_id, next_status, next_delay FROM {timing}"


@stated
def adjacent_pairs(d: Spark) -> str:
    """Pairs of adjacent timing stops with the change of delay."""
    return "SELECT trip_id, stop_sequence, next_sequence, delta, pair_eligible, pair_observed FROM {pairs}"


@stated
def pair_inventory(d: Spark) -> str:
    """Scheduled, eligible and observed pairs."""
    return f"SELECT count(*) AS scheduled_pairs, {m.count_if('pair_eligible')} AS eligible_pairs, {m.count_if('pair_observed')} AS observed_pairs, count(DISTINCT {d.tup('service_date', 'trip_id')}) FILTER (WHERE pair_observed) AS trips FROM {{pairs}}"


RECURRING = "route_id, direction_id, start_s, day_type"


def _recurring(d: Spark) -> str:
    if d.name == "spark":
        return _recurring_by_date()
    return f"""
    SELECT {RECURRING}, {m.count_if(m.ELIGIBLE)} AS eligible, {m.count_if(m.OBSERVED)} AS observed, count(DISTINCT {d.tup('service_date', 'trip_id')}) FILTER (WHERE {m.OBSERVED}) AS observed_trips,
        count(DISTINCT service_date) FILTER (WHERE {m.OBSERVED}) AS observed_dates, {m.count_if(m.EVENT_COUNTS['on_time_departures'])} AS on_time,
        count(DISTINCT service_date) FILTER (WHERE {m.OBSERVED} AND delay_s > {m.LATE}) AS late_dates, {d.quantile('delay_s', 0.5, m.OBSERVED)} AS median_delay
    FROM (SELECT t.*, j.start_s, j.day_type FROM {{timing}} t JOIN {{journeys}} j ON t.service_date = j.service_date AND t.trip_id = j.trip_id) x GROUP BY {RECURRING}"""


def _recurring_by_date() -> str:
    """The same from counts by date, status and delay, so that no group's delays are gathered.

    One observed row of a trip stands for it, and the latest observed one of a date for the date.
    """
    first = f"CASE WHEN {m.OBSERVED} THEN 0 ELSE 1 END"
    rows = f"SELECT t.route_id, t.direction_id, j.start_s, j.day_type, t.service_date, status, delay_s, row_number() OVER (PARTITION BY t.service_date, t.trip_id ORDER BY {first}) = 1 AND {m.OBSERVED} AS stands FROM {{timing}} t JOIN {{journeys}} j ON t.service_date = j.service_date AND t.trip_id = j.trip_id"
    hist = f"SELECT {RECURRING}, service_date, status, delay_s, count(*) AS n, count_if(stands) AS n_trips FROM ({rows}) x GROUP BY {RECURRING}, service_date, status, delay_s"
    dates = f"SELECT *, row_number() OVER (PARTITION BY {RECURRING}, service_date ORDER BY {first}, delay_s DESC) = 1 AND {m.OBSERVED} AS is_date FROM ({hist}) h"

    def total(cond: str) -> str:
        return f"sum(CASE WHEN {cond} THEN n ELSE 0 END)"

    return f"""
    SELECT {RECURRING}, {total(m.ELIGIBLE)} AS eligible, {total(m.OBSERVED)} AS observed, sum(n_trips) AS observed_trips, count_if(is_date) AS observed_dates,
        {total(m.EVENT_COUNTS['on_time_departures'])} AS on_time, count_if(is_date AND delay_s > {m.LATE}) AS late_dates, percentile(delay_s, 0.5, n) FILTER (WHERE {m.OBSERVED}) AS median_delay
    FROM ({dates}) d GROUP BY {RECURRING}"""


@stated
def recurring_departures(d: Spark) -> str:
    """Groups of the same departure over dates."""
    return f"SELECT *, {m.share('observed', 'eligible')} AS coverage, {m.share('on_time', 'observed')} AS punctuality FROM ({_recurring(d)}) r"


def _ambiguous() -> str:
    return f"SELECT DISTINCT {RECURRING} FROM (SELECT service_date, {RECURRING}, count(*) AS n FROM {{journeys}} GROUP BY service_date, {RECURRING} HAVING count(*) > 1) a"


def _coarse(keys: str) -> str:
    return f"SELECT {keys}, count(*) AS dates, max(n) AS most FROM (SELECT service_date, {keys}, count(*) AS n FROM {{journeys}} GROUP BY service_date, {keys} HAVING count(*) > 1) a GROUP BY {keys}"


@stated
def ambiguous_keys(d: Spark) -> str:
    """Keys that two journeys share on some date: the study's keys, and coarser ones that do occur."""
    null = "cast(NULL AS bigint)"
    coarse = _coarse("route_id, day_type")
    return f"SELECT 'departure' AS grain, route_id, direction_id, start_s, day_type, {null} AS dates FROM ({_ambiguous()}) x UNION ALL SELECT 'route', route_id, {null}, {null}, day_type, dates FROM ({coarse}) y"


@stated
def safe_recurring(d: Spark) -> str:
    """Recurring departures without ambiguous keys; a null direction never matches one."""
    on = " AND ".join(f"r.{k.strip()} = a.{k.strip()}" for k in RECURRING.split(","))
    return f"SELECT r.* FROM ({_recurring(d)}) r WHERE NOT EXISTS (SELECT 1 FROM ({_ambiguous()}) a WHERE {on})"


@stated
def section_summary(d: Spark) -> str:
    """Per section: pairs, change of delay, and transitions between on time and late."""
    return f"""
    SELECT route_id, stop_id, next_stop_id, count(*) AS scheduled, {m.count_if('pair_eligible')} AS eligible, {m.count_if('pair_observed')} AS observed, {d.quantile('delta', 0.5, 'pair_observed')} AS median_delta,
        {m.count_if(f'pair_observed AND delay_s BETWEEN {m.EARLY} AND {m.LATE} AND next_delay > {m.LATE}')} AS became_late, {m.count_if(f'pair_observed AND delay_s > {m.LATE} AND next_delay BETWEEN {m.EARLY} AND {m.LATE}')} AS recovered
    FROM {{pairs}} GROUP BY route_id, stop_id, next_stop_id"""


@stated
def linked_recovery(d: Spark) -> str:
    """Two consecutive pairs of a trip: what the second gives back of what the first lost."""
    return f"SELECT a.route_id, count(*) AS n, {m.count_if('a.delta > 0 AND b.delta < 0')} AS recovering, {d.quantile('b.delta', 0.5, 'a.delta > 60')} AS median_after_loss FROM {{pairs}} a JOIN {{pairs}} b ON a.trip_id = b.trip_id AND a.next_sequence = b.stop_sequence WHERE a.pair_observed AND b.pair_observed GROUP BY a.route_id"


def _without(d: Spark, part: str) -> str:
    year = f"SELECT *, {part} AS y FROM {{pairs}} WHERE pair_observed"
    return f"SELECT o.y AS omitted, count(*) AS n, {d.quantile('p.delta', 0.5, 'true')} AS median_delta FROM (SELECT DISTINCT y FROM ({year}) a) o JOIN ({year}) p ON o.y <> p.y GROUP BY o.y"


def _without_by_counts(part: str) -> str:
    """Changes are counted by part first; only counts are repeated under the other parts."""
    hist = f"SELECT {part} AS y, delta, count(*) AS n FROM {{pairs}} WHERE pair_observed GROUP BY {part}, delta"
    other = f"SELECT explode(filter(ys, x -> x <> y)) AS omitted, delta, n FROM ({hist}) h CROSS JOIN (SELECT collect_set(y) AS ys FROM (SELECT DISTINCT {part} AS y FROM {{pairs}} WHERE pair_observed) z) s"
    return f"SELECT omitted, sum(n) AS n, percentile(delta, 0.5, n) AS median_delta FROM ({other}) o GROUP BY omitted"


YEAR, DATE_IN_YEAR = "cast(year(service_date) AS int)", "cast(month(service_date) * 100 + day(service_date) AS int)"


@stated(plainly=lambda d: _without(d, YEAR))
def leave_one_out_median(d: Spark) -> str:
    """The median change of delay without each year in turn."""
    return _without_by_counts(YEAR)


@stated(plainly=lambda d: _without(d, DATE_IN_YEAR))
def leave_one_date_out_median(d: Spark) -> str:
    """The median change of delay without each date of the year in turn."""
    return _without_by_counts(DATE_IN_YEAR)


@stated
def topn_per_category(d: Spark) -> str:
    """The fifteen stops per category with the most late departures."""
    return f"""
    SELECT category, stop_id, late, rank_ FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY late DESC, stop_id ASC) AS rank_
        FROM (SELECT coalesce(c.category, 'Unmapped') AS category, e.stop_id, {m.count_if(f"e.status = 'observed' AND e.delay_s > {m.LATE}")} AS late
              FROM {{stop_events}} e LEFT JOIN {{categories}} c ON e.route_id = c.route_id WHERE e.in_scope GROUP BY coalesce(c.category, 'Unmapped'), e.stop_id) x) y WHERE rank_ <= 15"""


@stated
def route_direction_hour_cells(d: Spark) -> str:
    """Cells of route, direction and local hour with the reporting floor."""
    source = f"(SELECT *, {d.local_hour('scheduled_s')} AS hour_local FROM {{stop_events}} WHERE in_scope AND stop_position <> 'final') x"
    keys = "route_id, direction_id, hour_local"
    return m.with_floor(f"SELECT e.route_id, e.direction_id, e.hour_local, {m.event_columns('e')} FROM ({measured(d, keys, source, 'hour_local')}) e")


@stated
def stop_profiles(d: Spark) -> str:
    """Per route and timing index: scheduled, eligible and observed departures and their median delay."""
    return f"SELECT route_id, timing_index, count(*) AS scheduled, {m.count_if(m.ELIGIBLE)} AS eligible, {m.count_if(m.OBSERVED)} AS observed, {d.quantile('delay_s', 0.5, m.OBSERVED)} AS median_delay FROM {{timing}} GROUP BY route_id, timing_index"


@stated
def segment_hours(d: Spark) -> str:
    """Pairs per start hour with their median change."""
    return f"SELECT {d.local_hour('scheduled_s')} AS start_hour, {m.count_if('pair_eligible')} AS eligible_pairs, {m.count_if('pair_observed')} AS observed_pairs, {d.quantile('delta', 0.5, 'pair_observed')} AS median_delta FROM {{pairs}} GROUP BY {d.local_hour('scheduled_s')}"


@stated
def duplicate_keys(d: Spark) -> str:
    """How many recurring keys occur twice on a date."""
    return f"SELECT count(*) AS duplicate_keys FROM (SELECT service_date, {RECURRING}, count(*) AS n FROM {{journeys}} GROUP BY service_date, {RECURRING} HAVING count(*) > 1) x"


@stated
def recurring_inventory(d: Spark) -> str:
    """Recurring groups per day type, and how many pass the floor."""
    return f"SELECT day_type, count(*) AS group_count, {m.count_if('observed_trips >= 2 AND observed >= 0.9 * eligible')} AS reportable FROM ({_recurring(d)}) r GROUP BY day_type"
