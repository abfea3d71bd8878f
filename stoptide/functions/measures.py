"""The shared measure blocks: one definition for every published table."""

from __future__ import annotations

from stoptide.functions.dialect import Spark

#: The punctuality window and its sensitivity variants, in seconds; the reporting floor.
EARLY, LATE, STRICT, WIDE = -60, 180, 60, 300
FLOOR_TRIPS, FLOOR_COVERAGE = 20, 0.9
OBSERVED, ELIGIBLE = "status = 'observed'", "status IN ('observed', 'unobserved')"


def count_if(cond: str) -> str:
    """A filtered count; a null condition doesn't count."""
    return f"count(*) FILTER (WHERE {cond})"


def share(a: str, b: str) -> str:
    """a / b to four places, null when b is null or zero."""
    return f"round(cast({a} AS double) / nullif({b}, 0), 4)"


#: The trip block's counts: name and condition over trips of any scope.
TRIP_COUNTS = {
    "scheduled_trips": "true",
    "in_scope_trips": "in_scope",
    "out_of_scope_trips": "NOT in_scope",
    "cancelled_trips": "trip_status = 'cancelled'",
    "trips_no_realtime_data": "trip_status = 'no_realtime_data'",
    "trips_no_realtime_data_in_outage": "no_data_in_outage",
}
#: The measure block's counts: name and condition over in-scope stop events that aren't final.
EVENT_COUNTS = {
    "eligible_departures": ELIGIBLE,
    "observed_departures": OBSERVED,
    "unobserved_departures": "status = 'unobserved'",
    "skipped_departures": "status = 'skipped'",
    "dst_ambiguous_departures": "status = 'dst_ambiguous'",
    "early_departures": f"{OBSERVED} AND delay_s < {EARLY}",
    "on_time_departures": f"{OBSERVED} AND delay_s BETWEEN {EARLY} AND {LATE}",
    "late_departures": f"{OBSERVED} AND delay_s > {LATE}",
    "on_time_60_departures": f"{OBSERVED} AND delay_s BETWEEN {EARLY} AND {STRICT}",
    "on_time_300_departures": f"{OBSERVED} AND delay_s BETWEEN {EARLY} AND {WIDE}",
}


def trip_aggregates() -> str:
    return ", ".join(f"{count_if(c)} AS {n}" for n, c in TRIP_COUNTS.items())


def trip_columns(t: str) -> str:
    """The trip block with its shares, from an aggregated relation."""
    names = ", ".join(f"coalesce({t}.{n}, 0) AS {n}" for n in TRIP_COUNTS)
    return f"{names}, {share(f'{t}.cancelled_trips', f'{t}.in_scope_trips')} AS cancellation_share, {share(f'{t}.trips_no_realtime_data', f'{t}.in_scope_trips')} AS no_realtime_data_share"


def event_aggregates(d: Spark) -> str:
    counts = ", ".join(f"{count_if(c)} AS {n}" for n, c in EVENT_COUNTS.items())
    trips = f"count(DISTINCT {d.tup('service_date', 'trip_id')}) FILTER (WHERE {OBSERVED}) AS observed_trips"
    return f"{counts}, {trips}, {d.quantile('delay_s', 0.5, OBSERVED)} AS median_delay_s, {d.quantile('delay_s', 0.9, OBSERVED)} AS p90_delay_s"


def stands(within: str = "") -> str:
    """Whether a stop event stands for its trip, and for the part of it by ``within``: an observed one if there is any, of
    a timing stop before others, so that it counts under just those stop sets in which the trip was observed."""
    part = "service_date, trip_id" + (within and f", {within}")
    return f"row_number() OVER (PARTITION BY {part} ORDER BY CASE WHEN {OBSERVED} THEN 0 ELSE 1 END, CASE WHEN is_timing_stop THEN 0 ELSE 1 END) = 1 AND {OBSERVED}"


def event_columns(m: str) -> str:
    """The measure block with its shares; a missing block is zeros."""
    names = [*EVENT_COUNTS, "observed_trips"]
    counts = ", ".join(f"coalesce({m}.{n}, 0) AS {n}" for n in names)
    shares = ", ".join(f"{share(f'{m}.{n}_departures', f'{m}.observed_departures')} AS {n}_share" for n in ("early", "on_time", "late", "on_time_60", "on_time_300"))
    skipped = share(f"{m}.skipped_departures", f"{m}.eligible_departures + {m}.skipped_departures")
    return f"{counts}, {share(f'{m}.observed_departures', f'{m}.eligible_departures')} AS coverage_share, {skipped} AS skipped_share, {shares}, {m}.median_delay_s, {m}.p90_delay_s"


def with_floor(rows: str) -> str:
    """Adds why a row may not be reported, and whether it may; a null coverage has no eligible departures."""
    few, thin = f"observed_trips < {FLOOR_TRIPS}", f"coverage_share < {FLOOR_COVERAGE}"
    return (
        f"SELECT *, CASE WHEN eligible_departures = 0 THEN 'no_eligible_departures' WHEN {few} AND {thin} THEN 'observed_trips<20;coverage<90%' "
        f"WHEN {few} THEN 'observed_trips<20' WHEN {thin} THEN 'coverage<90%' ELSE '' END AS not_reportable_reason, "
        f"NOT (eligible_departures = 0 OR {few} OR coalesce({thin}, false)) AS reportable FROM ({rows}) rows_"
    )


def delay_class(x: str) -> str:
    """early, on_time or late; null without a delay."""
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < {EARLY} THEN 'early' WHEN {x} <= {LATE} THEN 'on_time' ELSE 'late' END"
