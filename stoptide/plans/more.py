"""Further studies of the feed and the journeys; where Spark has its own text, the oracle's is the plain definition."""

from __future__ import annotations

from stoptide.functions import measures as m
from stoptide.functions.dialect import Spark
from stoptide.plans.engine import stated
from stoptide.plans.feed import hms_seconds, hms_text
from stoptide.plans.forensics import _lists, _plain_vanished, _present, _vanished, _visits

# ---------------------------------------------------------------- details, predictions, lifecycle

#: Rows with a start date that some feeds leave out.
KEYED = "(SELECT *, CASE WHEN snapshot_file % 17 = 0 THEN NULL ELSE start_date END AS start_day FROM {feed})"


def _details(d: Spark) -> str:
    same = d.same("r.start_day", "k.start_day")
    return f"""
    SELECT r.trip_id, r.stop_sequence, r.header_s, r.start_day, min(r.held_s) AS held_s, count(*) AS n_rows, count(*) > 1 AS fans_out
    FROM {KEYED} r JOIN (SELECT trip_id, start_day, stop_sequence, max(header_s) AS header_s FROM {KEYED} f GROUP BY trip_id, start_day, stop_sequence) k
        ON r.trip_id = k.trip_id AND {same} AND r.stop_sequence = k.stop_sequence AND r.header_s = k.header_s
    GROUP BY r.trip_id, r.stop_sequence, r.header_s, r.start_day"""


@stated
def detail_lookup(d: Spark) -> str:
    """The details behind events' keys, joined null-safely, and whether a key fans out."""
    return _details(d)


def _predictions(d: Spark, drops: str, last: str) -> str:
    """Predictions against the window in which a stop vanished: seconds from its middle, and where they lie."""
    where = "CASE WHEN p.prediction_s IS NULL THEN NULL WHEN p.prediction_s < e.slot * 21600 THEN 'before' WHEN p.prediction_s > e.next_slot * 21600 THEN 'after' ELSE 'inside' END"
    offset = f"p.prediction_s - {d.double('e.slot * 21600 + e.next_slot * 21600')} / 2"
    rows = f"SELECT e.kind, coalesce(p.source, 'missing_row') AS source, {where} AS position, {offset} AS offset_s FROM ({drops}) e LEFT JOIN ({last}) p ON p.trip_id = e.trip_id AND p.stop_sequence = e.stop_sequence AND p.slot = e.slot"
    qs = ", ".join(f"{d.quantile('offset_s', p, 'offset_s IS NOT NULL')} AS p{int(p * 100)}" for p in (0.05, 0.25, 0.5, 0.75, 0.95))
    return f"SELECT kind, source, position, count(*) AS n, {qs} FROM ({rows}) r GROUP BY kind, source, position"


#: The two fallback chains: name, value, and when it is there; arrivals mirror departures.
CHAIN = (
    ("departure.time", "held_s", "snapshot_file % 5 = 0"),
    ("scheduled_departure+delay", "header_s + value_s", "snapshot_file % 5 = 1"),
    ("arrival.time", "held_s - 30", "snapshot_file % 5 = 2"),
    ("scheduled_arrival+delay", "header_s + value_s - 30", "snapshot_file % 5 = 3"),
)
MIRRORED = (CHAIN[2], CHAIN[3], CHAIN[0], CHAIN[1])


def _first_of(chain: tuple) -> str:
    value = "coalesce(" + ", ".join(f"CASE WHEN {c} THEN {v} END" for _, v, c in chain) + ")"
    return f"{value} AS prediction_s, CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, _, c in chain) + " ELSE 'unavailable' END AS source"


@stated
def prediction_chains(d: Spark) -> str:
    """Rows per source and direction of both fallback chains, four steps each, with their values' sums."""
    both = " UNION ALL ".join(f"SELECT '{k}' AS chain, {_first_of(c)} FROM {{feed}}" for k, c in (("departure", CHAIN), ("arrival", MIRRORED)))
    return f"SELECT chain, source, count(*) AS n, cast(sum(prediction_s) AS bigint) AS total FROM ({both}) x GROUP BY chain, source"


def _last_prediction(d: Spark) -> str:
    slot = d.idiv("header_s", "21600")
    if d.name == "spark":
        return f"SELECT trip_id, stop_sequence, slot, t.* FROM (SELECT trip_id, stop_sequence, {slot} AS slot, max(struct(header_s, snapshot_file, {_first_of(CHAIN)})) AS t FROM {{feed}} GROUP BY trip_id, stop_sequence, {slot}) r"
    return f"SELECT * FROM (SELECT trip_id, stop_sequence, {slot} AS slot, {_first_of(CHAIN)}, row_number() OVER (PARTITION BY trip_id, stop_sequence, {slot} ORDER BY header_s DESC, snapshot_file DESC) AS rn FROM {{feed}}) r WHERE rn = 1"


@stated(plainly=lambda d: _predictions(d, _plain_vanished(d), _last_prediction(d)))
def prediction_vs_drop(d: Spark) -> str:
    """Predictions against the window in which a stop vanished, by kind, source and position."""
    return _predictions(d, _vanished(d), _last_prediction(d))


def _first_stops(d: Spark, first: str) -> str:
    qs = ", ".join(f"{d.quantile('first_seq', p, 'true')} AS seq_p{int(p * 100)}" for p in (0.25, 0.5, 0.75, 0.95))
    os_ = ", ".join(f"{d.quantile('offset_min', p, 'true')} AS offset_p{int(p * 100)}" for p in (0.05, 0.25, 0.5, 0.75, 0.95))
    return f"SELECT count(*) AS trips, {m.count_if('ever_first')} AS ever_first, {qs}, {os_} FROM (SELECT first_seq, ever_first, {d.double('first_s - scheduled_s')} / 60 AS offset_min FROM ({first}) t WHERE first_s > (SELECT min(header_s) FROM {{snapshots}})) x"


@stated(
    plainly=lambda d: _first_stops(
        d,
        "SELECT l.trip_id, l.first_s, min(f.stop_sequence) FILTER (WHERE f.header_s = l.first_s) AS first_seq, bool_or(f.stop_sequence = 1) AS ever_first, min(f.header_s - f.value_s) AS scheduled_s FROM {feed} f JOIN (SELECT trip_id, min(header_s) AS first_s FROM {feed} GROUP BY trip_id) l ON f.trip_id = l.trip_id GROUP BY l.trip_id, l.first_s",
    )
)
def first_stop_behaviour(d: Spark) -> str:
    """Of trips that begin within the feed: the first list's smallest stop, whether the first stop is ever shown, and the start against the schedule."""
    return _first_stops(d, "SELECT trip_id, min(struct(header_s, stop_sequence)).header_s AS first_s, min(struct(header_s, stop_sequence)).stop_sequence AS first_seq, bool_or(stop_sequence = 1) AS ever_first, min(header_s - value_s) AS scheduled_s FROM {feed} GROUP BY trip_id")


#: Route types, one per trip; the suite is repeated for each only because there are several.
ROUTE_TYPE = "CASE WHEN trip_id % 3 = 0 THEN 'ferry' ELSE 'bus' END"


def _leaving(d: Spark) -> str:
    if d.name == "spark":
        return f"SELECT trip_id, CASE WHEN size(l.ss) = 1 AND get(l.ss, 0) = 5 THEN 'final_only' WHEN size(l.ss) >= 2 THEN 'two_plus' ELSE 'other' END AS leave_kind FROM (SELECT trip_id, max(struct(slot, ss)) AS l FROM ({_lists(d)}) t GROUP BY trip_id) x"
    return f"SELECT trip_id, CASE WHEN count(*) = 1 AND min(stop_sequence) = 5 THEN 'final_only' WHEN count(*) >= 2 THEN 'two_plus' ELSE 'other' END AS leave_kind FROM (SELECT p.trip_id, p.stop_sequence FROM {_present(d)} JOIN (SELECT trip_id, max(slot) AS slot FROM {_present(d)} GROUP BY trip_id) l ON p.trip_id = l.trip_id AND p.slot = l.slot) x GROUP BY trip_id"


def _suite(d: Spark, drops: str) -> str:
    return f"""
    SELECT {ROUTE_TYPE} AS route_type, 'leave: ' || leave_kind AS figure, count(*) AS n FROM ({_leaving(d)}) l GROUP BY {ROUTE_TYPE}, leave_kind
    UNION ALL SELECT {ROUTE_TYPE}, 'drop: ' || kind, count(*) FROM ({drops}) e GROUP BY {ROUTE_TYPE}, kind
    UNION ALL SELECT route_type, 'stops that vanished again', count(*) FROM (SELECT {ROUTE_TYPE} AS route_type, trip_id, stop_sequence FROM ({drops}) e GROUP BY {ROUTE_TYPE}, trip_id, stop_sequence HAVING count(*) > 1) r GROUP BY route_type"""


@stated(plainly=lambda d: _suite(d, _plain_vanished(d)))
def lifecycle_by_type(d: Spark) -> str:
    """How trips leave, how stops vanish, and how many vanish again, for each route type."""
    return _suite(d, _vanished(d))


@stated
def reappearance_transitions(d: Spark) -> str:
    """Stops that come back: after which list, after how long, per list."""
    seen = f"(SELECT trip_id, stop_sequence, slot, lag(slot) OVER (PARTITION BY trip_id, stop_sequence ORDER BY slot) AS before_slot FROM {_present(d)})"
    lists = f"(SELECT trip_id, slot, row_number() OVER (PARTITION BY trip_id ORDER BY slot) AS i FROM (SELECT DISTINCT trip_id, slot FROM {_present(d)}) z)"
    return f"SELECT s.slot, count(*) AS n, count(DISTINCT s.trip_id) AS trips, max(s.slot - s.before_slot) AS longest FROM {seen} s JOIN {lists} a ON s.trip_id = a.trip_id AND s.slot = a.slot JOIN {lists} b ON s.trip_id = b.trip_id AND s.before_slot = b.slot WHERE a.i - b.i > 1 GROUP BY s.slot"


@stated
def reappeared_values(d: Spark) -> str:
    """Held values before and after an absence of more than a day: whether they agree, and the marker's change."""
    by = "OVER (PARTITION BY trip_id, stop_sequence ORDER BY header_s, snapshot_file)"
    rows = f"SELECT header_s, held_s, uncertainty_present, lag(header_s) {by} AS before_at, lag(held_s) {by} AS before_held, lag(uncertainty_present) {by} AS before_mark FROM {{feed}}"
    return f"SELECT before_mark, uncertainty_present AS mark, count(*) AS n, {m.count_if('held_s = before_held')} AS same_value, {m.count_if('held_s > before_held')} AS later FROM ({rows}) r WHERE header_s - before_at > 86400 GROUP BY before_mark, uncertainty_present"


@stated
def leave_and_return(d: Spark) -> str:
    """Stops that skip snapshots of the global order, and by how many."""
    jump = "i - lag(i) OVER (PARTITION BY trip_id, stop_sequence ORDER BY i)"
    return f"SELECT CASE WHEN jump < 1000 THEN 'under 1000' WHEN jump < 3000 THEN 'under 3000' ELSE 'more' END AS size_, count(*) AS n, count(DISTINCT trip_id) AS trips, max(jump) AS widest FROM (SELECT trip_id, {jump} AS jump FROM (SELECT DISTINCT f.trip_id, f.stop_sequence, s.i FROM {{feed}} f JOIN {{steps}} s ON f.header_s = s.header_s) r) j WHERE jump > 1 GROUP BY CASE WHEN jump < 1000 THEN 'under 1000' WHEN jump < 3000 THEN 'under 3000' ELSE 'more' END"


@stated
def rows_by_hour(d: Spark) -> str:
    """Rows, trips and rows of another start date per local hour."""
    hour = d.local_hour("header_s")
    return f"SELECT {hour} AS hour_local, count(*) AS n, count(DISTINCT trip_id) AS trips, {m.count_if(f'start_date <> {d.local_date("header_s")}')} AS other_date FROM {{feed}} GROUP BY {hour}"


def _identity(d: Spark, percentiles: str) -> str:
    gap = "held_s - (header_s + value_s - 200 + CASE WHEN snapshot_file % 23 = 0 THEN 30 WHEN snapshot_file % 29 = 0 THEN -90 ELSE 0 END)"
    return f"SELECT count(*) AS n, {m.count_if('gap = 0')} AS exact, {m.count_if('abs(gap) <= 60')} AS within_60, {percentiles} FROM (SELECT {gap} AS gap FROM {{feed}}) g"


IDENTITY_AT = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


@stated(plainly=lambda d: _identity(d, ", ".join(f"quantile_cont(gap, {p}) AS p{int(100 * p)}" for p in IDENTITY_AT)))
def time_delay_identity(d: Spark) -> str:
    """Whether a time is its schedule and delay: exact, within a minute, and all quantiles from one array."""
    ps = f"percentile(gap, array({', '.join(map(str, IDENTITY_AT))}))"
    return f"SELECT n, exact, within_60, {', '.join(f'ps[{i}] AS p{int(100 * p)}' for i, p in enumerate(IDENTITY_AT))} FROM ({_identity(d, ps + ' AS ps')}) x"


@stated
def republished_lists(d: Spark) -> str:
    """The share of stop lists that an earlier list of the trip had already shown, and how far back it was."""
    sig = f"(SELECT trip_id, slot, {d.list_by('stop_sequence', 'stop_sequence')} AS signature, row_number() OVER (PARTITION BY trip_id ORDER BY slot) AS i FROM {_present(d)} GROUP BY trip_id, slot) g"
    back = f"(SELECT i - lag(i) OVER (PARTITION BY trip_id, signature ORDER BY slot) AS back FROM {sig}) b"
    return f"SELECT count(*) AS lists, {m.count_if('back IS NOT NULL')} AS stale, {m.share(m.count_if('back IS NOT NULL'), 'count(*)')} AS stale_share, {d.quantile('back', 0.5, 'back IS NOT NULL')} AS back_p50, max(back) AS back_max FROM {back}"


# ---------------------------------------------------------------- vehicles


@stated
def padded_trip_windows(d: Spark) -> str:
    """Pings from 30 minutes before to 90 after each trip's span, the time between them, and what falls outside."""
    spans = "(SELECT trip_id, min(header_s) - 1800 AS lo, max(header_s) + 5400 AS hi FROM {feed} GROUP BY trip_id) w"
    pings = "(SELECT trip_id, header_s, header_s - lag(header_s) OVER (PARTITION BY vehicle_id, trip_id ORDER BY header_s) AS step_s FROM (SELECT DISTINCT vehicle_id, trip_id, header_s FROM {pings} WHERE trip_id IS NOT NULL) q) p"
    inside = "p.header_s BETWEEN w.lo AND w.hi"
    return f"SELECT p.trip_id, count(*) AS pings, {m.count_if(inside)} AS in_window, {m.count_if(f'NOT ({inside})')} AS outside, {d.quantile('p.step_s', 0.5, 'p.step_s IS NOT NULL')} AS step_p50, {m.count_if('p.step_s > 600')} AS long_steps FROM {pings} JOIN {spans} ON p.trip_id = w.trip_id GROUP BY p.trip_id"


@stated
def vehicle_fields(d: Spark) -> str:
    """Pings per local hour: how many name a trip, a vehicle's share, and distinct vehicles and trips."""
    hour = d.local_hour("header_s")
    return f"SELECT {hour} AS hour_local, count(*) AS pings, count(trip_id) AS with_trip, {m.share('count(trip_id)', 'count(*)')} AS trip_share, count(DISTINCT vehicle_id) AS vehicles, count(DISTINCT trip_id) AS trips FROM {{pings}} GROUP BY {hour}"


@stated
def pings_per_trip(d: Spark) -> str:
    """How many pings trips have: quantiles over trips, and trips with more than one vehicle."""
    qs = ", ".join(f"{d.quantile('n', p, 'true')} AS p{int(100 * p)}" for p in (0.05, 0.5, 0.95))
    return f"SELECT count(*) AS trips, {qs}, {m.count_if('vehicles > 1')} AS shared FROM (SELECT trip_id, count(*) AS n, count(DISTINCT vehicle_id) AS vehicles FROM {{pings}} WHERE trip_id IS NOT NULL GROUP BY trip_id) t"


@stated
def dropout_shares_by_trip(d: Spark) -> str:
    """Per trip the pings inside its span that name no trip although their vehicle drives it."""
    spans = "(SELECT trip_id, vehicle_id, min(header_s) AS lo, max(header_s) AS hi, count(*) AS linked FROM {pings} WHERE trip_id IS NOT NULL GROUP BY trip_id, vehicle_id) s"
    return f"SELECT s.trip_id, cast(sum(s.linked) AS bigint) AS linked, cast(sum(coalesce(x.n, 0)) AS bigint) AS dropout FROM {spans} LEFT JOIN (SELECT s.trip_id, s.vehicle_id, count(*) AS n FROM {{pings}} p JOIN {spans} ON p.vehicle_id = s.vehicle_id AND p.header_s BETWEEN s.lo AND s.hi WHERE p.trip_id IS NULL GROUP BY s.trip_id, s.vehicle_id) x ON s.trip_id = x.trip_id AND s.vehicle_id = x.vehicle_id GROUP BY s.trip_id"


@stated
def offsets_by_position(d: Spark) -> str:
    """Visits' middle against the schedule, by kind of stop."""
    kind = "CASE WHEN stop IN ('click') THEN 'first' WHEN stop IN ('view') THEN 'final' ELSE 'intermediate' END"
    qs = ", ".join(f"{d.quantile('offset_s', p, 'true')} AS p{int(100 * p)}" for p in (0.05, 0.5, 0.95))
    return f"SELECT {kind} AS position, count(*) AS n, {qs} FROM (SELECT stop, {d.double('start_s + end_s')} / 2 - {d.double('start_s - start_s % 3600')} AS offset_s FROM ({_visits(d)}) v) o GROUP BY {kind}"


@stated
def class_shares(d: Spark) -> str:
    """On-time shares by held value and by a second estimate, up to 60, 180 and 300 seconds late, and how often the classes agree."""
    other = "delay_s + l_partkey % 41 - 20"
    shares = ", ".join(f"{m.share(m.count_if(f'{e} BETWEEN {m.EARLY} AND {t}'), 'count(*)')} AS {n}_{t}" for n, e in (("held", "delay_s"), ("other", other)) for t in (m.STRICT, m.LATE, m.WIDE))
    return f"SELECT stop_position, count(*) AS n, {shares}, {m.share(m.count_if(f'{m.delay_class("delay_s")} = {m.delay_class(other)}'), 'count(*)')} AS agreement FROM {{stop_events}} WHERE {m.OBSERVED} GROUP BY stop_position"


# ---------------------------------------------------------------- schedule, selections, functions


@stated(plainly=lambda d: "SELECT trip_id, service_date, route_id NOT IN (SELECT route_id FROM {categories}) OR direction_id IS NULL AS unlisted FROM {trips}")
def not_in_projection(d: Spark) -> str:
    """A null-aware NOT IN under OR in a projection, as a left join with what the list holds; an empty list holds for all."""
    known = "(SELECT DISTINCT route_id AS known FROM {categories} WHERE route_id IS NOT NULL) c"
    facts = "(SELECT count(*) AS n, count_if(route_id IS NULL) AS nulls FROM {categories}) f"
    absent = "CASE WHEN f.n = 0 THEN true WHEN c.known IS NOT NULL THEN false WHEN t.route_id IS NULL OR f.nulls > 0 THEN NULL ELSE true END"
    return f"SELECT t.trip_id, t.service_date, {absent} OR t.direction_id IS NULL AS unlisted FROM {{trips}} t LEFT JOIN {known} ON t.route_id = c.known CROSS JOIN {facts}"


FOCUS = ((3, 0), (7, 1), (11, 0), (19, 1))


@stated(plainly=lambda d: "SELECT trip_id, route_id, direction_id, start_s FROM {journeys} WHERE " + " OR ".join(f"(route_id = {r} AND direction_id = {x})" for r, x in FOCUS))
def focus_set(d: Spark) -> str:
    """Journeys of several keys, by a semi-join with the keys."""
    keys = ", ".join(f"({r}, {x})" for r, x in FOCUS)
    return f"SELECT j.trip_id, j.route_id, j.direction_id, j.start_s FROM {{journeys}} j LEFT SEMI JOIN (VALUES {keys} AS k(r, x)) ON j.route_id = r AND j.direction_id = x"


@stated(plainly=lambda d: "SELECT trip_id, string_agg(stop_sequence || '@' || held_s, ' ' ORDER BY stop_sequence, held_s) FILTER (WHERE uncertainty_present) AS marked, count(*) AS n FROM {feed} GROUP BY trip_id")
def marked_rows(d: Spark) -> str:
    """Each trip's marked rows as a filtered list of structs."""
    rows = "array_sort(collect_list(struct(stop_sequence, held_s)) FILTER (WHERE uncertainty_present))"
    return f"SELECT trip_id, CASE WHEN size(rs) > 0 THEN array_join(transform(rs, r -> concat(r.stop_sequence, '@', r.held_s)), ' ') END AS marked, n FROM (SELECT trip_id, {rows} AS rs, count(*) AS n FROM {{feed}} GROUP BY trip_id) x"


@stated
def group_by_all(d: Spark) -> str:
    """Departures by everything that isn't summed."""
    return f"SELECT route_id, stop_position, status, count(*) AS n, {m.count_if('is_timing_stop')} AS timing FROM {{stop_events}} GROUP BY ALL"


def _plain_wall(d: Spark) -> str:
    """An hour that the clock skips or shows twice is told by the offset before it: an hour earlier, and an hour on."""
    local = "cast(day AS timestamp) + INTERVAL (secs) SECOND"
    epoch = "cast(epoch(timezone('Europe/Stockholm', {})) AS bigint)"
    wall = f"CASE WHEN secs // 3600 % 24 = 2 THEN {epoch.format(local + ' - INTERVAL 1 HOUR')} + 3600 ELSE {epoch.format(local)} END"
    return f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {wall} AS wall_s FROM (SELECT *, cast(l_shipdate AS date) AS day, {hms_seconds(d, 'hms')} AS secs FROM (SELECT *, {hms_text(d)} AS hms FROM {{lineitem}}) y) x"


@stated(plainly=_plain_wall)
def wall_clock_time(d: Spark) -> str:
    """Schedule texts as wall-clock times of their day, not counted from noon: they differ on days that change the clock.

    Of an hour that such a day repeats the first is meant; a time in the skipped hour is as long after the hour before it.
    """
    return f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, unix_seconds(to_utc_timestamp(timestamp_seconds(unix_date(day) * 86400L + secs), 'Europe/Stockholm')) AS wall_s FROM (SELECT *, cast(l_shipdate AS date) AS day, {hms_seconds(d, 'hms')} AS secs FROM (SELECT *, {hms_text(d)} AS hms FROM {{lineitem}}) y) x"


@stated(plainly=lambda d: "SELECT event_id, strftime(ts, '%Y-%m') AS month, lower(strftime(ts, '%A')) AS day_name, cast(ts + INTERVAL 90 MINUTE AS timestamp) AS later, TRY_CAST(event_type AS integer) AS no_number, TRY_CAST(cast(event_id AS varchar) AS integer) AS number FROM {events}")
def time_and_text_functions(d: Spark) -> str:
    """Month, lower-cased day name, an interval added, and casts that give null for what they can't read."""
    return "SELECT event_id, date_format(ts, 'yyyy-MM') AS month, lower(date_format(ts, 'EEEE')) AS day_name, cast(ts + INTERVAL 90 MINUTES AS timestamp_ntz) AS later, try_cast(event_type AS int) AS no_number, try_cast(cast(event_id AS string) AS int) AS number FROM {events}"


@stated(
    plainly=lambda d: f"SELECT d.service_date, d.stop_sequence, h.hour_local FROM (SELECT DISTINCT {d.local_date('header_s')} AS service_date, stop_sequence FROM {{feed}}) d CROSS JOIN (SELECT unnest(range(24)) AS hour_local) h "
    f"EXCEPT SELECT {d.local_date('header_s')}, stop_sequence, {d.local_hour('header_s')} FROM {{feed}}"
)
def missing_hours(d: Spark) -> str:
    """The local hours of each date and stop without a row, listed."""
    day = d.local_date("header_s")
    rows = f"(SELECT {day} AS service_date, stop_sequence, collect_set({d.local_hour('header_s')}) AS hs FROM {{feed}} GROUP BY {day}, stop_sequence) x"
    return f"SELECT service_date, stop_sequence, cast(hour_ AS bigint) AS hour_local FROM (SELECT service_date, stop_sequence, explode(array_except(sequence(0, 23), hs)) AS hour_ FROM {rows}) y"


@stated(plainly=lambda d: "SELECT trip_id FROM (SELECT DISTINCT trip_id FROM {feed} WHERE start_date = (SELECT max(start_date) FROM {feed})) a WHERE trip_id NOT IN (SELECT trip_id FROM {feed} WHERE start_date = (SELECT min(start_date) FROM {feed}) AND trip_id IS NOT NULL)")
def trips_new_since(d: Spark) -> str:
    """Trips of the last date that the first date didn't have."""
    return "SELECT a.trip_id FROM (SELECT DISTINCT trip_id FROM {feed} WHERE start_date = (SELECT max(start_date) FROM {feed})) a LEFT ANTI JOIN (SELECT DISTINCT trip_id FROM {feed} WHERE start_date = (SELECT min(start_date) FROM {feed})) b ON a.trip_id = b.trip_id"


@stated
def route_stop_projection(d: Spark) -> str:
    """Stops and their parent; an empty parent text is none."""
    return f"SELECT s_suppkey AS stop_id, s_name AS stop_name, nullif(CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'N' || {d.text('s_nationkey')} END, '') AS parent_station FROM {{supplier}}"


@stated(plainly=lambda d: "SELECT p_partkey AS route_id, p_name || CASE WHEN (SELECT count(DISTINCT q.p_partkey) FROM {part} q WHERE q.p_name = p.p_name) > 1 THEN ' (' || p_partkey || ')' ELSE '' END AS label FROM {part} p")
def label_suffixes(d: Spark) -> str:
    """Labels that several ids bear get their id as a suffix."""
    return "SELECT p_partkey AS route_id, CASE WHEN count(*) OVER (PARTITION BY p_name) > 1 THEN concat(p_name, ' (', p_partkey, ')') ELSE p_name END AS label FROM {part}"


# ---------------------------------------------------------------- sections


def _section(d: Spark, key: str, name: str, where: str = "true") -> str:
    eligible, observed = m.count_if("pair_eligible"), m.count_if("pair_observed")
    return f"SELECT {key} AS {name}, count(*) AS scheduled, {eligible} AS eligible, {observed} AS observed, {d.quantile('delta', 0.5, 'pair_observed')} AS median_delta FROM {{pairs}} WHERE {where} GROUP BY {key}"


@stated
def section_hourly(d: Spark) -> str:
    """Adjacent pairs of one direction per local hour."""
    return _section(d, d.local_hour("scheduled_s"), "hour_local", "direction_id = 1")


@stated
def section_daily(d: Spark) -> str:
    """Adjacent pairs of weekdays per date."""
    return _section(d, "service_date", "service_date", f"{d.weekday('service_date')} < 5")


@stated
def section_afternoon(d: Spark) -> str:
    """Adjacent pairs of the afternoon, 15 to 18 local, per section's first stop."""
    return _section(d, "stop_id", "stop_id", f"{d.local_hour('scheduled_s')} BETWEEN 15 AND 17")


@stated
def selected_departures(d: Spark) -> str:
    """Journeys that start in one hour of a route, with their pairs' changes of delay."""
    return "SELECT p.trip_id, p.stop_sequence, p.next_sequence, p.delay_s, p.next_delay, p.delta, j.start_s FROM {pairs} p JOIN {journeys} j ON p.service_date = j.service_date AND p.trip_id = j.trip_id WHERE j.route_id = 7 AND j.start_s BETWEEN 21600 AND 25199 AND p.pair_observed"
