"""The published tables and what they are made of."""

from __future__ import annotations

from stoptide.functions import measures as m
from stoptide.functions.dialect import Spark
from stoptide.plans.engine import stated
from stoptide.sources.analogs import GAP_S, month_day


def _events_by(d: Spark, keys: str, source: str) -> str:
    return f"SELECT {keys}, {m.event_aggregates(d)} FROM {source} GROUP BY {keys}"


def measured(d: Spark, keys: str, rows: str, within: str = "") -> str:
    """The measure block by keys; ``within`` names those keys that change inside a trip."""
    return _events_by(d, keys, rows) if d.name == "duck" else _summed(keys, f"({_histogram(rows, keys, within)}) h")


def departures_of(d: Spark) -> str:
    """Departures that tables measure: in scope and not final; Spark's tell which of them stand for their trip."""
    return "(SELECT * FROM {departures}) v" if d.name == "spark" else "(SELECT * FROM {stop_events} WHERE stop_position <> 'final' AND in_scope) v"


def _plain_measures(d: Spark, key: str, rows: str, more: str = "") -> str:
    """The definition: rows by overlapping stop sets and day types, then grouped."""
    pair = d.explode_if("is_timing_stop", "'all_stops'", "'timing_stops'")
    keys = f"month, day_type, stop_set{key and ', ' + key}"
    return f"SELECT {keys}, {more and more + ', '}{m.event_aggregates(d)} FROM (SELECT e.month, e.day_type, s.* FROM (SELECT *, {pair} AS stop_set FROM {rows}) s JOIN {{day_expanded}} e ON s.service_date = e.service_date) x GROUP BY {keys}"


def _own_month(d: Spark, source: str) -> str:
    return f"(SELECT *, {d.month('service_date')} AS month, {d.day_type('service_date')} AS own_type FROM {source}) o"


def _both_sets(rows: str) -> str:
    """Rows of sums under both stop sets that they belong to."""
    sets = "explode(CASE WHEN is_timing_stop THEN array('all_stops', 'timing_stops') ELSE array('all_stops') END) AS stop_set"
    return f"(SELECT *, {sets} FROM ({rows}) a) b"


def _expanded(rows: str) -> str:
    """Rows of sums under both stop sets and both day types that they belong to."""
    return f"(SELECT *, explode(array('all', own_type)) AS day_type FROM {_both_sets(rows)}) c"


#: Keys by which departures already tell what stands for a trip, or for the part of it under a key.
MARKED = {"": "stands", "route_id": "stands_route", "hour_local": "stands_hour", "station_id": "stands_station"}


def _histogram(rows: str, keys: str, within: str = "", marked: bool = False) -> str:
    """Rows counted by keys, timing flag, status and delay, and how many trips' standing rows are among them.

    One row stands for each trip, and for each part of it by ``within`` (``m.stands``); ``marked`` rows tell it
    by themselves. Stop events are made by trip, hence the window over trips needs no shuffle of its own.
    """
    delay = f"CASE WHEN {m.OBSERVED} THEN delay_s END"
    told = MARKED.get(within) if marked else None
    source, stands = (f"{rows}", told) if told else (f"(SELECT *, {m.stands(within)} AS stands_here FROM {rows}) r", "stands_here")
    return f"SELECT {keys}, is_timing_stop, status, {delay} AS delay_s, count(*) AS n, {m.count_if(stands)} AS n_trips FROM {source} GROUP BY {keys}, is_timing_stop, status, {delay}"


def _summed(keys: str, hist: str, more: str = "") -> str:
    """The measure block by keys from a histogram, whose counts are the quantiles' frequencies; ``more`` is a further aggregate with its name."""
    counts = ", ".join(f"sum(CASE WHEN {c} THEN n ELSE 0 END) AS {x}" for x, c in m.EVENT_COUNTS.items())
    name = more and f", {more.rsplit(' ', 1)[1]}"
    return f"""
        SELECT {keys}{name}, {', '.join(m.EVENT_COUNTS)}, observed_trips, at_[0] AS median_delay_s, at_[1] AS p90_delay_s
        FROM (SELECT {keys}{more and f', {more}'}, {counts}, sum(n_trips) AS observed_trips, percentile(delay_s, array(0.5, 0.9), n) FILTER (WHERE {m.OBSERVED}) AS at_ FROM {hist} GROUP BY {keys}) f"""


def _measures(d: Spark, key: str, rows: str, carried: str = "", more: str = "") -> str:
    """Measures by month, day type, stop set and a further key, from counts: rows are read once.

    Rows are counted under their own date's type and only counts are expanded. A trip belongs to one
    date, so distinct trips add up.
    """
    if d.name == "duck":
        return _plain_measures(d, key, rows, more)
    key_, carried = key and f", {key}", carried and f", {carried}"
    hist = _histogram(_own_month(d, rows), f"month, own_type{key_}{carried}", key, marked=True)
    return _summed(f"month, day_type, stop_set{key_}", _expanded(hist), more)


def _trip_counts(d: Spark, key: str = "", source: str = "{trips}") -> str:
    """The trip block and the dates behind it by month, day type and a further key; trips are counted by date first."""
    key = key and f", {key}"
    keys = f"month, day_type{key}"
    if d.name == "duck":
        days = f"(SELECT e.month, e.day_type, t.* FROM {source} t JOIN {{day_expanded}} e ON t.service_date = e.service_date) x"
        return f"SELECT {keys}, count(DISTINCT service_date) AS service_dates, {m.trip_aggregates()} FROM {days} GROUP BY {keys}"
    dates = f"SELECT service_date{key}, {m.trip_aggregates()} FROM {source} t GROUP BY service_date{key}"
    sums = ", ".join(f"sum({n}) AS {n}" for n in m.TRIP_COUNTS)
    return f"SELECT {keys}, count(*) AS service_dates, {sums} FROM (SELECT *, explode(array('all', own_type)) AS day_type FROM {_own_month(d, f'({dates})')}) x GROUP BY {keys}"


@stated
def network_monthly(d: Spark) -> str:
    """One row per month, day type and stop set: trips, punctuality, coverage and the reporting floor."""
    return m.with_floor(f"""
        SELECT k.month, k.day_type, k.stop_set, k.service_dates, c.month_complete, {m.trip_columns('k')}, {m.event_columns('e')}
        FROM (SELECT *, {d.explode("'all_stops'", "'timing_stops'")} AS stop_set FROM ({_trip_counts(d)}) x) k
        LEFT JOIN ({_measures(d, '', departures_of(d))}) e ON k.month = e.month AND k.day_type = e.day_type AND k.stop_set = e.stop_set
        JOIN {{complete}} c ON k.month = c.month""")


@stated
def route_monthly(d: Spark) -> str:
    """As network_monthly per route; routes wholly out of scope keep a row of zeros; category and town last."""
    return m.with_floor(f"""
        SELECT k.month, k.day_type, k.stop_set, k.route_id, n.n_name AS route_name, k.service_dates, c.month_complete, {m.share('k.in_scope_trips', 'k.scheduled_trips')} AS in_scope_share,
            {m.trip_columns('k')}, {m.event_columns('e')}, coalesce(g.category, 'Unmapped') AS route_category, g.town
        FROM (SELECT *, {d.explode("'all_stops'", "'timing_stops'")} AS stop_set
              FROM ({_trip_counts(d, 'route_id')}) y) k
        JOIN {{nation}} n ON k.route_id = n.n_nationkey JOIN {{complete}} c ON k.month = c.month
        LEFT JOIN ({_measures(d, 'route_id', departures_of(d))}) e
            ON k.month = e.month AND k.day_type = e.day_type AND k.stop_set = e.stop_set AND k.route_id = e.route_id
        LEFT JOIN {{categories}} g ON k.route_id = g.route_id""")


def _daily(d: Spark, events: str) -> str:
    return m.with_floor(f"""
        SELECT k.service_date, k.stop_set, k.route_id, k.day_type, {m.trip_columns('k')}, {m.event_columns('e')}
        FROM (SELECT *, {d.explode("'all_stops'", "'timing_stops'")} AS stop_set FROM (
                SELECT t.service_date, t.route_id, t.day_type, {m.trip_aggregates()} FROM (SELECT a.*, b.day_type FROM {{trips}} a JOIN {{day_types}} b ON a.service_date = b.service_date) t
                GROUP BY t.service_date, t.route_id, t.day_type) y) k
        LEFT JOIN ({events}) e ON k.service_date = e.service_date AND k.stop_set = e.stop_set AND k.route_id = e.route_id""")


@stated
def route_daily(d: Spark) -> str:
    """One row per date, route and stop set, with the date's own day type."""
    keys = "service_date, stop_set, route_id"
    if d.name == "duck":
        return _daily(d, _events_by(d, keys, "{set_events}"))
    return _daily(d, _summed(keys, _both_sets(_histogram(departures_of(d), "service_date, route_id", marked=True))))


def _station(d: Spark, more: str) -> str:
    source = "(SELECT * FROM {station_departures}) w" if d.name == "spark" else "(SELECT v.*, st.station_id FROM (SELECT * FROM {stop_events} WHERE stop_position <> 'final' AND in_scope) v JOIN {stations} st ON v.stop_id = st.stop_id) w"
    latest = "{latest_positions}" if d.name == "spark" else f"(SELECT month, station_id, {d.latest('lat', 'service_date')} AS lat, {d.latest('lon', 'service_date')} AS lon FROM {{positions}} GROUP BY month, station_id)"
    return m.with_floor(f"""
        SELECT e.month, e.day_type, e.stop_set, e.station_id, n.station_name, p.lat, p.lon, e.route_ids, c.month_complete, {m.event_columns('e')}
        FROM (SELECT * FROM ({_measures(d, 'station_id', source, 'route_id', more)}) f WHERE stop_set = 'all_stops' OR eligible_departures > 0) e
        JOIN (SELECT station_id, min(station_name) AS station_name FROM {{stations}} GROUP BY station_id) n ON e.station_id = n.station_id
        LEFT JOIN {latest} p ON e.month = p.month AND e.station_id = p.station_id
        JOIN {{complete}} c ON e.month = c.month""")


@stated
def station_monthly(d: Spark) -> str:
    """As network_monthly's measures per station; timing rows only where something was eligible; the month's latest position and the routes that serve it."""
    return _station(d, f"{d.distinct_list('route_id')} AS route_ids")


@stated
def hour_monthly(d: Spark) -> str:
    """Measures per local hour of the scheduled departure."""
    source = departures_of(d) if d.name == "spark" else f"(SELECT *, {d.local_hour('scheduled_s')} AS hour_local FROM {departures_of(d)}) w"
    return m.with_floor(f"""
        SELECT e.month, e.day_type, e.stop_set, e.hour_local, c.month_complete, {m.event_columns('e')}
        FROM ({_measures(d, 'hour_local', source)}) e JOIN {{complete}} c ON e.month = c.month""")


@stated
def category_monthly(d: Spark) -> str:
    """Trips and measures per route category, from raw rows; routes without a category are Unmapped."""

    def mapped(inner: str) -> str:
        return f"(SELECT z.*, coalesce(g.category, 'Unmapped') AS route_category FROM (SELECT * FROM {inner}) z LEFT JOIN {{categories}} g ON z.route_id = g.route_id) w"

    return m.with_floor(f"""
        SELECT k.month, k.day_type, k.stop_set, k.route_category, c.month_complete, {m.trip_columns('k')}, {m.event_columns('e')}
        FROM (SELECT *, {d.explode("'all_stops'", "'timing_stops'")} AS stop_set FROM ({_trip_counts(d, 'route_category', mapped('{trips}').removesuffix(' w'))}) y) k
        LEFT JOIN ({_measures(d, 'route_category', mapped(departures_of(d)))}) e
            ON k.month = e.month AND k.day_type = e.day_type AND k.stop_set = e.stop_set AND k.route_category = e.route_category
        JOIN {{complete}} c ON k.month = c.month""")


@stated
def day_type_expand(d: Spark) -> str:
    """Dates and trips per expanded day type."""
    return "SELECT e.month, e.day_type, count(DISTINCT t.service_date) AS service_dates, count(*) AS trips FROM {trips} t JOIN {day_expanded} e ON t.service_date = e.service_date GROUP BY e.month, e.day_type"


@stated
def stop_set_expand(d: Spark) -> str:
    """Stop events per overlapping stop set and status."""
    return "SELECT stop_set, status, count(*) AS events FROM {set_events} GROUP BY stop_set, status"


@stated
def month_completeness(d: Spark) -> str:
    """Whether every date of a month was processed."""
    return "SELECT month, n_dates, month_complete FROM {complete}"


@stated
def route_pattern_labels(d: Spark) -> str:
    """Each route's commonest stop pattern, ties broken in full, as its label."""
    return f"""
    SELECT p.route_id, n.n_name || ' · ' || a.station_name || ' – ' || b.station_name AS label, p.n_trips, p.pattern_key
    FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY n_trips DESC, earliest ASC, direction_id ASC NULLS LAST, pattern_key ASC) AS rn
          FROM (SELECT route_id, pattern_key, min(first_stop) AS first_stop, min(last_stop) AS last_stop, min(direction_id) AS direction_id, count(*) AS n_trips, min(earliest) AS earliest
                FROM (SELECT route_id, trip_id, direction_id, {d.list_by('stop_id', 'stop_sequence')} AS pattern_key, {d.earliest('stop_id', 'stop_sequence')} AS first_stop,
                        {d.latest('stop_id', 'stop_sequence')} AS last_stop, min(scheduled_s) AS earliest
                      FROM {{stop_events}} GROUP BY route_id, trip_id, direction_id) x GROUP BY route_id, pattern_key) y) p
    JOIN {{nation}} n ON p.route_id = n.n_nationkey JOIN {{stations}} a ON p.first_stop = a.stop_id JOIN {{stations}} b ON p.last_stop = b.stop_id
    WHERE p.rn = 1"""


@stated
def label_collisions(d: Spark) -> str:
    """Labels that more than one id bears, and their ids."""
    return f"SELECT p_name AS label, {d.distinct_list('p_brand')} AS brands, count(DISTINCT p_brand) AS n FROM {{part}} GROUP BY p_name HAVING count(DISTINCT p_brand) > 1"


@stated
def unmapped_routes(d: Spark) -> str:
    """In-scope trips per date whose route has no category."""
    return "SELECT t.service_date, count(*) AS unmapped_trips FROM {trips} t LEFT JOIN {categories} c ON t.route_id = c.route_id WHERE t.in_scope AND c.route_id IS NULL GROUP BY t.service_date"


def _feed_days(d: Spark) -> str:
    day = d.local_date("header_s")
    return f"""(SELECT {day} AS service_date, count(DISTINCT header_s) AS distinct_snapshots, count(*) - count(DISTINCT header_s) AS duplicate_snapshots, min(header_s) AS first_s, max(header_s) AS last_s,
            24 - count(DISTINCT {d.local_hour('header_s')}) AS local_hours_without_snapshots, {m.count_if('held_s IS NOT NULL')} AS with_held, {m.count_if('held_s IS NOT NULL AND uncertainty_present')} AS with_marker,
            count(DISTINCT CASE WHEN trip_id % 11 = 0 THEN trip_id END) AS out_of_scope_trips_in_feed, count(DISTINCT CASE WHEN trip_id % 97 = 0 THEN trip_id END) AS unmatched_realtime_trips,
            count(DISTINCT CASE WHEN snapshot_file % 53 = 0 THEN {d.tup('trip_id', 'stop_sequence')} END) AS schedule_mismatch_stop_events FROM {{feed}} GROUP BY {day}) f"""


def _plain_quality(d: Spark) -> str:
    return f"""
    SELECT f.service_date, dt.day_type, f.distinct_snapshots, f.duplicate_snapshots, {d.local('f.first_s')} AS first_snapshot_local, {d.local('f.last_s')} AS last_snapshot_local,
        g.longest_outage_s, {d.local('l.gap_start_s')} AS longest_outage_start_local, {d.local('l.gap_end_s')} AS longest_outage_end_local, g.outages,
        round(coalesce(o.minutes, 0), 2) AS outage_minutes_06_22, f.local_hours_without_snapshots, {m.share('f.with_marker', 'f.with_held')} AS marker_share, f.out_of_scope_trips_in_feed,
        t.in_scope_trips, t.trips_no_realtime_data, t.trips_no_realtime_data_in_outage, t.cancelled_trips, {m.share('c.observed', 'c.eligible')} AS coverage_share,
        coalesce(a.dst_ambiguous_departures, 0) AS dst_ambiguous_departures, f.schedule_mismatch_stop_events, f.unmatched_realtime_trips, coalesce(u.unmapped_route_trips, 0) AS unmapped_route_trips
    FROM {_feed_days(d)}
    JOIN (SELECT DISTINCT service_date, day_type FROM {{month_days}}) dt ON f.service_date = dt.service_date
    JOIN (SELECT service_date, count(*) AS outages, max(gap_s) AS longest_outage_s FROM {{clipped}} GROUP BY service_date) g ON f.service_date = g.service_date
    JOIN (SELECT *, row_number() OVER (PARTITION BY service_date ORDER BY gap_s DESC, gap_start_s ASC) AS rn FROM {{clipped}}) l ON f.service_date = l.service_date AND l.rn = 1
    LEFT JOIN (SELECT service_date, cast(sum(greatest(0, least(gap_end_s, {d.utc_of('service_date', 22)}) - greatest(gap_start_s, {d.utc_of('service_date', 6)}))) AS double) / 60 AS minutes
               FROM {{clipped}} GROUP BY service_date) o ON f.service_date = o.service_date
    JOIN (SELECT m.service_date, {m.count_if('t.in_scope')} AS in_scope_trips, {m.count_if("t.trip_status = 'no_realtime_data'")} AS trips_no_realtime_data, {m.count_if('t.no_data_in_outage')} AS trips_no_realtime_data_in_outage,
            {m.count_if("t.trip_status = 'cancelled'")} AS cancelled_trips FROM {{trips}} t JOIN {{month_days}} m ON t.service_date = m.trip_date GROUP BY m.service_date) t ON f.service_date = t.service_date
    JOIN (SELECT m.service_date, {m.count_if(m.ELIGIBLE)} AS eligible, {m.count_if(m.OBSERVED)} AS observed FROM {{stop_events}} e JOIN {{month_days}} m ON e.service_date = m.trip_date WHERE e.stop_position <> 'final' AND e.in_scope GROUP BY m.service_date) c ON f.service_date = c.service_date
    LEFT JOIN (SELECT m.service_date, {m.count_if("e.status = 'dst_ambiguous'")} AS dst_ambiguous_departures FROM {{stop_events}} e JOIN {{month_days}} m ON e.service_date = m.trip_date WHERE e.stop_position <> 'final' GROUP BY m.service_date) a ON f.service_date = a.service_date
    LEFT JOIN (SELECT m.service_date, count(*) AS unmapped_route_trips FROM {{trips}} t JOIN {{month_days}} m ON t.service_date = m.trip_date LEFT JOIN {{categories}} c ON t.route_id = c.route_id WHERE t.in_scope AND c.route_id IS NULL GROUP BY m.service_date) u ON f.service_date = u.service_date"""


@stated(plainly=_plain_quality)
def data_quality_daily(d: Spark) -> str:
    """One row per date from ten relations: the feed's figures, its outages clipped to the day, trips, coverage
    and unmapped routes; dates without an outage vanish, as published.

    Outages, trips and stop events are each aggregated once; the day of the feed's month is worked out from a row's own date.
    """
    day, dealt = month_day(d, "service_date"), "SELECT * FROM (SELECT *, {0} AS feed_date FROM {1}) r"
    outages = f"""SELECT service_date, count(*) AS outages, max(gap_s) AS longest_outage_s, min(struct(-gap_s, gap_start_s, gap_end_s)) AS longest,
            cast(sum(greatest(0, least(gap_end_s, {d.utc_of('service_date', 22)}) - greatest(gap_start_s, {d.utc_of('service_date', 6)}))) AS double) / 60 AS minutes FROM {{clipped}} GROUP BY service_date"""
    statuses = {"in_scope_trips": "t.in_scope", "trips_no_realtime_data": "t.trip_status = 'no_realtime_data'", "trips_no_realtime_data_in_outage": "t.no_data_in_outage", "cancelled_trips": "t.trip_status = 'cancelled'", "unmapped_route_trips": "t.in_scope AND c.route_id IS NULL"}
    trips = f"SELECT feed_date, {', '.join(f'{m.count_if(c)} AS {n}' for n, c in statuses.items())} FROM ({dealt.format(day, '{trips}')}) t LEFT JOIN {{categories}} c ON t.route_id = c.route_id GROUP BY feed_date"
    events = f"""SELECT feed_date, {m.count_if(f'in_scope AND {m.ELIGIBLE}')} AS eligible, {m.count_if(f'in_scope AND {m.OBSERVED}')} AS observed, {m.count_if("status = 'dst_ambiguous'")} AS dst_ambiguous_departures
        FROM ({dealt.format(day, '{stop_events}')}) e WHERE stop_position <> 'final' GROUP BY feed_date HAVING bool_or(in_scope)"""
    return f"""
    SELECT f.service_date, {d.day_type('f.service_date')} AS day_type, f.distinct_snapshots, f.duplicate_snapshots, {d.local('f.first_s')} AS first_snapshot_local, {d.local('f.last_s')} AS last_snapshot_local,
        g.longest_outage_s, {d.local('g.longest.gap_start_s')} AS longest_outage_start_local, {d.local('g.longest.gap_end_s')} AS longest_outage_end_local, g.outages,
        round(g.minutes, 2) AS outage_minutes_06_22, f.local_hours_without_snapshots, {m.share('f.with_marker', 'f.with_held')} AS marker_share, f.out_of_scope_trips_in_feed,
        t.in_scope_trips, t.trips_no_realtime_data, t.trips_no_realtime_data_in_outage, t.cancelled_trips, {m.share('e.observed', 'e.eligible')} AS coverage_share,
        e.dst_ambiguous_departures, f.schedule_mismatch_stop_events, f.unmatched_realtime_trips, t.unmapped_route_trips
    FROM {_feed_days(d)} JOIN ({outages}) g ON f.service_date = g.service_date JOIN ({trips}) t ON f.service_date = t.feed_date JOIN ({events}) e ON f.service_date = e.feed_date"""


@stated
def headline_crosscheck(d: Spark) -> str:
    """Headline counts from raw rows against the sums of the published months: the difference is zero."""
    return f"""
    SELECT a.stop_set, a.eligible, a.observed, a.on_time, a.eligible - b.eligible AS eligible_diff, a.observed - b.observed AS observed_diff, a.on_time - b.on_time AS on_time_diff
    FROM (SELECT stop_set, {m.count_if(m.ELIGIBLE)} AS eligible, {m.count_if(m.OBSERVED)} AS observed, {m.count_if(m.EVENT_COUNTS['on_time_departures'])} AS on_time FROM {{set_events}} GROUP BY stop_set) a
    JOIN (SELECT stop_set, cast(sum(eligible_departures) AS bigint) AS eligible, cast(sum(observed_departures) AS bigint) AS observed, cast(sum(on_time_departures) AS bigint) AS on_time
          FROM ({_measures(d, '', departures_of(d))}) e WHERE day_type = 'all' GROUP BY stop_set) b ON a.stop_set = b.stop_set"""


#: Invariants over one row of the network table, and how its rows add up: name and what breaks it.
ROW_RULES = {
    "classes sum to observed": "early_departures + on_time_departures + late_departures <> observed_departures",
    "eligible is observed and unobserved": "observed_departures + unobserved_departures <> eligible_departures",
    "windows are nested": "on_time_60_departures > on_time_departures OR on_time_departures > on_time_300_departures",
}
SUMMED = ("eligible_departures", "observed_departures", "late_departures", "skipped_departures", "observed_trips")


def _plain_checks(d: Spark) -> str:
    by, routes = _plain_measures(d, "", departures_of(d)), _plain_measures(d, "route_id", departures_of(d))
    rows = [f"SELECT '{n}' AS check_name, {m.count_if(r)} AS violations FROM ({by}) a" for n, r in ROW_RULES.items()]
    for x in SUMMED:
        total = f"cast(sum({x}) AS bigint) AS s"
        rows.append(f"SELECT 'all is the sum of day types: {x}', {m.count_if('a.s <> b.s')} FROM (SELECT month, stop_set, {x} AS s FROM ({by}) x WHERE day_type = 'all') a JOIN (SELECT month, stop_set, {total} FROM ({by}) x WHERE day_type <> 'all' GROUP BY month, stop_set) b ON a.month = b.month AND a.stop_set = b.stop_set")
        rows.append(f"SELECT 'timing stops are some of all stops: {x}', {m.count_if('t.s > a.s')} FROM (SELECT month, day_type, {x} AS s FROM ({by}) x WHERE stop_set = 'all_stops') a JOIN (SELECT month, day_type, {x} AS s FROM ({by}) x WHERE stop_set = 'timing_stops') t ON a.month = t.month AND a.day_type = t.day_type")
        rows.append(f"SELECT 'routes sum to the network: {x}', {m.count_if('a.s <> b.s')} FROM (SELECT month, day_type, stop_set, {x} AS s FROM ({by}) x) a JOIN (SELECT month, day_type, stop_set, {total} FROM ({routes}) x GROUP BY month, day_type, stop_set) b ON a.month = b.month AND a.day_type = b.day_type AND a.stop_set = b.stop_set")
    return "\nUNION ALL ".join(rows)


@stated(plainly=_plain_checks)
def consistency_checks(d: Spark) -> str:
    """Invariants of the tables, as name and violations; all are zero.

    The network table's sums by day type, stop set and route are compared in one aggregation a view.
    """
    sums = ", ".join(f"sum({x}) AS {x}" for x in m.EVENT_COUNTS)
    rules = ", ".join(f"max(CASE WHEN {r} THEN 1 ELSE 0 END) AS r{i}" for i, r in enumerate(ROW_RULES.values()))
    parts = ", ".join(f"sum(CASE WHEN part THEN {x} END) AS p_{x}, sum(CASE WHEN part THEN 0 ELSE {x} END) AS w_{x}" for x in SUMMED)
    # rows of the network table and of the routes' sums, told apart by origin
    both = f"""
        SELECT month, day_type, stop_set, 'network' AS origin, {', '.join(m.EVENT_COUNTS)}, observed_trips FROM ({_measures(d, '', departures_of(d))}) n
        UNION ALL SELECT month, day_type, stop_set, 'routes', {sums}, sum(observed_trips) FROM ({_measures(d, 'route_id', departures_of(d))}) r GROUP BY month, day_type, stop_set"""
    views = {
        "all is the sum of day types": ("month, stop_set", "day_type <> 'all'", "origin = 'network'", "<>"),
        "timing stops are some of all stops": ("month, day_type", "stop_set = 'timing_stops'", "origin = 'network'", ">"),
        "routes sum to the network": ("month, day_type, stop_set", "origin = 'routes'", "true", "<>"),
    }
    texts = []
    for name, (keys, part, where, wrong) in views.items():
        pairs = ", ".join(f"'{name}: {x}', {m.count_if(f'p_{x} {wrong} w_{x}')}" for x in SUMMED)
        texts.append(f"SELECT stack({len(SUMMED)}, {pairs}) AS (check_name, violations) FROM (SELECT {keys}, {parts} FROM (SELECT *, {part} AS part FROM ({both}) b WHERE {where}) c GROUP BY {keys}) s")
    own = ", ".join(f"'{n}', sum(r{i})" for i, n in enumerate(ROW_RULES))
    texts.append(f"SELECT stack({len(ROW_RULES)}, {own}) AS (check_name, violations) FROM (SELECT month, day_type, stop_set, {rules} FROM ({both}) b WHERE origin = 'network' GROUP BY month, day_type, stop_set) s")
    return " UNION ALL ".join(texts)


#: Checks over stop events: name and what breaks one row.
EVENT_RULES = {
    "non-final has status": "stop_position <> 'final' AND status IS NULL",
    "final has no status": "stop_position = 'final' AND status IS NOT NULL",
    "delay only when observed": "(delay_s IS NOT NULL) <> coalesce(status = 'observed', false)",
    "out of scope follows the trip": "status IS NOT NULL AND (status = 'out_of_scope') = in_scope",
    "cancelled follows the trip": "status = 'cancelled' AND trip_status <> 'cancelled'",
    "out-of-scope trips have out-of-scope events": "trip_status = 'out_of_scope' AND stop_position <> 'final' AND status <> 'out_of_scope'",
    "timing flag is set": "is_timing_stop IS NULL",
    "ambiguous only by rule": "status = 'dst_ambiguous' AND l_partkey % 97 <> 2",
}
#: Checks over trips and over outages.
TRIP_RULES = {
    "scope follows the trip status": "in_scope = (trip_status = 'out_of_scope')",
    "outage flag only without data": "(no_data_in_outage IS NOT NULL) <> (trip_status = 'no_realtime_data')",
}
GAP_RULES = {"outages are long": f"gap_s <= {GAP_S}"}


def _plain_hard_checks(d: Spark) -> str:
    rows = [f"SELECT '{n}' AS check_name, (SELECT count(*) FROM {{stop_events}} WHERE {r}) AS violations" for n, r in EVENT_RULES.items()]
    rows += [f"SELECT '{n}', (SELECT count(*) FROM {{trips}} WHERE {r})" for n, r in TRIP_RULES.items()]
    rows += [f"SELECT '{n}', (SELECT count(*) FROM {{gaps}} WHERE {r})" for n, r in GAP_RULES.items()]
    rows += [
        "SELECT 'stop event keys are unique', (SELECT count(*) FROM (SELECT trip_id, stop_sequence FROM {stop_events} GROUP BY trip_id, stop_sequence HAVING count(*) > 1) a)",
        "SELECT 'trip keys are unique', (SELECT count(*) FROM (SELECT service_date, trip_id FROM {trips} GROUP BY service_date, trip_id HAVING count(*) > 1) a)",
        "SELECT 'no orphan stop events', (SELECT count(*) FROM {stop_events} s WHERE NOT EXISTS (SELECT 1 FROM {trips} t WHERE t.trip_id = s.trip_id))",
        "SELECT 'every trip has stop events', (SELECT count(*) FROM {trips} t WHERE NOT EXISTS (SELECT 1 FROM {stop_events} s WHERE s.trip_id = t.trip_id))",
        "SELECT 'scope is the trip''s', (SELECT count(*) FROM {stop_events} s JOIN {trips} t ON s.trip_id = t.trip_id WHERE s.in_scope <> t.in_scope)",
        "SELECT 'as many events as scheduled', (SELECT abs((SELECT count(*) FROM {stop_events}) - (SELECT count(*) FROM {lineitem} WHERE l_orderkey IN (SELECT trip_id FROM {trips}))))",
        "SELECT 'as many trips as scheduled', (SELECT abs((SELECT count(*) FROM {trips}) - (SELECT count(*) FROM {orders} WHERE o_custkey IN (SELECT c_custkey FROM {customer}))))",
        "SELECT 'outages do not overlap', (SELECT count(*) FROM (SELECT gap_start_s, lag(gap_end_s) OVER (ORDER BY gap_start_s) AS before_s FROM {gaps}) g WHERE gap_start_s < before_s)",
    ]
    return "\nUNION ALL ".join(rows)


@stated(plainly=_plain_hard_checks)
def hard_checks(d: Spark) -> str:
    """Warehouse checks, as name and violations; one-stop trips and orders without stops are known exceptions.

    Stop events and trips are each read once and meet by trip; outages are compared within days, and days by their edges.
    """
    broken = ", ".join(f"{m.count_if(r)} AS e{i}" for i, r in enumerate(EVENT_RULES.values()))
    keys = f"SELECT trip_id, stop_sequence, count(*) AS n, {m.count_if('in_scope')} AS n_in, {broken} FROM {{stop_events}} GROUP BY trip_id, stop_sequence"
    summed = ", ".join(f"sum(e{i}) AS e{i}" for i in range(len(EVENT_RULES)))
    events = f"SELECT trip_id, sum(n) AS n, sum(n_in) AS n_in, {m.count_if('n > 1')} AS repeated, {summed} FROM ({keys}) k GROUP BY trip_id"
    flags = ", ".join(f"{m.count_if(r)} AS t{i}" for i, r in enumerate(TRIP_RULES.values()))
    trips = f"SELECT trip_id, sum(n) AS n, count_if(n > 1) AS repeated, {', '.join(f'sum(t{i}) AS t{i}' for i in range(len(TRIP_RULES)))}, bool_or(in_any) AS in_scope FROM (SELECT trip_id, service_date, count(*) AS n, bool_or(in_scope) AS in_any, {flags} FROM {{trips}} GROUP BY trip_id, service_date) k GROUP BY trip_id"
    figures = [(n, f"sum(e.e{i})") for i, n in enumerate(EVENT_RULES)] + [(n, f"sum(t.t{i})") for i, n in enumerate(TRIP_RULES)]
    figures += [
        ("stop event keys are unique", "sum(e.repeated)"),
        ("trip keys are unique", "sum(t.repeated)"),
        ("no orphan stop events", "sum(CASE WHEN t.trip_id IS NULL THEN e.n ELSE 0 END)"),
        ("every trip has stop events", "sum(CASE WHEN e.trip_id IS NULL THEN t.n ELSE 0 END)"),
        ("scope is the trip\\'s", "sum(CASE WHEN t.in_scope THEN e.n - e.n_in ELSE e.n_in END)"),
        ("as many events as scheduled", "abs(sum(e.n) - max(x.lines))"),
        ("as many trips as scheduled", "abs(sum(t.n) - max(x.orders))"),
    ]
    pairs = ", ".join(f"'{n}', cast(coalesce({v}, 0) AS bigint)" for n, v in figures)
    # outages meet the one before them within days; only days' first and last ones meet across
    rules = "".join(f", {m.count_if(r)} AS g{i}" for i, r in enumerate(GAP_RULES.values()))
    within = "SELECT *, gap_start_s div 86400 AS day_, lag(gap_end_s) OVER (PARTITION BY gap_start_s div 86400 ORDER BY gap_start_s) AS before_s FROM {gaps}"
    days = f"SELECT day_, min(gap_start_s) AS lo, max(gap_end_s) AS hi, {m.count_if('gap_start_s < before_s')} AS met{rules} FROM ({within}) w GROUP BY day_"
    lists = f"SELECT cast(sum(met) + {m.count_if('lo < before_hi')} AS bigint) AS met, {', '.join(f'cast(sum(g{i}) AS bigint) AS g{i}' for i in range(len(GAP_RULES)))} FROM (SELECT *, lag(hi) OVER (ORDER BY day_) AS before_hi FROM ({days}) d) e"
    gaps = ", ".join(f"'{n}', coalesce(g{i}, 0L)" for i, n in enumerate(GAP_RULES)) + ", 'outages do not overlap', coalesce(met, 0L)"
    scheduled = "SELECT (SELECT count(*) FROM {lineitem} l LEFT SEMI JOIN {trips} t ON l.l_orderkey = t.trip_id) AS lines, (SELECT count(*) FROM {orders} o LEFT SEMI JOIN {customer} c ON o.o_custkey = c.c_custkey) AS orders"
    return f"""
    SELECT stack({len(figures)}, {pairs}) AS (check_name, violations) FROM ({events}) e FULL OUTER JOIN ({trips}) t ON e.trip_id = t.trip_id CROSS JOIN ({scheduled}) x
    UNION ALL SELECT stack({len(GAP_RULES) + 1}, {gaps}) AS (check_name, violations) FROM ({lists}) y"""
