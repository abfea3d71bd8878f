"""Feed forensics: what held values, drops, predictions and vehicle positions say about the feed."""

from __future__ import annotations

from stoptide.functions import measures as m
from stoptide.functions.dialect import Spark
from stoptide.plans.engine import stated

BY_STOP = "OVER (PARTITION BY trip_id, stop_sequence ORDER BY header_s, snapshot_file)"
CHANGED = f"(SELECT *, held_s IS DISTINCT FROM lag(held_s) {BY_STOP} AS changed, lag(held_s) {BY_STOP} AS before_s FROM {{feed}} WHERE trip_relationship <> 'CANCELED' AND stop_relationship <> 'SKIPPED') c"


@stated
def value_change_log(d: Spark) -> str:
    """Rows whose held value differs from the row before; the first of a stop counts as a change."""
    return f"SELECT trip_id, stop_sequence, header_s, snapshot_file, held_s, before_s FROM {CHANGED} WHERE changed"


def _held(d: Spark) -> str:
    """The definition, relation by relation: crossing, value at the crossing, changes after it, the trip's last row."""
    return f"""
    SELECT k.trip_id, k.stop_sequence, k.t_cross, k.n_changes, k.last_change, k.held_value, k.marked, a.value_at_cross, k.held_value - a.value_at_cross AS drift, b.changes_after, k.held_ts = l.last_ts AS is_trip_removal
    FROM (SELECT trip_id, stop_sequence, min(header_s) FILTER (WHERE header_s >= held_s) AS t_cross, {m.count_if('changed')} AS n_changes, max(header_s) FILTER (WHERE changed) AS last_change,
            max(header_s) AS held_ts, {d.latest('held_s', 'header_s * 100000 + snapshot_file')} AS held_value, {d.latest('uncertainty_present', 'header_s * 100000 + snapshot_file')} AS marked FROM {CHANGED} GROUP BY trip_id, stop_sequence) k
    LEFT JOIN (SELECT trip_id, stop_sequence, header_s, min(held_s) AS value_at_cross FROM {CHANGED} GROUP BY trip_id, stop_sequence, header_s) a ON a.trip_id = k.trip_id AND a.stop_sequence = k.stop_sequence AND a.header_s = k.t_cross
    LEFT JOIN (SELECT s.trip_id, s.stop_sequence, {m.count_if('h.changed AND h.header_s > s.t_cross')} AS changes_after
               FROM (SELECT trip_id, stop_sequence, min(header_s) AS t_cross FROM {CHANGED} WHERE header_s >= held_s GROUP BY trip_id, stop_sequence) s
               JOIN {CHANGED.removesuffix(' c')} h ON h.trip_id = s.trip_id AND h.stop_sequence = s.stop_sequence GROUP BY s.trip_id, s.stop_sequence) b ON b.trip_id = k.trip_id AND b.stop_sequence = k.stop_sequence
    JOIN (SELECT trip_id, max(header_s) AS last_ts FROM {CHANGED} GROUP BY trip_id) l ON l.trip_id = k.trip_id"""


def _held_in_one_pass(d: Spark) -> str:
    """The same from windows of one shuffle by trip: by stop for the crossing, over the trip for its last row."""
    return f"""
    SELECT trip_id, stop_sequence, max(t_cross) AS t_cross, {m.count_if('changed')} AS n_changes, max(header_s) FILTER (WHERE changed) AS last_change,
        max(struct(header_s, snapshot_file, held_s)).held_s AS held_value, max(struct(header_s, snapshot_file, uncertainty_present)).uncertainty_present AS marked,
        min(held_s) FILTER (WHERE header_s = t_cross) AS value_at_cross, max(struct(header_s, snapshot_file, held_s)).held_s - min(held_s) FILTER (WHERE header_s = t_cross) AS drift,
        CASE WHEN max(t_cross) IS NOT NULL THEN {m.count_if('changed AND header_s > t_cross')} END AS changes_after, max(header_s) = max(last_ts) AS is_trip_removal
    FROM (SELECT *, min(CASE WHEN header_s >= held_s THEN header_s END) OVER (PARTITION BY trip_id, stop_sequence) AS t_cross, max(header_s) OVER (PARTITION BY trip_id) AS last_ts FROM {CHANGED}) h
    GROUP BY trip_id, stop_sequence"""


@stated(plainly=_held)
def held_value_summary(d: Spark) -> str:
    """Per trip and stop: when the clock first passed the held value, the value then, changes after, the drift, and whether the stop left with its trip."""
    return _held_in_one_pass(d)


#: Quantiles of a check's figures, in percent.
QUANTILES = (1, 5, 25, 50, 75, 95, 99)


def _drift_by(d: Spark, held: str) -> str:
    qs = ", ".join(f"{d.quantile('drift', p / 100, 'drift IS NOT NULL')} AS drift_p{p}" for p in QUANTILES)
    within = ", ".join(f"{m.share(m.count_if(f'abs(drift) <= {t}'), m.count_if('drift IS NOT NULL'))} AS within_{t}" for t in (15, 30, 60))
    figures = f"count(*) AS n, {m.count_if('t_cross IS NOT NULL')} AS n_cross, {m.count_if('changes_after = 0')} AS n_frozen, {qs}, {within}, {d.quantile('last_change - t_cross', 0.5, 'last_change IS NOT NULL AND t_cross IS NOT NULL')} AS change_after_cross_p50"
    kinds = {"all": "'overall'", "leave kind": "CASE WHEN is_trip_removal THEN 'trip_removal' ELSE 'mid_route_drop' END", "marker": "CASE WHEN marked THEN 'present' ELSE 'absent' END"}
    return " UNION ALL ".join(f"SELECT '{k}' AS grouping_, {e} AS group_, {figures} FROM ({held}) h GROUP BY {e}" for k, e in kinds.items())


@stated(plainly=lambda d: _drift_by(d, _held(d)))
def held_check_by_kind(d: Spark) -> str:
    """Frozen or drifting: the held values' figures overall, by how the stop left, and by marker."""
    return _drift_by(d, _held_in_one_pass(d))


def _missing_marker(held: str) -> str:
    where = "CASE WHEN stop_sequence = 5 THEN 'final' WHEN stop_sequence = 1 THEN 'first' ELSE 'intermediate' END"
    leave = "CASE WHEN is_trip_removal THEN 'trip_removal' ELSE 'clean_drop' END"
    return f"SELECT {where} AS position, {leave} AS leave_kind, count(*) AS n FROM ({held}) h WHERE NOT marked GROUP BY {where}, {leave}"


@stated(plainly=lambda d: _missing_marker(_held(d)))
def missing_marker_positions(d: Spark) -> str:
    """Held values without a marker, by the stop's position and how it left."""
    return _missing_marker(_held_in_one_pass(d))


@stated
def uncertainty_crosstab(d: Spark) -> str:
    """Rows by uncertainty and how far the held value lies ahead."""
    u = "CASE WHEN NOT uncertainty_present THEN 'absent' WHEN uncertainty = 0 THEN 'zero' ELSE 'positive' END"
    t = "CASE WHEN held_s < header_s THEN 'past' WHEN held_s < header_s + 60 THEN 'minute' ELSE 'later' END"
    return f"SELECT {u} AS uncertainty_bucket, {t} AS time_bucket, count(*) AS n FROM {{feed}} GROUP BY {u}, {t}"


@stated
def trip_removal_class(d: Spark) -> str:
    """Of each trip's last snapshot: stops left, those still ahead, and whether the final stop is among them."""
    return f"""
    SELECT f.trip_id, l.last_s, count(*) AS n_remaining, {m.count_if('f.held_s > l.last_s')} AS n_future, bool_or(f.stop_sequence = 5) AS final_present, bool_or(f.stop_sequence = 5 AND f.held_s > l.last_s) AS final_future
    FROM {{feed}} f JOIN (SELECT trip_id, max(header_s) AS last_s FROM {{feed}} GROUP BY trip_id) l ON f.trip_id = l.trip_id AND f.header_s = l.last_s GROUP BY f.trip_id, l.last_s"""


@stated
def offset_percentiles(d: Spark) -> str:
    """Quantiles of held value minus snapshot time, and shares within 15, 30 and 60 seconds."""
    qs = ", ".join(f"{d.quantile('held_s - header_s', p, 'true')} AS p{int(p * 100)}" for p in (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99))
    shares = ", ".join(f"round(avg(CASE WHEN abs(held_s - header_s) <= {t} THEN 1.0 ELSE 0.0 END), 4) AS within_{t}" for t in (15, 30, 60))
    return f"SELECT count(*) AS n, {qs}, {shares.replace('1.0 ELSE 0.0', 'cast(1 AS double) ELSE cast(0 AS double)')} FROM {{feed}}"


@stated
def cadence_stats(d: Spark) -> str:
    """Quantiles of the time between snapshots and how many exceed 30, 60 and 300 seconds."""
    qs = ", ".join(f"{d.quantile('gap_s', p, 'gap_s IS NOT NULL')} AS p{int(p * 100)}" for p in (0.5, 0.95, 0.99))
    return f"SELECT {qs}, max(gap_s) AS max_s, {m.count_if('gap_s > 30')} AS over_30, {m.count_if('gap_s > 60')} AS over_60, {m.count_if('gap_s > 300')} AS over_300 FROM (SELECT header_s - before_s AS gap_s FROM {{steps}}) x"


@stated
def cadence_top20(d: Spark) -> str:
    """The twenty longest times between snapshots."""
    return "SELECT header_s, gap_s FROM (SELECT header_s, header_s - before_s AS gap_s FROM {steps}) x WHERE gap_s IS NOT NULL ORDER BY gap_s DESC, header_s ASC LIMIT 20"


@stated
def field_population(d: Spark) -> str:
    """How many rows have each field, and the relationships' counts."""
    skipped, canceled = "stop_relationship = 'SKIPPED'", "trip_relationship = 'CANCELED'"
    return f"SELECT count(*) AS n, {m.count_if('uncertainty_present')} AS with_uncertainty, {m.count_if('held_s IS NOT NULL')} AS with_time, {m.count_if(skipped)} AS skipped, {m.count_if(canceled)} AS canceled FROM {{feed}}"


@stated
def trip_span_censoring(d: Spark) -> str:
    """Each trip's span in the feed, whether it touches the feed's ends, and whether it is scheduled."""
    return """
    SELECT s.trip_id, s.first_s, s.last_s, s.n, s.first_s = b.lo AS censored_start, s.last_s = b.hi AS censored_end, c.c_custkey IS NOT NULL AS matched_static
    FROM (SELECT trip_id, min(header_s) AS first_s, max(header_s) AS last_s, count(DISTINCT header_s) AS n FROM {feed} GROUP BY trip_id) s
    CROSS JOIN (SELECT min(header_s) AS lo, max(header_s) AS hi FROM {snapshots}) b LEFT JOIN {customer} c ON s.trip_id = c.c_custkey"""


#: A trip's stops in windows of six hours stand for its stop list per snapshot.
PRESENT = "(SELECT DISTINCT trip_id, {idiv} AS slot, stop_sequence FROM {{feed}}) p"


def _present(d: Spark) -> str:
    return PRESENT.format(idiv=d.idiv("header_s", "21600"))


def _slots(d: Spark) -> str:
    return f"(SELECT trip_id, slot, lead(slot) OVER (PARTITION BY trip_id ORDER BY slot) AS next_slot FROM (SELECT DISTINCT trip_id, slot FROM {_present(d)}) t) s"


def _drops(d: Spark) -> str:
    return f"""
    SELECT p.trip_id, p.slot, s.next_slot, p.stop_sequence, count(*) OVER (PARTITION BY p.trip_id, p.slot) AS n_together
    FROM {_present(d)} JOIN {_slots(d)} ON p.trip_id = s.trip_id AND p.slot = s.slot
    LEFT JOIN (SELECT trip_id, slot, stop_sequence FROM {_present(d)}) q ON q.trip_id = p.trip_id AND q.slot = s.next_slot AND q.stop_sequence = p.stop_sequence
    WHERE s.next_slot IS NOT NULL AND q.trip_id IS NULL"""


def _lists(d: Spark) -> str:
    """A trip's stop lists in order, each beside the next: one aggregation and one window by trip."""
    return f"SELECT trip_id, slot, ss, lead(slot) OVER (PARTITION BY trip_id ORDER BY slot) AS next_slot, lead(ss) OVER (PARTITION BY trip_id ORDER BY slot) AS next_ss FROM (SELECT trip_id, slot, array_sort(collect_set(stop_sequence)) AS ss FROM {_present(d)} GROUP BY trip_id, slot) t"


def _vanished(d: Spark) -> str:
    kind = "CASE WHEN size(gone) > 1 THEN 'multi_drop' WHEN stop_sequence = get(ss, 0) THEN 'clean' ELSE 'not_from_front' END"
    return f"SELECT trip_id, slot, next_slot, stop_sequence, {kind} AS kind FROM (SELECT *, explode(gone) AS stop_sequence FROM (SELECT *, array_except(ss, next_ss) AS gone FROM ({_lists(d)}) l WHERE next_slot IS NOT NULL) g) e"


def _plain_vanished(d: Spark) -> str:
    return f"""
    SELECT e.trip_id, e.slot, e.next_slot, e.stop_sequence, CASE WHEN e.n_together > 1 THEN 'multi_drop' WHEN e.stop_sequence = f.front THEN 'clean' ELSE 'not_from_front' END AS kind
    FROM ({_drops(d)}) e JOIN (SELECT trip_id, slot, min(stop_sequence) AS front FROM {_present(d)} GROUP BY trip_id, slot) f ON e.trip_id = f.trip_id AND e.slot = f.slot"""


@stated(plainly=_plain_vanished)
def drop_events(d: Spark) -> str:
    """Stops that vanish between consecutive lists of a trip: clean from the front, not from it, or several at once."""
    return _vanished(d)


def _widths(d: Spark, drops: str) -> str:
    qs = ", ".join(f"{d.quantile('next_slot - slot', p, 'true')} AS p{int(100 * p)}" for p in (0.5, 0.95, 0.99))
    return f"SELECT kind, count(*) AS n, {qs}, max(next_slot - slot) AS widest FROM ({drops}) w GROUP BY kind"


@stated(plainly=lambda d: _widths(d, _plain_vanished(d)))
def drop_widths(d: Spark) -> str:
    """How wide the window is in which stops vanish, by kind."""
    return _widths(d, _vanished(d))


@stated(plainly=lambda d: f"SELECT trip_id, stop_sequence, count(*) AS n_drops FROM ({_drops(d)}) e GROUP BY trip_id, stop_sequence HAVING count(*) > 1")
def repeat_drops_reappearance(d: Spark) -> str:
    """Stops that vanish more than once, which means that they came back."""
    return f"SELECT trip_id, stop_sequence, count(*) AS n_drops FROM ({_vanished(d)}) e GROUP BY trip_id, stop_sequence HAVING count(*) > 1"


@stated
def leave_kind(d: Spark) -> str:
    """How trips leave the feed: with the final stop only, with two or more, or otherwise."""
    return f"""
    SELECT kind, count(*) AS trips FROM (SELECT trip_id, CASE WHEN count(*) = 1 AND min(stop_sequence) = 5 THEN 'final_only' WHEN count(*) >= 2 THEN 'two_plus' ELSE 'other' END AS kind
        FROM (SELECT p.trip_id, p.stop_sequence FROM {_present(d)} JOIN (SELECT trip_id, max(slot) AS slot FROM {_present(d)} GROUP BY trip_id) l ON p.trip_id = l.trip_id AND p.slot = l.slot) x GROUP BY trip_id) y GROUP BY kind"""


@stated
def snapshot_signature(d: Spark) -> str:
    """Stop lists equal to an earlier one of the same trip, and how many lists back."""
    sig = f"(SELECT trip_id, slot, md5({d.list_by('stop_sequence', 'stop_sequence')}) AS signature, row_number() OVER (PARTITION BY trip_id ORDER BY slot) AS i FROM {_present(d)} GROUP BY trip_id, slot) g"
    return f"SELECT trip_id, slot, signature, i - lag(i) OVER (PARTITION BY trip_id, signature ORDER BY slot) AS distance FROM {sig}"


@stated
def timestamp_backwards(d: Spark) -> str:
    """Rows whose trip's held time goes backwards."""
    return "SELECT count(*) AS rows_backwards, count(DISTINCT trip_id) AS trips FROM (SELECT trip_id, held_s < lag(held_s) OVER (PARTITION BY trip_id ORDER BY header_s, snapshot_file) AS back FROM {feed}) x WHERE back"


@stated
def prediction_fallback(d: Spark) -> str:
    """The first prediction there is, and where it comes from."""
    cases = {"departure.time": "snapshot_file % 4 = 0", "scheduled_departure+delay": "snapshot_file % 4 = 1", "arrival.time": "snapshot_file % 4 = 2"}
    label = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in cases.items()) + " ELSE 'unavailable' END"
    value = "coalesce(CASE WHEN snapshot_file % 4 = 0 THEN held_s END, CASE WHEN snapshot_file % 4 = 1 THEN header_s + value_s END, CASE WHEN snapshot_file % 4 = 2 THEN held_s - 30 END)"
    return f"SELECT snapshot_file, {value} AS prediction_s, {label} AS source FROM {{feed}}"


@stated(plainly=lambda d: "SELECT f.snapshot_file, f.held_s, s.header_s AS next_s FROM {feed} f ASOF LEFT JOIN {snapshots} s ON f.held_s < s.header_s")
def asof_next_snapshot(d: Spark) -> str:
    """The first snapshot strictly after each held value: a running minimum backwards within days, else the next day's first."""
    return """
    SELECT x.snapshot_file, x.t AS held_s, coalesce(x.next_s, e.after_lo) AS next_s
    FROM (SELECT snapshot_file, t, is_snapshot, day_, min(CASE WHEN is_snapshot = 1 THEN t END) OVER (PARTITION BY day_ ORDER BY t DESC, is_snapshot ASC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS next_s
          FROM (SELECT snapshot_file, held_s AS t, 0 AS is_snapshot, held_s div 86400 AS day_ FROM {feed} UNION ALL SELECT NULL, header_s, 1, header_s div 86400 FROM {snapshots}) u) x
    JOIN (SELECT day_, min(lo) OVER (ORDER BY day_ DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS after_lo
          FROM (SELECT coalesce(a.day_, b.day_) AS day_, b.lo FROM (SELECT DISTINCT held_s div 86400 AS day_ FROM {feed}) a FULL OUTER JOIN {day_edges} b ON a.day_ = b.day_) z) e ON x.day_ = e.day_
    WHERE x.is_snapshot = 0"""


@stated
def ping_dedup_windows(d: Spark) -> str:
    """Pings once per vehicle and time, in a window of 30 minutes before to 90 after the trip's middle time."""
    return f"""
    SELECT p.trip_id, count(*) AS pings, {m.count_if('p.header_s BETWEEN w.mid - 1800 AND w.mid + 5400')} AS in_window, count(DISTINCT p.vehicle_id) AS vehicles
    FROM (SELECT vehicle_id, header_s, min(trip_id) AS trip_id FROM {{pings}} GROUP BY vehicle_id, header_s) p
    JOIN (SELECT trip_id, {d.idiv('min(header_s) + max(header_s)', '2')} AS mid FROM {{pings}} WHERE trip_id IS NOT NULL GROUP BY trip_id) w ON p.trip_id = w.trip_id GROUP BY p.trip_id"""


@stated
def assignment_dropouts(d: Spark) -> str:
    """Pings without a trip within a vehicle's span on one, against those with; either side may be missing."""
    return f"""
    SELECT coalesce(a.vehicle_id, b.vehicle_id) AS vehicle_id, coalesce(a.linked, 0) AS linked, coalesce(b.dropout, 0) AS dropout, {m.share('coalesce(b.dropout, 0)', 'coalesce(a.linked, 0) + coalesce(b.dropout, 0)')} AS dropout_share
    FROM (SELECT vehicle_id, count(*) AS linked FROM {{pings}} WHERE trip_id IS NOT NULL GROUP BY vehicle_id) a
    FULL OUTER JOIN (SELECT p.vehicle_id, count(*) AS dropout FROM {{pings}} p JOIN (SELECT vehicle_id, min(header_s) AS lo, max(header_s) AS hi FROM {{pings}} WHERE trip_id IS NOT NULL GROUP BY vehicle_id) s
        ON p.vehicle_id = s.vehicle_id AND p.header_s BETWEEN s.lo AND s.hi WHERE p.trip_id IS NULL GROUP BY p.vehicle_id) b ON a.vehicle_id = b.vehicle_id"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Metres between two points on a sphere of 6 371 km."""
    return f"(2 * 6371000 * asin(sqrt(power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2))))"


@stated
def haversine_distance(d: Spark) -> str:
    """Metres from a fixed point."""
    return f"SELECT vec_id, round({haversine('lat', 'lon', '56.8790', '14.8059')}, 2) AS metres FROM (SELECT vec_id, 56.8 + {d.element('embedding', 1)} / 10 AS lat, 14.8 + {d.element('embedding', 2)} / 10 AS lon FROM {{embeddings}}) x"


def _visits(d: Spark, radius: int = 50) -> str:
    by = "PARTITION BY vehicle_id, stop ORDER BY header_s, event_id"
    return f"""
    SELECT vehicle_id, stop, run, min(header_s) AS start_s, max(header_s) AS end_s, count(*) AS n FROM (
        SELECT *, sum(turned) OVER ({by}) AS run FROM (
            SELECT *, CASE WHEN inside IS DISTINCT FROM lag(inside) OVER ({by}) THEN 1 ELSE 0 END AS turned FROM (
                SELECT vehicle_id, stop, header_s, event_id, distance_m <= {radius} AS inside FROM {{pings}}) a) b) c
    WHERE inside GROUP BY vehicle_id, stop, run"""


REFERENCE_S = 1705320000


@stated
def passage_visits(d: Spark) -> str:
    """Visits within 50 m as islands of consecutive pings, and which lies nearest the scheduled time."""
    return f"SELECT vehicle_id, stop, cast(run AS bigint) AS run, start_s, end_s, n, row_number() OVER (PARTITION BY vehicle_id, stop ORDER BY abs(start_s - {REFERENCE_S}), start_s) = 1 AS nearest FROM ({_visits(d)}) v"


def _passages(d: Spark) -> str:
    near = f"(SELECT *, row_number() OVER (PARTITION BY vehicle_id, stop ORDER BY abs(start_s - {REFERENCE_S}), start_s) AS rn FROM ({_visits(d)}) v) n"
    return f"""
    SELECT n.vehicle_id, n.stop, n.end_s AS last_in, min(p.header_s) AS first_out, min(p.header_s) - n.end_s AS width_s, {d.double('n.end_s + min(p.header_s)')} / 2 - {REFERENCE_S} AS offset_s
    FROM {near} LEFT JOIN {{pings}} p ON p.vehicle_id = n.vehicle_id AND p.stop = n.stop AND p.header_s > n.end_s WHERE n.rn = 1 GROUP BY n.vehicle_id, n.stop, n.end_s"""


@stated(plainly=_passages)
def passage_estimate_offsets(d: Spark) -> str:
    """The passage: last ping inside and first outside after, their middle, and its offset from the reference."""
    near = f"(SELECT vehicle_id, stop, min(struct(abs(start_s - {REFERENCE_S}), start_s, end_s)).end_s AS end_s FROM ({_visits(d)}) v GROUP BY vehicle_id, stop) n"
    times = "(SELECT vehicle_id, stop, header_s, lead(header_s) OVER (PARTITION BY vehicle_id, stop ORDER BY header_s) AS next_s FROM (SELECT DISTINCT vehicle_id, stop, header_s FROM {pings}) t) p"
    return f"""
    SELECT n.vehicle_id, n.stop, n.end_s AS last_in, p.next_s AS first_out, p.next_s - n.end_s AS width_s, {d.double('n.end_s + p.next_s')} / 2 - {REFERENCE_S} AS offset_s
    FROM {near} JOIN {times} ON p.vehicle_id = n.vehicle_id AND p.stop = n.stop AND p.header_s = n.end_s"""


def _by_radius(d: Spark) -> str:
    return " UNION ALL ".join(f"SELECT {r} AS radius_m, vehicle_id, stop, count(*) AS visits, cast(sum(n) AS bigint) AS pings, min(start_s) AS first_in, max(end_s) AS last_in FROM ({_visits(d, r)}) v GROUP BY vehicle_id, stop" for r in RADII)


#: The radii of the passage studies, in metres.
RADII = (25, 50, 100)


@stated(plainly=_by_radius)
def passages_by_radius(d: Spark) -> str:
    """Visits within 25, 50 and 100 m per vehicle and stop, all radii in one pass over ordered pings."""
    by = "PARTITION BY vehicle_id, stop, radius_m ORDER BY header_s, event_id"
    return f"""
    SELECT radius_m, vehicle_id, stop, count(DISTINCT run) AS visits, count(*) AS pings, min(header_s) AS first_in, max(header_s) AS last_in FROM (
        SELECT *, sum(turned) OVER ({by}) AS run FROM (
            SELECT *, CASE WHEN inside IS DISTINCT FROM lag(inside) OVER ({by}) THEN 1 ELSE 0 END AS turned FROM (
                SELECT vehicle_id, stop, header_s, event_id, r AS radius_m, distance_m <= r AS inside FROM (SELECT *, explode(array{RADII}) AS r FROM {{pings}}) e) a) b) c
    WHERE inside GROUP BY radius_m, vehicle_id, stop"""


@stated
def classification_matrix(d: Spark) -> str:
    """Held class against a second estimate's class."""
    return f"SELECT held_class, other_class, count(*) AS n FROM (SELECT {m.delay_class('delay_s')} AS held_class, {m.delay_class('delay_s + l_partkey % 41 - 20')} AS other_class FROM {{stop_events}} WHERE status = 'observed') x GROUP BY held_class, other_class"


@stated
def funnel_reconciliation(d: Spark) -> str:
    """Counts that may only fall from stage to stage."""
    return f"""
    SELECT scheduled, in_scope, non_final, eligible, observed, scheduled >= in_scope AND in_scope >= non_final AND non_final >= eligible AND eligible >= observed AS monotone
    FROM (SELECT count(*) AS scheduled, {m.count_if('in_scope')} AS in_scope, {m.count_if("in_scope AND stop_position <> 'final'")} AS non_final, {m.count_if(f"in_scope AND stop_position <> 'final' AND {m.ELIGIBLE}")} AS eligible, {m.count_if(m.OBSERVED)} AS observed FROM {{stop_events}}) x"""


@stated
def uniqueness_check(d: Spark) -> str:
    """Keys that occur more than once, per relation."""
    return """
    SELECT 'stop_events' AS relation_name, count(*) AS duplicates FROM (SELECT trip_id, stop_sequence FROM {stop_events} GROUP BY trip_id, stop_sequence HAVING count(*) > 1) a
    UNION ALL SELECT 'lineitem by line number', count(*) FROM (SELECT l_orderkey, l_linenumber FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) b
    UNION ALL SELECT 'feed by trip, stop and time', count(*) FROM (SELECT trip_id, stop_sequence, header_s FROM {feed} GROUP BY trip_id, stop_sequence, header_s HAVING count(*) > 1) c"""


@stated
def never_seen_trips(d: Spark) -> str:
    """Scheduled trips that the feed never shows."""
    return "SELECT c.c_custkey AS trip_id FROM {customer} c LEFT ANTI JOIN {feed} f ON c.c_custkey = f.trip_id" if d.name == "spark" else "SELECT c.c_custkey AS trip_id FROM {customer} c ANTI JOIN {feed} f ON c.c_custkey = f.trip_id"


@stated
def retained_stale(d: Spark) -> str:
    """Rows whose held value lies more than 60, 120 and 300 seconds in the past."""
    return f"SELECT {m.count_if('header_s - held_s > 60')} AS over_60, {m.count_if('header_s - held_s > 120')} AS over_120, {m.count_if('header_s - held_s > 300')} AS over_300 FROM {{feed}}"


@stated
def marker_transitions(d: Spark) -> str:
    """How the marker changes between consecutive rows of a trip and stop."""
    mark = "CASE WHEN uncertainty_present THEN 'marked' ELSE 'plain' END"
    return f"SELECT before_mark, mark, count(*) AS n FROM (SELECT {mark} AS mark, lag({mark}) {BY_STOP} AS before_mark FROM {{feed}}) x WHERE before_mark IS NOT NULL GROUP BY before_mark, mark"
