"""Sequence operators on small cases with known answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from stoptide.operators import sequences as s


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 20, None), (2, None, "z"), (2, 5, "y")], "k int, t int, v string")
    assert {tuple(r) for r in s.latest_per_key(df, ["k"], ["t"]).collect()} == {(1, 20, None), (2, 5, "y")}
    assert s.latest_per_key(df.limit(0), ["k"], ["t"]).count() == 0


def test_runs(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([None, None, "a", "a", None, "b"])], "k int, t int, v string")
    assert [r["run"] for r in s.with_runs(df, ["k"], ["t"], F.col("v")).orderBy("t").collect()] == [1, 1, 2, 2, 3, 4]


def test_gaps(spark):
    base = 1788732000
    df = spark.createDataFrame([(base + x,) for x in (1200, 1216, 1232, 14400, 14416, 14416)], "header_s long")
    got = {(r["kind"], r["gap_s"]) for r in s.feed_gaps(df, base, 1788818400).collect()}
    assert got == {("before_first", 1200), ("between", 13168), ("after_last", 71984)}
    assert s.feed_gaps(df.limit(0), base, base + 10).count() == 0


def test_gaps_across_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (0, 86390, 86410, 260000)], "header_s long")
    got = {(r["gap_start_s"], r["gap_end_s"]) for r in s.feed_gaps(df, 0, 260000).collect()}
    assert got == {(0, 86390), (86410, 260000)}


def test_drops(spark):
    def kinds(a, b):
        df = spark.createDataFrame([("t", 1, a), ("t", 2, b)], "trip_key string, ts int, stop_seqs array<int>")
        return sorted((r["stop_seq"], r["kind"]) for r in s.drop_events(df).collect())

    assert kinds([1, 2, 3], [2, 3]) == [(1, "clean")]
    assert kinds([1, 2, 3], [3]) == [(1, "multi_drop"), (2, "multi_drop")]
    assert kinds([1, 2, 3], [1, 3]) == [(2, "not_from_front")]


def test_passages(spark):
    def run(points):
        df = spark.createDataFrame([("t", 1, a, float(b)) for a, b in points], "trip string, stop_seq int, ts int, distance double")
        return [(r["first_in"], r["last_in"], r["first_out"]) for r in s.passages(df, 50).orderBy("first_in").collect()]

    assert run([(100, 80), (110, 30), (120, 20), (130, 25), (140, 90)]) == [(110, 130, 140)]
    assert run([(100, 80), (110, 90), (120, 70)]) == []
    assert run([(100, 20), (110, 80), (120, 25)]) == [(100, 100, 110), (120, 120, None)]


def test_held_summary(spark):
    df = spark.createDataFrame([("t", 1, a, b) for a, b in ((100, 150), (110, 140), (120, 120), (130, 120), (140, 120))], "trip string, stop_seq int, ts int, held int")
    r = s.held_summary(df).first()
    assert (r["t_cross"], r["value_at_cross"], r["changes_after"], r["drift"]) == (120, 120, 0, 0)


def test_one_file_per_time(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "b", 2), (1, "a", 1), (2, "c", 1)], "header_timestamp int, snapshot_file string, stop int")
    assert {tuple(r) for r in s.one_file_per_time(df).collect()} == {(1, "a", 1), (2, "c", 1)}


def test_presence_between_consecutive_snapshots(spark):
    from stoptide.operators.presence import drops, intervals, reappearances

    lists = {"a": [(10, [1, 2, 3]), (20, [2, 3]), (30, [3]), (40, [2, 3]), (50, [3]), (60, [2, 3]), (70, [])], "b": [(10, [1, 2, 3, 4]), (20, [1, 4]), (30, [4])], "c": [(5, [1])]}
    rows = [(t, ts, s) for t, x in lists.items() for ts, seqs in x for s in (seqs or [None])]
    df = spark.createDataFrame([*rows, *rows[:3], (None, 1, 1), ("a", None, 1)], "trip_key string, ts bigint, stop_seq int")
    stretches = intervals(df)
    plan = stretches._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(trip_key") == 1
    got = {(r["trip_key"], r["stop_seq"], r["first_i"], r["last_i"], r["first_ts"], r["last_ts"], r["next_ts"]) for r in stretches.collect()}
    assert {x for x in got if x[0] == "a"} == {("a", 1, 1, 1, 10, 10, 20), ("a", 2, 1, 2, 10, 20, 30), ("a", 2, 4, 4, 40, 40, 50), ("a", 2, 6, 6, 60, 60, 70), ("a", 3, 1, 6, 10, 60, 70)}
    gone = {(r["trip_key"], r["stop_seq"], r["last_ts"], r["first_ts"], r["kind"], r["n_together"]) for r in drops(stretches).collect()}
    assert gone == {("a", 1, 10, 20, "clean", 1), ("a", 2, 20, 30, "clean", 1), ("a", 2, 40, 50, "clean", 1), ("a", 2, 60, 70, "multi_drop", 2), ("a", 3, 60, 70, "multi_drop", 2), ("b", 2, 10, 20, "multi_drop", 2), ("b", 3, 10, 20, "multi_drop", 2), ("b", 1, 20, 30, "clean", 1)}
    assert {tuple(r) for r in reappearances(stretches).collect()} == {("a", 2, 40), ("a", 2, 60)}
    assert intervals(df.limit(0)).count() == 0
