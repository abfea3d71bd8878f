"""Unique keys, lookups, traces, cells, and schedule files with odd line ends."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stoptide.operators.keys import assert_unique, lookup
from stoptide.operators.presence import trace
from stoptide.sources import realtime
from stoptide.sources.gtfs import read_schedule_file
from stoptide.sources.warehouse import cells


def test_lookups_do_not_fan_out(spark):
    rows = spark.createDataFrame([("t", None, 1), ("t", None, 1), ("u", "d", 2), ("w", "d", 9)], "trip string, day string, k int")
    details = spark.createDataFrame([("t", None, "a"), ("u", "d", "b"), ("x", "d", "c"), ("x", "d", "d")], "trip string, day string, v string")
    got = lookup(rows, details, ["trip", "day"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("t", None, 1, "a"), ("t", None, 1, "a"), ("u", "d", 2, "b"), ("w", "d", 9, None)], key=str)
    with pytest.raises(ValueError, match=r"details isn't unique on trip, day: 1 keys .* trip=t, day=None 2 times"):
        lookup(rows, details.union(details.limit(1)), ["trip", "day"])
    assert_unique(details.limit(0), ["trip"], "nothing")


def test_trace(spark):
    rows = spark.createDataFrame([("a", ts, s) for ts, x in ((1, [1, 2]), (2, [2]), (3, [1, 2])) for s in x] + [("b", 1, 1)], "trip_key string, ts bigint, stop_seq int")
    assert [tuple(r) for r in trace(rows, "a").collect()] == [(1, 1, "listed"), (1, 2, "listed"), (2, 1, "leaves"), (3, 1, "enters"), (3, 1, "stays to the end"), (3, 2, "stays to the end")]


def test_cells(spark):
    df = spark.createDataFrame([(2, True, 1.5, "x", date(2024, 1, 2), datetime(2024, 1, 2, 3), Decimal("4.00")), (1, None, float("nan"), None, None, None, None)], "k int, b boolean, d double, s string, day date, t timestamp_ntz, n decimal(10,2)")
    assert cells(df, ["k"]) == [["k", "b", "d", "s", "day", "t", "n"], [1, "", "", "", "", "", ""], [2, True, 1.5, "x", "2024-01-02", "2024-01-02T03:00:00", 4]]


def test_missing_hours_are_named(spark):
    files = spark.createDataFrame([(date(2024, 1, 1), 3, 10), (date(2024, 1, 1), 4, 0)], "service_date date, hour int, length bigint")
    found = realtime.hours_present(files, files, (3, 4))
    with pytest.raises(FileNotFoundError, match="1 hours are missing: 2024-01-01 04"):
        realtime.require_hours(found)
    realtime.require_hours(found.filter("hour = 3"))


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r\r\n"])
def test_line_ends_of_schedules(spark, tmp_path, end):
    lines = ["stop_id,stop_name,stop_lat,stop_lon,location_type", '007,"Main, ""north""",56.5,14.25,0', "8,End,,,"]
    (tmp_path / "stops.txt").write_bytes(end.join([*lines, ""]).encode())
    got = read_schedule_file(spark, str(tmp_path), "stops")
    assert got.columns == lines[0].split(",") and got.filter(F.col("location_type") == 0).count() == 1
    assert [tuple(r) for r in got.orderBy("stop_id").collect()] == [("007", 'Main, "north"', 56.5, 14.25, 0), ("8", "End", None, None, None)]
