"""Service-day time against published golden values."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from stoptide.functions import timeutil as t


def test_scheduled_epoch(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = [("2026-09-07", "00:00:00"), ("2026-03-29", "02:30:00"), ("2026-09-07", "25:08:00"), ("2026-09-07", ""), ("2026-09-07", None), ("2026-09-07", "7:00"), (None, "01:00:00")]
    df = spark.createDataFrame(rows, "d string, h string").select(t.scheduled_epoch(F.col("d").cast("date"), F.col("h")).alias("s"))
    got = [r["s"] for r in df.collect()]
    assert got[0] == 1788732000 and got[2] == 1788732000 + 25 * 3600 + 480
    assert got[1] == 1774778400 - 43200 + 9000  # noon is at 10:00 UTC that day
    assert got[3:] == [None] * 4


def test_ambiguous(spark):
    df = spark.createDataFrame([("26:20:00",), ("25:15:00",), ("02:30:00",), (None,)], "h string")
    assert [r[0] for r in df.select(t.ambiguous_flag(F.col("h"), False, True)).collect()] == [True, False, False, False]
    assert [r[0] for r in df.select(t.ambiguous_flag(F.col("h"), True, False)).collect()] == [False, False, True, False]


@pytest.mark.parametrize(
    ("day", "last", "hours"),
    [(date(2026, 9, 6), "26:00:00", [0, 1, 2, 3, 4]), (date(2026, 9, 7), "25:08:00", [0, 1, 2, 3]), (date(2026, 9, 7), "20:00:00", []), (date(2026, 3, 28), "26:30:00", [0, 1, 3, 4, 5]), (date(2025, 10, 25), "24:30:00", [0, 1, 2])],
)
def test_next_day_hours(day, last, hours):
    assert t.next_day_hours(day, last) == hours


def test_clock_changes():
    assert t.local_hours(date(2026, 3, 29)) == [h for h in range(24) if h != 2]
    assert t.local_hours(date(2026, 10, 25)) == list(range(24))
    assert t.changes_clock(date(2026, 3, 29)) and not t.changes_clock(date(2026, 9, 7))


def test_hours_and_dates():
    assert t.hour_spec("0-3,5,7-9") == [0, 1, 2, 3, 5, 7, 8, 9]
    with pytest.raises(ValueError):
        t.hour_spec("24")
    floor = date(2026, 9, 1)
    assert t.dates_to_build(set(), date(2026, 9, 4), floor) == [date(2026, 9, 1), date(2026, 9, 2)]
    assert len(t.dates_to_build(set(), date(2026, 9, 30), floor)) == 7
    assert t.dates_to_build({floor}, date(2026, 9, 3), floor) == []
