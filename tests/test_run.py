"""The daily run: what stops it, what warns, and what becomes visible."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from stoptide.run import PreflightError, daily_run, preflight, single_row
from stoptide.sources.commit import read_committed

DAYS = [date(2024, 1, k) for k in (1, 2, 3)]
QUALITY = "service_date date, out_of_scope_trips_in_feed bigint, schedule_mismatch_stop_events bigint, unmatched_realtime_trips bigint, first_snapshot string"
PAIR = ("trips", "feed_quality")


def builder(spark, figures):
    def build(day):
        if figures.get(day) == "broken":
            raise RuntimeError("no schedule")
        quality = single_row(spark, {"service_date": day, "out_of_scope_trips_in_feed": 0} | figures.get(day, {}), QUALITY)
        return {"trips": spark.range(day.day * 10), "feed_quality": quality}

    return build


def logged(log):
    return [json.loads(x) for x in open(log)]


def test_warnings_are_published(spark, tmp_path):
    root, log, gone = str(tmp_path / "w"), str(tmp_path / "log"), []
    figures = {DAYS[1]: {"schedule_mismatch_stop_events": 4}, DAYS[2]: {"unmatched_realtime_trips": None}}
    assert daily_run(spark, root, DAYS, builder(spark, figures), log, clean_up=gone.append, expected=PAIR) == list(zip(DAYS, ("ok", "warning", "ok"), strict=True))
    assert gone == DAYS and [x["rows"]["trips"] for x in logged(log)] == [10, 20, 30] and logged(log)[1]["warnings"] == {"schedule_mismatch_stop_events": 4}
    assert read_committed(spark, root, "trips").count() == 60


@pytest.mark.parametrize("fault", ["broken", {"out_of_scope_trips_in_feed": 1}])
def test_the_first_failure_stops_the_run(spark, tmp_path, fault):
    root, log, gone = str(tmp_path / "w"), str(tmp_path / "log"), []
    assert daily_run(spark, root, DAYS, builder(spark, {DAYS[1]: fault}), log, clean_up=gone.append, expected=PAIR) == [(DAYS[0], "ok"), (DAYS[1], "failed")]
    assert gone == DAYS[:1] and [x["status"] for x in logged(log)] == ["ok", "failed"]
    assert [r[0] for r in read_committed(spark, root, "feed_quality").select("service_date").distinct().collect()] == DAYS[:1]


def test_preflight_names_all_and_nothing_is_read(spark, tmp_path):
    def no_token():
        raise KeyError("token")

    checks = {"folder": lambda: True, "token": no_token, "room": lambda: False, "nothing to say": lambda: None}
    with pytest.raises(PreflightError, match=r"^token: 'token'; room$"):
        preflight(checks)
    with pytest.raises(PreflightError):
        daily_run(spark, str(tmp_path), DAYS, lambda day: pytest.fail("read"), str(tmp_path / "log"), checks)
    assert not (tmp_path / "log").exists()


def test_single_rows_are_typed(spark):
    row = single_row(spark, {"service_date": DAYS[0]}, QUALITY)
    assert dict(row.dtypes)["service_date"] == "date" and dict(row.dtypes)["first_snapshot"] == "string" and row.filter(F.col("first_snapshot").isNull()).count() == 1
    with pytest.raises(ValueError, match="typo"):
        single_row(spark, {"typo": 1}, QUALITY)
