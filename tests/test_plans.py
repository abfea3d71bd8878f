"""The physical plans: what is read how often, where one task sees all rows, and how sides meet."""

from __future__ import annotations

import re

import pytest

from stoptide.functions.dialect import SPARK
from stoptide.plans import daily, load_catalog
from stoptide.plans.engine import frame
from stoptide.sources.analogs import RELATIONS

SF = "/root/testdata/sf0.01"
#: How often a published table's query may read stop events' rows, and files in all.
READS = {"network_monthly": (1, 7), "route_monthly": (1, 10), "station_monthly": (1, 12), "category_monthly": (1, 11), "hour_monthly": (1, 5), "route_daily": (1, 7), "data_quality_daily": (1, 12)}


def plan_of(spark, name: str) -> str:
    return load_catalog()[name].build(spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(READS))
def test_tables_read_their_rows_once(spark, name):
    plan, (rows, files) = plan_of(spark, name), READS[name]
    assert len(re.findall(r"FileScan parquet \[l_", plan)) <= rows
    assert len(re.findall("FileScan", plan)) <= files
    assert "collect_list" not in plan


def test_windows_over_trips_need_no_shuffle_of_their_own(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as between large tables
    try:
        lines = plan_of(spark, "hour_monthly").split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    standing = next(i for i, x in enumerate(lines) if " Window " in x and "windowspecdefinition(service_date" in x)
    joined = next(i for i, x in enumerate(lines) if "SortMergeJoin [trip_id" in x)
    assert standing < joined and not any("Exchange" in x for x in lines[standing:joined])
    # the stop rows' side is shuffled once, by trip, for its own windows and for the join
    read = next(i for i, x in enumerate(lines) if "FileScan parquet [l_" in x)
    assert sum("Exchange" in x for x in lines[joined:read]) == 1


def test_no_query_pairs_all_rows_or_calls_python(spark):
    for name, q in sorted(load_catalog().items()):
        if q.build.__module__ != "stoptide.plans.engine":
            continue  # built with the DataFrame API; may store tables or decode files
        plan = plan_of(spark, name)
        assert "CartesianProduct" not in plan, name
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroups", plan), name


def test_single_task_windows_see_only_edges_of_days(spark):
    for name, q in sorted(load_catalog().items()):
        if q.build.__module__ != "stoptide.plans.engine":
            continue
        lines = plan_of(spark, name).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line and any(" Window " in x for x in lines[max(0, i - 3) : i]):
                assert re.search(r"day_#\d+L? (ASC|DESC)", lines[i - 1]), (name, lines[i - 1])


def test_scheduled_trips_are_estimated_with_their_days(spark):
    """Joins broadcast what is estimated to be small; the estimate of an explode is that of its input."""
    runs = frame(spark, SF, RELATIONS["runs"](SPARK)).select("trip_id", "service_date")
    size = int(str(runs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert runs.count() == 30 * spark.read.parquet(f"{SF}/customer.parquet").count()
    assert size >= 12 * runs.count()


def test_checks_across_tables_read_stored_departures(spark, monkeypatch):
    """The rows behind the published tables are made once and stored; no table reads stop events by itself."""
    made = []

    def kept(spark, sf_dir, text, relations=None):
        made.append((text, relations))
        return frame(spark, sf_dir, text, relations)

    monkeypatch.setattr(daily, "frame", kept)
    daily.table_consistency(spark, "/root/testdata/sf0.001")
    tables = made[len(daily.STORED) :]
    assert len(tables) == len(daily.TABLES)
    for text, relations in tables:
        plan = frame(spark, "/root/testdata/sf0.001", text, relations)._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet [l_" not in plan and "FileScan parquet [o_" not in plan


def test_latest_positions_are_those_of_all_dates_and_paired_by_month(spark):
    latest = frame(spark, SF, "SELECT month, station_id, max_by(lat, service_date) FILTER (WHERE lat IS NOT NULL) AS lat, max_by(lon, service_date) FILTER (WHERE lon IS NOT NULL) AS lon FROM {positions} GROUP BY month, station_id")
    got = frame(spark, SF, "SELECT month, station_id, lat, lon FROM {latest_positions}")
    assert sorted(map(str, got.collect())) == sorted(map(str, latest.collect()))
    assert "% 9" in plan_of(spark, "station_monthly") and not re.search(r"HashAggregate\(keys=\[month#\d+, service_date#\d+, station_id#\d+, lat", plan_of(spark, "station_monthly"))
