"""Schedules from CSV, the warehouse, and the feed as a stream."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from stoptide.sources import gtfs, warehouse
from stoptide.streaming import feed


def test_csv_by_name_with_quotes(spark, tmp_path):
    (tmp_path / "stops.txt").write_text('stop_id,stop_name,stop_lat,extra\n00123,"A ""b"", c",56.5,x\n9,,oops,\n')
    got = gtfs.read_schedule_file(spark, str(tmp_path), "stops").collect()
    assert got[0]["stop_id"] == "00123" and got[0]["stop_name"] == 'A "b", c' and got[0]["stop_lat"] == 56.5
    assert got[1]["stop_name"] is None and got[1]["stop_lat"] is None


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r\r\n"])
def test_csv_line_ends(spark, tmp_path, end):
    (tmp_path / "stops.txt").write_bytes(end.join(["stop_id,stop_name,stop_lat,location_type", '007,"a, b",1.5,1', "8,,,", '"9",x,2,0', ""]).encode())
    got = gtfs.read_schedule_file(spark, str(tmp_path), "stops")
    assert got.columns == ["stop_id", "stop_name", "stop_lat", "location_type"]
    assert sorted(map(tuple, got.collect())) == [("007", "a, b", 1.5, 1), ("8", None, None, None), ("9", "x", 2.0, 0)]


def test_categories_report_all_problems(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("route_id,category,town\n1,School routes,\n1,School routes,\n2,Nonsense,\n3,Other town lines,\n")
    with pytest.raises(ValueError, match="duplicate route 1") as e:
        gtfs.read_categories(spark, str(p))
    assert "unknown category of 2" in str(e.value) and "category of 3" in str(e.value)
    p.write_text("route_id,category,town\n1,School routes,\n3,Other town lines,Alvesta\n")
    assert gtfs.read_categories(spark, str(p)).count() == 2


def test_services_and_scope(spark):
    cal = spark.createDataFrame([("a", 1, 20260901, 20260930), ("b", 1, 20260901, 20260930), ("c", 0, 20260901, 20260930)], "service_id string, monday int, start_date int, end_date int")
    dates = spark.createDataFrame([("b", 20260907, 2), ("d", 20260907, 1), ("e", 20260908, 1)], "service_id string, date int, exception_type int")
    assert {r[0] for r in gtfs.active_services(cal, dates, 20260907, "monday").collect()} == {"a", "d"}
    trips = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "trip_id string")
    attr = spark.createDataFrame([("t1", "Home", 1), ("t2", "Other", 1)], "trip_id string, organization_name string, is_operator int")
    assert {r["trip_id"]: r["in_scope"] for r in gtfs.trip_scope(trips, attr, "Home").collect()} == {"t1": True, "t2": False, "t3": True}
    with pytest.raises(ValueError):
        gtfs.trip_scope(trips, attr.union(attr), "Home")
    flags = spark.createDataFrame([("1",), ("",), (None,), ("0",), ("x",)], "t string").select(gtfs.timing_flag(F.col("t")))
    assert [r[0] for r in flags.collect()] == [True, True, True, False, None]


def test_partitions_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "trips")
    one = spark.createDataFrame([(date(2026, 9, 1), 1), (date(2026, 9, 2), 2)], "service_date date, trip_id int")
    warehouse.write_partition(one, path)
    warehouse.write_partition(one.filter("trip_id = 2").withColumn("trip_id", F.lit(3)), path)
    warehouse.write_partition(one.filter("trip_id = 1"), path)
    back = warehouse.read_table(spark, path)
    assert {tuple(r) for r in back.select("service_date", "trip_id").collect()} == {(date(2026, 9, 1), 1), (date(2026, 9, 2), 3)}
    assert warehouse.dates_present(spark, path) == [date(2026, 9, 1), date(2026, 9, 2)]
    assert warehouse.same_rows(back, back) and not warehouse.same_rows(back, back.limit(1))
    one.filter("trip_id = 1").withColumn("trip_id", F.lit("x")).withColumn("new", F.lit(1)).write.mode("append").partitionBy("service_date").parquet(path)
    with pytest.raises(Exception):  # noqa: B017
        warehouse.read_table(spark, path)


def test_export_checks_and_log(spark, tmp_path):
    df = spark.createDataFrame([(2, None), (1, "a")], "k int, v string")
    warehouse.export_csv(df, str(tmp_path / "out"), ["k"])
    text = next((tmp_path / "out").glob("part-*.csv")).read_text().splitlines()
    assert text[0] == "k,v" and text[1] == "1,a"
    assert warehouse.violations(df, {"v set": "v IS NOT NULL", "k positive": "k > 0"}) == {"v set": 1, "k positive": 0}
    log = str(tmp_path / "log.jsonl")
    with warehouse.stage(log, "one"):
        pass
    with pytest.raises(KeyError), warehouse.stage(log, "two"):
        raise KeyError("x")
    assert [json.loads(x)["status"] for x in open(log)] == ["ok", "failed"]


def test_stream(spark, tmp_path):
    rows = [("2026-09-07 00:00:00", 1, 1, 10), ("2026-09-07 00:00:00", 1, 1, 10), ("2026-09-07 00:10:00", 1, 1, 20), ("2026-09-07 00:01:00", 2, 1, 5)]
    df = spark.createDataFrame(rows, "t string, trip_id int, stop_sequence int, held_s int").withColumn("event_time", F.to_timestamp("t")).drop("t")
    src = str(tmp_path / "src")
    df.write.parquet(src)

    def run(f, name):
        stream = spark.readStream.schema(df.schema).parquet(src)
        q = f(stream).writeStream.format("memory").queryName(name).outputMode("append" if name == "dedup" else "complete").option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name)

    assert run(feed.deduplicated, "dedup").count() == 3
    assert {(r["trip_id"], r["held_s"]) for r in run(feed.last_appearance, "latest").collect()} == {(1, 20), (2, 5)}
    assert run(feed.sessions, "sessions").count() == 3
