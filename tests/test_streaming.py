"""Streams over the events in several batches against the batch definition."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stoptide.streaming.state import ROCKSDB, hourly, latest_values

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events in five files, in order of time, and one far later row that moves the watermark to the end."""
    events = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("timestamp").alias("event_time"), "user_id", "event_id", F.floor("value").cast("long").alias("value"))
    path = str(tmp_path_factory.mktemp("stream"))
    n = events.count()
    ranked = events.withColumn("k", F.row_number().over(Window.orderBy("event_time")) * 5 / (n + 1)).withColumn("k", F.floor("k")).cache()
    for k in range(5):
        ranked.filter(F.col("k") == k).drop("k").coalesce(1).write.mode("append").parquet(path)
    end = spark.sql("SELECT TIMESTAMP '2030-01-01' AS event_time, -1L AS user_id, -1L AS event_id, 0L AS value")
    end.coalesce(1).write.mode("append").parquet(path)
    end.coalesce(1).write.mode("append").parquet(path)  # a timer fires in the batch after the watermark's
    return path, events


def run(spark, make, path, name, tmp_path):
    schema = "event_time timestamp, user_id bigint, event_id bigint, value bigint"
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(path)
    q = make(rows).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None and len([p for p in q.recentProgress if p["numInputRows"]]) >= 5
    return spark.table(name).filter("coalesce(user_id, 0) <> -1") if "user_id" in spark.table(name).columns else spark.table(name)


def test_latest_values_equal_the_batch(spark, parts, tmp_path):
    path, events = parts
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        got = run(spark, lambda r: latest_values(r, ["user_id"], "value", "event_id", silent_s=40 * 86400), path, "latest", tmp_path)
        got = sorted(tuple(r) for r in got.select("user_id", "last_seen", "tie", "value", "n_rows").collect())
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    best = F.max(F.struct("event_time", "event_id", "value")).alias("l")
    want = events.groupBy("user_id").agg(best, F.count("*").alias("n")).select("user_id", "l.event_time", "l.event_id", "l.value", "n")
    assert got == sorted(tuple(r) for r in want.collect()) and got


def test_silent_keys_are_told_and_start_anew(spark, parts, tmp_path):
    path, events = parts
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        away = "NOT (user_id < 5 AND user_id >= 0 AND day(event_time) BETWEEN 6 AND 20)"  # for more than a batch
        got = run(spark, lambda r: latest_values(r.filter(away), ["user_id"], "value", "event_id", silent_s=3600), path, "silent", tmp_path).collect()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    users = [r["user_id"] for r in got]
    assert sum(r["n_rows"] for r in got) == events.filter(away).count() and {u for u in users if users.count(u) == 2} == set(range(5)) and len(users) == len(set(users)) + 5


def test_hours_equal_the_batch_and_late_rows_drop(spark, parts, tmp_path):
    path, events = parts
    got = run(spark, lambda r: hourly(r.filter("user_id >= 0 OR event_time > TIMESTAMP '2029-01-01'")), path, "hours", tmp_path).filter("window_start < TIMESTAMP '2029-01-01'")
    want = hourly(events)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    late = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:01' AS event_time, 1L AS user_id, 9L AS event_id, 0L AS value")
    again = str(tmp_path / "late")
    # rows are measured by the watermark of the batch before the last
    for df in (events.coalesce(1), late.withColumn("event_time", F.lit("2031-01-01").cast("timestamp")), late, late):
        df.coalesce(1).write.mode("append").parquet(again)
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(again)
    q = hourly(rows).writeStream.format("memory").queryName("late").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    first = spark.table("late").orderBy("window_start").first()
    assert first["n_rows"] == want.orderBy("window_start").first()["n_rows"] and spark.table("late").count() == want.count()
