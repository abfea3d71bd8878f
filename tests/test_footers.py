"""Counts, dates, completeness and drift from footers and folder names."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from stoptide.sources import footers as f
from stoptide.sources.warehouse import read_table, write_partition


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "w" / "trips")
    df = spark.range(100).select("id", (F.col("id") * 1.5).alias("x"), F.expr("date_add(DATE '2024-01-01', int(id % 3))").alias("service_date"))
    write_partition(df, path)
    return path


def test_counts_and_dates(spark, table):
    files = f.footers(spark, table)
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert {r["service_date"]: r["n_rows"] for r in f.partition_counts(files).collect()} == {date(2024, 1, 1): 34, date(2024, 1, 2): 33, date(2024, 1, 3): 33}
    assert f.dates_present(spark, table) == [date(2024, 1, k) for k in (1, 2, 3)] and f.dates_present(spark, table + "-none") == []
    whole = f.footers(spark, table, whole_files=True)
    assert sorted(map(str, whole.collect())) == sorted(map(str, files.collect()))


def test_completeness(spark, table, tmp_path):
    root, days = str(tmp_path / "w"), [date(2024, 1, k) for k in (1, 2, 3)]
    assert f.check_complete(spark, root, ["trips"], days) == 100
    with pytest.raises(ValueError, match=r"5 of 8 partitions are missing: stops 2024-01-01, .*stops 2024-01-04, trips 2024-01-04$"):
        f.check_complete(spark, root, ["trips", "stops"], [*days, date(2024, 1, 4)])
    assert f.completeness(spark, str(tmp_path / "none"), ["trips"], days).filter("present").count() == 0


def test_drift_lists_every_file(spark, table):
    f.check_schemas(f.footers(spark, table))
    other = spark.range(5)
    other.select(F.col("id").alias("x"), F.col("id")).write.parquet(f"{table}/service_date=2024-01-04")  # x by another type, and another order
    other.select("id", F.lit(1.0).alias("x")).withColumn("y", F.lit("new")).write.parquet(f"{table}/service_date=2024-01-05")
    other.select("id").write.parquet(f"{table}/service_date=2024-01-06")
    other.select(F.lit(2.0).alias("x"), "id").write.parquet(f"{table}/service_date=2024-01-07")  # another order only
    with pytest.raises(ValueError, match="partitions of") as e:
        read_table(spark, table)
    told = {line.split("service_date=")[1][:10]: line.rpartition(": ")[2] for line in str(e.value).splitlines()[1:]}
    assert set(told) == {"2024-01-04", "2024-01-05", "2024-01-06"}
    assert told["2024-01-04"] == "x is int64, not double" and told["2024-01-05"] == "y is string, not there" and told["2024-01-06"] == "x is missing, not double"


def test_files_without_a_footer(spark, table, tmp_path):
    (tmp_path / "w" / "trips" / "service_date=2024-01-01" / "broken.parquet").write_bytes(b"PAR1 nothing")
    files = f.footers(spark, table)
    assert files.filter("problem IS NOT NULL").count() == 1
    with pytest.raises(ValueError, match="broken"):
        f.partition_counts(files)
    with pytest.raises(ValueError, match="broken"):
        read_table(spark, table)
