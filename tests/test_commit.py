"""Commits of several tables, and evidence."""

from __future__ import annotations

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from stoptide.sources import commit as c
from stoptide.sources import evidence as e
from stoptide.sources.scratch import Store

PAIR = ("trips", "stops")
DAY = date(2024, 1, 1)


def frames(spark, k):
    return {"trips": spark.range(k).withColumn("service_date", F.lit(DAY)), "stops": spark.range(2 * k).withColumn("k", F.lit(k))}


def test_a_commit_is_seen_whole(spark, tmp_path):
    root = str(tmp_path / "w")
    with pytest.raises(ValueError, match="no commit"):
        c.read_committed(spark, root, "trips")
    assert c.commit(spark, root, DAY, frames(spark, 3), PAIR) == 1
    assert c.commit(spark, root, date(2024, 1, 2), frames(spark, 5), PAIR) == 2
    assert c.commit(spark, root, DAY, frames(spark, 4), PAIR) == 3
    got = {r[0]: r[1] for r in c.read_committed(spark, root, "trips").groupBy("service_date").count().collect()}
    assert got == {DAY: 4, date(2024, 1, 2): 5} and c.read_committed(spark, root, "stops").columns == ["id", "k", "service_date"]
    assert c.read_committed(spark, root, "trips", 1).count() == 3
    assert c.sweep(spark, root) == 2 and c.read_committed(spark, root, "stops").count() == 18


def test_a_failure_between_tables_leaves_the_old_state(spark, tmp_path):
    root = str(tmp_path / "w")
    c.commit(spark, root, DAY, frames(spark, 3), PAIR)
    broken = frames(spark, 9) | {"stops": spark.range(3).select(F.raise_error(F.lit("lost")).alias("x"))}
    with pytest.raises(Exception, match="lost"):
        c.commit(spark, root, DAY, broken, PAIR)
    assert c.read_committed(spark, root, "trips").count() == 3 and c.read_committed(spark, root, "stops").count() == 6
    with pytest.raises(ValueError, match=r"missing \['stops'\]"):
        c.commit(spark, root, DAY, {"trips": spark.range(1)}, PAIR)
    assert c.sweep(spark, root) >= 1 and c.state(spark, root)[0] == 1


def test_two_commits_at_once_both_count(spark, tmp_path, monkeypatch):
    root, rename, raced = str(tmp_path / "w"), Store.rename, []

    def late(self, old, new):
        if not raced:
            raced.append(1)
            c.commit(spark, root, date(2024, 1, 2), frames(spark, 7), PAIR)
        return rename(self, old, new)

    monkeypatch.setattr(Store, "rename", late)
    assert c.commit(spark, root, DAY, frames(spark, 3), PAIR) == 2
    assert c.read_committed(spark, root, "trips").count() == 10


def test_digests(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"), F.create_map(F.lit("k"), "id").alias("m"))
    said = e.table_digest(df)
    assert said == e.table_digest(df.repartition(7)) == e.table_digest(df.orderBy(F.desc("id")).select("m", "s", "x", "id"))
    edits = [df.withColumn("x", F.when(F.col("id") == 5, 0.5).otherwise(F.col("x"))), df.union(df.limit(1)), df.limit(999), df.withColumnRenamed("x", "y"), df.withColumn("s", F.coalesce("s", F.lit("")))]
    assert len({said, *map(e.table_digest, edits)}) == 6
    swap = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert e.table_digest(swap.limit(1)) != e.table_digest(swap.select(F.col("b").alias("a"), F.col("a").alias("b")).limit(1))
    assert e.table_digest(df.limit(0)) == e.table_digest(df.limit(0).repartition(3))


def test_evidence(spark, tmp_path):
    folder = str(tmp_path / "ev.1")
    df = spark.range(5).select("id", F.lit("a,b").alias("t"))
    said = e.write_evidence(spark, folder, {"one": (df, ["id"]), "two": (df.limit(2), ["id"])}, {"month": "2024-01"})
    file = next((tmp_path / "ev.1" / "one").glob("part-*.csv"))
    assert said["results"]["one"]["sha256"] == [hashlib.sha256(file.read_bytes()).hexdigest()] and said["results"]["two"]["rows"] == 2
    assert e.check_evidence(spark, folder) == [] and said["changed"] == []
    file.with_name(f".{file.name}.crc").unlink()  # else Hadoop itself refuses the edited file
    file.write_text(file.read_text().replace("3,", "4,"))
    assert e.check_evidence(spark, folder) == ["one"]
    assert e.write_evidence(spark, folder, {"one": (df.filter("id > 0"), ["id"])})["changed"] == ["one"]
