"""Evidence of results: digests of tables that don't depend on order, files' hashes, and a bundle of both.

A table's digest adds the hashes of its rows, so every task sums what it reads and one small row meets
another; equal rows count as often as they occur. Files are hashed where they are read.
"""

from __future__ import annotations

import hashlib
import json
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.sources.scratch import Store
from stoptide.sources.warehouse import export_csv


def row_hash(df: DataFrame, seed: int) -> Column:
    """A hash of a row's values by name of column, nulls told from other values; maps by their sorted entries."""
    parts: list[Column] = [F.lit(seed)]
    for name in sorted(df.columns):
        kind = dict(df.dtypes)[name]
        c = F.array_sort(F.map_entries(f"`{name}`")) if kind.startswith("map<") else F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = c + F.lit(0.0)  # -0.0 is 0.0
        parts += [c, c.isNull()]
    return F.xxhash64(*parts)


def table_digest(df: DataFrame) -> str:
    """SHA-256 over the columns' names and types, the number of rows, and two sums of row hashes."""
    sums = df.agg(F.count("*").alias("n"), *(F.sum(row_hash(df, seed).cast("decimal(38,0)")).alias(f"s{seed}") for seed in (1, 2))).first()
    told = [sorted(df.dtypes), sums["n"], *(str(int(sums[f"s{k}"] or Decimal(0))) for k in (1, 2))]
    return hashlib.sha256(json.dumps(told).encode()).hexdigest()


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, sha256) of every file under a path; ``file`` is its place below the path."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # the listed path may be spelt with a scheme that the argument lacks
    below = F.regexp_extract("path", "/" + path.rstrip("/").rpartition("/")[2].replace(".", r"\.") + "/(.*)$", 1)
    return found.select(below.alias("file"), "length", F.sha2("content", 256).alias("sha256"))


def write_evidence(spark: SparkSession, folder: str, results: dict[str, tuple[DataFrame, list[str]]], facts: dict | None = None) -> dict:
    """One ordered CSV a result, and ``evidence.json`` with facts, rows, digests and the SHA-256 of every CSV; returns what it says.

    ``results`` has by name a published table, which is small, and its keys. A digest that is already
    there and differs isn't overwritten silently: it is told under ``changed``.
    """
    store, out = Store(spark, folder), {"facts": facts or {}, "results": {}}
    before = json.loads(store.read(f"{folder}/evidence.json"))["results"] if store.exists(f"{folder}/evidence.json") else {}
    for name, (df, keys) in sorted(results.items()):
        export_csv(df, f"{folder}/{name}", keys)
        out["results"][name] = {"columns": df.columns, "rows": df.count(), "digest": table_digest(df)}
        files = file_hashes(spark, f"{folder}/{name}").filter("file LIKE '%.csv'").orderBy("file").collect()
        out["results"][name]["sha256"] = [r["sha256"] for r in files]
    out["changed"] = sorted(n for n, r in out["results"].items() if n in before and before[n]["digest"] != r["digest"])
    if store.exists(f"{folder}/evidence.json"):
        store.delete(f"{folder}/evidence.json")
    store.write(f"{folder}/evidence.json", json.dumps(out, indent=1, sort_keys=True))
    return out


def check_evidence(spark: SparkSession, folder: str) -> list[str]:
    """The results whose files are no longer those that ``evidence.json`` names."""
    said = json.loads(Store(spark, folder).read(f"{folder}/evidence.json"))["results"]
    found = {n: [r["sha256"] for r in file_hashes(spark, f"{folder}/{n}").filter("file LIKE '%.csv'").orderBy("file").collect()] for n in said}
    return sorted(n for n in said if found[n] != said[n]["sha256"])
