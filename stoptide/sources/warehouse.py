"""The date-partitioned warehouse: idempotent writes, checked reads, ordered exports, run log."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.sources.footers import check_schemas, dates_present, footers

__all__ = ["TABLES", "cells", "check_schemas", "dates_present", "export_csv", "footers", "read_table", "same_rows", "stage", "violations", "write_partition"]

TABLES = ("trips", "stop_events", "routes", "stops", "feed_quality", "feed_gaps")


def write_partition(df: DataFrame, path: str, by: str = "service_date") -> None:
    """Replaces the partitions that ``df`` holds and no other; writing twice leaves one copy."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All partitions; raises ValueError naming every file whose columns or types differ from the first one's."""
    check_schemas(footers(spark, path), f"partitions of {path}")
    return spark.read.parquet(path)


def export_csv(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """One ordered CSV with header; for published tables, which are small."""
    df.orderBy(*(F.col(k).asc_nulls_last() for k in keys)).coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def cells(df: DataFrame, keys: Sequence[str]) -> list[list]:
    """Header and ordered rows as a spreadsheet takes them, by the columns' types: for published tables, which are small.

    Truth values stay truth values, numbers numbers (whole ones whole, NaN empty), dates and times ISO
    texts, all else text; a null is an empty text.
    """

    def cell(x):
        if x is None or isinstance(x, float) and x != x:
            return ""
        if isinstance(x, (bool, int, float)):
            return x
        if isinstance(x, Decimal):
            return int(x) if x == x.to_integral_value() else float(x)
        return x.isoformat() if hasattr(x, "isoformat") else str(x)

    ordered = df.orderBy(*(F.col(k).asc_nulls_last() for k in keys)).collect()
    return [list(df.columns), *([cell(x) for x in r] for r in ordered)]


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often; what was written is read back and compared."""
    return a.exceptAll(b).limit(1).count() == 0 and b.exceptAll(a).limit(1).count() == 0


def violations(df: DataFrame, rules: dict[str, str]) -> dict[str, int]:
    """How many rows break each rule, all in one pass; a null rule isn't broken."""
    row = df.agg(*(F.count_if(F.expr(f"NOT ({rule})")).alias(name) for name, rule in rules.items())).first()
    return row.asDict()


@contextmanager
def stage(log: str, name: str, **extra) -> Iterator[dict]:
    """Times a stage and appends one JSON line, also when it fails."""
    entry = {"stage": name, "started": datetime.now(timezone.utc).isoformat(), **extra}
    began = time.monotonic()
    try:
        yield entry
        entry["status"] = entry.get("status", "ok")
    except BaseException as e:
        entry |= {"status": "failed", "error": str(e)[:500]}
        raise
    finally:
        entry["seconds"] = round(time.monotonic() - began, 3)
        with open(log, "a", encoding="utf-8") as f:
            f.write(json.dumps(entry, default=str) + "\n")
