"""What Parquet files hold, by their footers and folder names: counts, dates and schemas without reading data.

The files are listed by Spark; their footers are read on the executors, a few kilobytes a file, and form
a relation (a row for each file). Counting, completeness and drift are queries over that relation.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.sources.scratch import Store

FOOTER_SCHEMA = "path string, n_rows bigint, n_row_groups int, columns array<struct<name:string,type:string>>, problem string"
_COLUMNS = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))


def _local(uri: str) -> str:
    """The form of a path that Arrow's own file systems read."""
    return "file:///" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri


def footers(spark: SparkSession, paths: str | Sequence[str], whole_files: bool = False, pattern: str = "*.parquet") -> DataFrame:
    """(path, service_date, length, n_rows, n_row_groups, columns, problem) of each file under the paths.

    ``service_date`` is that of a folder ``service_date=...`` above the file, or null. A file without a
    readable footer is a row with ``problem``. ``whole_files`` reads files through Spark, for stores that
    Arrow can't open. Hidden and empty files aren't listed.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(paths if isinstance(paths, str) else list(paths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, path in enumerate(batch.column(0).to_pylist()):
                row = {"path": path, "n_rows": None, "n_row_groups": None, "columns": None, "problem": None}
                try:
                    if whole_files:
                        meta = pq.read_metadata(io.BytesIO(batch.column(1)[k].as_py()))
                    else:
                        store, inner = fs.FileSystem.from_uri(_local(path))
                        with store.open_input_file(inner) as f:
                            meta = pq.read_metadata(f)
                    schema = meta.schema.to_arrow_schema()
                    row |= {"n_rows": meta.num_rows, "n_row_groups": meta.num_row_groups, "columns": [{"name": x.name, "type": str(x.type)} for x in schema]}
                except (OSError, ValueError, pa.ArrowException) as e:
                    row["problem"] = f"{type(e).__name__}: {e}"[:200]
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("n_rows", pa.int64()), ("n_row_groups", pa.int32()), ("columns", _COLUMNS), ("problem", pa.string())]))

    read = found.select("path", *(["content"] if whole_files else [])).mapInArrow(run, FOOTER_SCHEMA)
    day = F.try_to_date(F.nullif(F.regexp_extract("path", r"/service_date=([^/]+)/", 1), F.lit("")))
    return read.withColumn("service_date", day)


def dates_present(spark: SparkSession, path: str) -> list[date]:
    """The dates of a table's folders, in order; no file is opened. Other folders are passed over."""
    out = []
    for name in Store(spark, path).names(path):
        key, _, value = name.partition("=")
        if key == "service_date":
            try:
                out.append(date.fromisoformat(value))
            except ValueError:
                continue
    return out


def partition_counts(files: DataFrame) -> DataFrame:
    """(service_date, n_files, n_rows) from footers; ValueError names the files that couldn't be read."""
    bad = [r["path"] for r in files.filter("problem IS NOT NULL").select("path").orderBy("path").limit(20).collect()]
    if bad:
        raise ValueError(f"no readable footer: {', '.join(bad)}")
    return files.groupBy("service_date").agg(F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"))


def completeness(spark: SparkSession, root: str, tables: Sequence[str], dates: Sequence[date], whole_files: bool = False) -> DataFrame:
    """(table_name, service_date, n_files, n_rows, present) of every expected table and date, from folder names and footers."""
    expected = spark.createDataFrame([(t, d) for t in tables for d in dates], "table_name string, service_date date")
    there = [t for t in tables if Store(spark, root).exists(f"{root}/{t}")]
    if not there:
        return expected.select("*", F.lit(0).cast("long").alias("n_files"), F.lit(0).cast("long").alias("n_rows"), F.lit(False).alias("present"))
    files = footers(spark, [f"{root}/{t}" for t in there], whole_files).withColumn("table_name", F.regexp_extract("path", r"/([^/]+)/service_date=", 1))
    found = files.filter("problem IS NULL").groupBy("table_name", "service_date").agg(F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"))
    out = expected.join(found, ["table_name", "service_date"], "left")
    return out.select("table_name", "service_date", F.coalesce("n_files", F.lit(0)).alias("n_files"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.col("n_files").isNotNull().alias("present"))


def check_complete(spark: SparkSession, root: str, tables: Sequence[str], dates: Sequence[date]) -> int:
    """The number of rows of all tables and dates; ValueError lists every table and date that is missing."""
    found = completeness(spark, root, tables, dates).orderBy("table_name", "service_date").collect()
    gone = [f"{r['table_name']} {r['service_date']}" for r in found if not r["present"]]
    if gone:
        raise ValueError(f"{len(gone)} of {len(found)} partitions are missing: {', '.join(gone)}")
    return sum(r["n_rows"] for r in found)


def schema_drift(files: DataFrame) -> DataFrame:
    """(path, name, expected, found): every column in which a file differs from the first file, by path; order doesn't count.

    ``expected`` or ``found`` is null where a column is missing. Only the first file's columns come to the driver.
    """
    known = files.filter("problem IS NULL").withColumn("_have", F.map_from_entries("columns"))
    first = known.agg(F.min(F.struct("path", "columns")).alias("f")).first()["f"]
    columns = first["columns"] if first else []
    wanted = F.map_from_arrays(F.array(*(F.lit(c["name"]) for c in columns)).cast("array<string>"), F.array(*(F.lit(c["type"]) for c in columns)).cast("array<string>"))
    names = F.array_union(F.map_keys(wanted), F.map_keys("_have"))
    each = known.select("path", "_have", F.explode(names).alias("name"))
    both = each.select("path", "name", F.try_element_at(wanted, F.col("name")).alias("expected"), F.try_element_at(F.col("_have"), F.col("name")).alias("found"))
    return both.filter(~F.col("expected").eqNullSafe(F.col("found")))


def check_schemas(files: DataFrame, what: str = "files") -> None:
    """ValueError that lists every file and column in which schemas differ, types too, and every file without a footer."""
    bad = [f"{r['path']}: {r['problem']}" for r in files.filter("problem IS NOT NULL").orderBy("path").collect()]
    for r in schema_drift(files).groupBy("path").agg(F.array_sort(F.collect_list(F.concat("name", F.lit(" is "), F.coalesce("found", F.lit("missing")), F.lit(", not "), F.coalesce("expected", F.lit("there"))))).alias("d")).orderBy("path").collect():
        bad.append(f"{r['path']}: {'; '.join(r['d'])}")
    if bad:
        raise ValueError(f"{what} differ:\n" + "\n".join(bad))
