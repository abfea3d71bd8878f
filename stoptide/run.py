"""The daily run: preflight, then date by date build, check, commit, count and clean up; the first failure stops it.

What a date is built from and where results go are the caller's functions and frames; this module
decides what counts as failed, what as a warning, and that nothing of a failed date becomes visible.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.sources.commit import commit, state
from stoptide.sources.footers import footers
from stoptide.sources.warehouse import TABLES, stage

#: Figures of feed_quality that stop a date if they aren't zero, and those that warn.
TRIPWIRES = ("out_of_scope_trips_in_feed",)
WARNINGS = ("schedule_mismatch_stop_events", "unmatched_realtime_trips")

Build = Callable[[date], dict[str, DataFrame]]


class PreflightError(RuntimeError):
    """Something that the run needs isn't there; nothing has been read."""


class TripwireError(RuntimeError):
    """A date's figures forbid publishing it."""


def preflight(checks: dict[str, Callable[[], object]]) -> None:
    """Runs every check and raises one PreflightError that names all that fail; a check fails by raising or by False."""
    failed = []
    for name, check in checks.items():
        try:
            if check() is False:
                failed.append(name)
        except Exception as e:  # noqa: BLE001  whatever a check raises is its finding
            failed.append(f"{name}: {e}")
    if failed:
        raise PreflightError("; ".join(failed))


def single_row(spark: SparkSession, values: dict, schema: str) -> DataFrame:
    """One typed row for a table such as feed_quality: nulls keep their column's type, dates are dates; unknown names are refused."""
    names = [x.split()[0] for x in schema.split(",")]
    if set(values) - set(names):
        raise ValueError(f"not in the schema: {sorted(set(values) - set(names))}")
    return spark.createDataFrame([tuple(values.get(n) for n in names)], schema)


def figures_of(quality: DataFrame, names: Sequence[str]) -> dict[str, int]:
    """The sums of the named columns that ``quality`` has; nulls count as zero."""
    here = [n for n in names if n in quality.columns]
    row = quality.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in here)).first() if here else None
    return {n: int(row[n]) for n in here}


def run_date(spark: SparkSession, root: str, day: date, build: Build, log: str, expected: Sequence[str] = TABLES) -> str:
    """Builds and commits one date and logs it; returns ok or warning, and raises what failed.

    A tripwire is looked at before anything is committed. Rows are counted from the footers of what was
    committed.
    """
    with stage(log, "transform", service_date=day.isoformat()) as entry:
        tables = build(day)
        figures = figures_of(tables["feed_quality"], (*TRIPWIRES, *WARNINGS)) if "feed_quality" in tables else {}
        if broken := {n: figures[n] for n in TRIPWIRES if figures.get(n)}:
            raise TripwireError(f"{broken} on {day}")
        entry["commit"] = commit(spark, root, day, tables, expected)
        versions = state(spark, root)[1]
        paths = {t: f"{root}/data/{t}/service_date={day}/version={versions[t][day.isoformat()]}" for t in expected}
        counted = footers(spark, list(paths.values())).groupBy(F.regexp_extract("path", r"/data/([^/]+)/", 1).alias("t")).agg(F.sum("n_rows").alias("n"))
        entry["rows"] = {t: 0 for t in expected} | {r["t"]: r["n"] for r in counted.collect()}
        entry["warnings"] = {n: figures[n] for n in WARNINGS if figures.get(n)}
        entry["status"] = "warning" if entry["warnings"] else "ok"
        return entry["status"]


def daily_run(
    spark: SparkSession,
    root: str,
    dates: Iterable[date],
    build: Build,
    log: str,
    checks: dict[str, Callable[[], object]] | None = None,
    clean_up: Callable[[date], None] | None = None,
    expected: Sequence[str] = TABLES,
) -> list[tuple[date, str]]:
    """(date, ok | warning | failed) up to the first failed date, after which no other is tried.

    Interim data of a date goes only once it is committed, so that a failed one can be looked at.
    """
    preflight(checks or {})
    out: list[tuple[date, str]] = []
    for day in dates:
        try:
            status = run_date(spark, root, day, build, log, expected)
        except Exception:  # noqa: BLE001  it is in the log; any failure stops the run
            return [*out, (day, "failed")]
        out.append((day, status))
        if clean_up:
            clean_up(day)
    return out
