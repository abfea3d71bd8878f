"""Name -> (builder, oracle SQL) for every query of the transit engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A registered query: the Spark builder and, where SQL can say it, the DuckDB text."""

    build: Builder
    sql: str | None = None


CATALOG: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Decorator that enters a builder under its name."""

    def enter(build: Builder) -> Builder:
        CATALOG[name] = Query(build, sql)
        return build

    return enter
