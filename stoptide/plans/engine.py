"""Turns a query stated over relations into a Spark DataFrame and into the oracle's text.

A query may state its oracle by itself (``oracle``), and a relation may have a text for each engine;
then Spark's text is the one that scales and the oracle's the plain definition.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stoptide.catalog import CATALOG, Query
from stoptide.functions.dialect import DUCK, SPARK, Spark
from stoptide.sources.analogs import RELATIONS, TABLES

Stated = Callable[[Spark], str]


def _needed(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def frame(spark: SparkSession, sf_dir: str, text: str, made: dict[str, DataFrame] | None = None) -> DataFrame:
    """The DataFrame of a Spark SQL text whose names in braces are tables or relations."""
    made = {} if made is None else made
    for name in _needed(text):
        if name not in made:
            made[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet") if name in TABLES else frame(spark, sf_dir, RELATIONS[name](SPARK), made)
    return spark.sql(text, **{n: made[n] for n in _needed(text)})


def oracle(text: str) -> str:
    """The oracle's text: the relations that are needed as common table expressions, in order."""
    order: list[str] = []

    def visit(t: str) -> None:
        for name in _needed(t):
            if name not in TABLES and name not in order:
                visit(RELATIONS[name](DUCK))
                order.append(name)

    visit(text)

    def plain(t: str) -> str:
        return re.sub(r"\{(\w+)\}", lambda m: m[1] if m[1] in TABLES else f"rel_{m[1]}", t)

    head = ",\n".join(f"rel_{n} AS ({plain(RELATIONS[n](DUCK))})" for n in order)
    if not head:
        return plain(text)
    own = plain(text).lstrip()
    return f"WITH {head},\n{own[5:]}" if own.startswith("WITH ") else f"WITH {head}\n{own}"


def stated(f: Stated | None = None, *, plainly: Stated | None = None) -> Stated:
    """Registers a query under its function's name; ``plainly`` is the oracle's own statement of it."""
    if f is None:
        return lambda g: stated(g, plainly=plainly)

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # local times are worked out from epochs; the zone is bound here
        try:
            return frame(spark, sf_dir, f(SPARK))
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    build.__doc__ = f.__doc__
    CATALOG[f.__name__] = Query(build, oracle((plainly or f)(DUCK)))
    return f
