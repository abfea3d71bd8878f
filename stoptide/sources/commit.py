"""Several tables changed as one: staged versions, and a manifest that takes effect by one rename.

``<root>/data/<table>/service_date=D/version=V`` holds what a commit wrote; ``<root>/_manifests/<n>.json``
says which version of each date of each table counts. Readers take the highest manifest and read only
what it names, so they see all of a commit or nothing of it; a failure between two tables leaves the old
state readable, and what it left behind is deleted by ``sweep``. Of two commits at once one finds its
number taken, and works its changes into the new state before it tries again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from stoptide.sources.scratch import Store
from stoptide.sources.warehouse import TABLES

State = dict[str, dict[str, str]]


def _manifests(store: Store, root: str) -> list[str]:
    return [x for x in store.names(f"{root}/_manifests") if x.endswith(".json") and x[:-5].isdigit()]


def state(spark: SparkSession, root: str) -> tuple[int, State]:
    """The number of the last commit (0 if there is none), and by table and date the version that counts."""
    store = Store(spark, root)
    names = _manifests(store, root)
    return (int(names[-1][:-5]), json.loads(store.read(f"{root}/_manifests/{names[-1]}"))) if names else (0, {})


def commit(spark: SparkSession, root: str, day: date, tables: dict[str, DataFrame], expected: Sequence[str] = TABLES, tries: int = 20) -> int:
    """Replaces one date of all ``expected`` tables together; returns the commit's number.

    ValueError, and nothing written, if ``tables`` lacks one or has others. The frames hold that date's
    rows; a ``service_date`` column is left out of the files, as the folder names it.
    """
    if set(tables) != set(expected):
        raise ValueError(f"a commit holds {', '.join(sorted(expected))}; missing {sorted(set(expected) - set(tables))}, unknown {sorted(set(tables) - set(expected))}")
    version, key, store = uuid.uuid4().hex, day.isoformat(), Store(spark, root)
    for name in expected:
        tables[name].drop("service_date").write.parquet(f"{root}/data/{name}/service_date={key}/version={version}")
    staged = f"{root}/_manifests/staged-{version}"
    for _ in range(tries):
        number, now = state(spark, root)
        after = now | {name: now.get(name, {}) | {key: version} for name in expected}
        store.write(staged, json.dumps(after, sort_keys=True))
        if store.rename(staged, f"{root}/_manifests/{number + 1:012d}.json"):
            return number + 1
        store.delete(staged)
    raise RuntimeError(f"no free number for a commit in {tries} tries")


def read_committed(spark: SparkSession, root: str, table: str, number: int | None = None) -> DataFrame:
    """A table as of the last commit, or of commit ``number``; only the versions that count are listed and read."""
    at = state(spark, root)[1] if number is None else json.loads(Store(spark, root).read(f"{root}/_manifests/{number:012d}.json"))
    if not at.get(table):
        raise ValueError(f"no commit of {table}")
    paths = [f"{root}/data/{table}/service_date={day}/version={version}" for day, version in sorted(at[table].items())]
    return spark.read.option("basePath", f"{root}/data/{table}").parquet(*paths).drop("version")


def sweep(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Deletes the versions that none of the last ``keep`` commits names, and older manifests; returns how many versions went.

    Run it while no commit is under way: what one has staged isn't named yet.
    """
    store = Store(spark, root)
    names = _manifests(store, root)
    states = [json.loads(store.read(f"{root}/_manifests/{x}")) for x in names[-keep:]]
    gone = 0
    for table in store.names(f"{root}/data"):
        for folder in store.names(f"{root}/data/{table}"):
            day = folder.partition("=")[2]
            for version in store.names(f"{root}/data/{table}/{folder}"):
                if version.startswith("version=") and not any(s.get(table, {}).get(day) == version[8:] for s in states):
                    store.delete(f"{root}/data/{table}/{folder}/{version}")
                    gone += 1
    for name in [*names[:-keep], *(x for x in store.names(f"{root}/_manifests") if x.startswith("staged-"))]:
        store.delete(f"{root}/_manifests/{name}")
    return gone
