"""Keys that must be unique: checks that fail loudly, and lookups that can't multiply rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assert_unique(df: DataFrame, keys: Sequence[str], label: str) -> None:
    """ValueError with the number of keys that occur more than once, and up to five of them; nulls equal nulls."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    some = twice.orderBy(F.desc("_n"), *keys).limit(5).collect()
    if some:
        told = "; ".join(f"{', '.join(f'{k}={r[k]}' for k in keys)} {r['_n']} times" for r in some)
        raise ValueError(f"{label} isn't unique on {', '.join(keys)}: {twice.count()} keys occur more than once, such as {told}")


def lookup(rows: DataFrame, details: DataFrame, keys: Sequence[str], label: str = "details") -> DataFrame:
    """Every row with its details, or nulls; as many rows as before, or ValueError, for details whose keys repeat among those asked for.

    A null key part equals a null, as a start date that is missing on both sides.
    """
    on = [F.col(f"_a.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in keys]
    asked = rows.select(*keys).distinct().alias("_b")
    known = details.alias("_a").join(asked, on, "left_semi")
    assert_unique(known, keys, label)
    rest = [c for c in details.columns if c not in keys]
    return rows.alias("_b").join(known.alias("_a"), on, "left").select("_b.*", *(F.col(f"_a.{c}") for c in rest))
