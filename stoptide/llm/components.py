"""Connected components of a graph of links, without collecting it.

Alternating large-star and small-star steps turn every component into a star around its smallest
node. Each step is one aggregation and one join; its result is written to the shared folder, so
lineage stays short and a lost executor costs only its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stoptide.llm.common import forget, stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    near = _both_ways(links)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def star_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """From links (a, b) of comparable ids: (node, root) for every linked node, root its component's smallest.

    Nulls and self-links are ignored; an empty input gives an empty result; each round at least halves
    the longest way to a root, so ``most_rounds`` is only passed by an error, which is raised.
    """
    tidy = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, sign = stored(tidy, "links"), None
    for _ in range(most_rounds):
        after = stored(_small_star(_large_star(now)), "links")
        forget(now)
        now = after
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_if(F.col("u") <= F.col("v"))).first()
        if tuple(row) == sign:
            break
        sign = tuple(row)
    else:
        raise RuntimeError(f"components aren't whole after {most_rounds} rounds")
    out = stored(now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct()), "roots")
    forget(now)
    return out
