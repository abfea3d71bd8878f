"""URL filters: host and path rules, and gradient-boosted trees on lexical features (DataFrame functions only).

Urls that a rule judges are the labelled ones, unless labels are given. From a bounded, hash-ordered
sample of them (``TRAIN_ROWS``) trees are grown level by level: one aggregation per level sums gradients by node,
feature and bin, and only those sums (nodes x features x bins) reach the driver. The finished trees
are CASE expressions, so judging every url is one projection without a join or a shuffle.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is
judged by the trees on an empty url; a null page_id stays null; repeated rows are judged alike, each
on its own; without labelled urls the trees are empty and the verdict is allow; an empty table gives
an empty result; other columns are ignored by ``judge_urls`` and untouched by ``url_filter``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.llm.common import forget, lower_ascii, read_table, stored

#: Fixed values: (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: The largest number of labelled urls that the trees are fitted on.
TRAIN_ROWS = 50_000
TREES, DEPTH, BINS, RATE, RIDGE = 10, 3, 16, 0.3, 1.0
#: Host suffixes are counted in so many hashed slots, so the statistic has a fixed size.
SUFFIX_SLOTS = 512


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    body = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(body, shape, 1)), F.regexp_extract(body, shape, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; else null."""
    out = F.lit(None)
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _count(c: Column, char: str) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))).cast("double")


def lexical_features(url: Column, host: Column, path: Column) -> list[Column]:
    """Lengths, depth, digits, entropy and parameter counts, each a double."""
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    digits = F.length(F.regexp_replace(url, r"[^0-9]++", "")).cast("double")
    chars = F.split(url, "")
    entropy = F.aggregate(
        F.array_distinct(chars),
        F.lit(0.0),
        lambda a, x: a - F.when(x == "", 0.0).otherwise((lambda p: p * F.log2(p))((F.length(url) - F.length(F.replace(url, x, F.lit("")))) / size)),
    )
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return [
        F.length(url).cast("double"),
        F.length(host).cast("double"),
        F.length(path).cast("double"),
        _count(path, "/"),
        _count(host, "."),
        digits / size,
        F.length(F.regexp_replace(host, r"[^0-9]++", "")).cast("double"),
        entropy,
        F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(0.0),
        F.length(query).cast("double"),
        _count(url, "-") + _count(url, "_"),
        _count(url, "%"),
        F.length(F.regexp_extract(url, r"#(.*)", 1)).cast("double"),
        F.length(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)).cast("double"),
        F.length(F.regexp_extract(host, r"([^.]*)$", 1)).cast("double"),
    ]


def suffix_slot(host: Column) -> Column:
    """The hashed slot of a host's last label."""
    return F.pmod(F.xxhash64(F.regexp_extract(host, r"([^.]*)$", 1)), F.lit(SUFFIX_SLOTS)).cast("int")


def with_features(pages: DataFrame, url: str) -> DataFrame:
    """Adds _host, _path, _rule, and the array _x; _slot stands for the suffix."""
    d = pages.withColumn("_u", F.coalesce(F.col(url), F.lit("")))
    host, path = split_url(F.col("_u"))
    d = d.withColumn("_host", host).withColumn("_path", path)
    d = d.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"))).withColumn("_slot", suffix_slot(F.col("_host")))
    return d.withColumn("_x", F.array(*lexical_features(F.col("_u"), F.col("_host"), F.col("_path")))).drop("_u")


def _rates(train: DataFrame) -> list[float]:
    """Per suffix slot the smoothed share of blocked urls, from the even half of the sample."""
    rows = train.filter("_even").groupBy("_slot").agg(F.sum("_y").alias("y"), F.count("*").alias("n")).collect()  # SUFFIX_SLOTS rows at most
    total, n = sum(r["y"] for r in rows), sum(r["n"] for r in rows)
    base = (total + 1) / (n + 2)
    out = [base] * SUFFIX_SLOTS
    for r in rows:
        out[r["_slot"]] = (r["y"] + 5 * base) / (r["n"] + 5)
    return out


def _all_features(rates: list[float]) -> Column:
    table = F.array(*(F.lit(round(x, 6)) for x in rates))
    return F.concat(F.col("_x"), F.array(F.get(table, F.col("_slot"))))


def _leaf(g: float, h: float) -> float:
    return round(-RATE * g / (h + RIDGE), 6)


def _tree(bins: DataFrame, score: Column, cuts: list[list[float]]) -> list | float:
    """One tree, grown level by level from sums of gradients; (feature, cut, left, right) or a leaf."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
    rows = bins.select(F.posexplode("_b").alias("f", "b"), (p - F.col("_y")).alias("g"), (p * (1 - p)).alias("h"), "_b")
    nodes: dict[int, tuple[int, int]] = {}  # node -> (feature, bin); children 2n and 2n + 1
    leaves: dict[int, float] = {}
    for depth in range(DEPTH):
        at = F.lit(1)
        for level in range(depth):
            step = at
            for n, (f, b) in nodes.items():
                if n.bit_length() == level + 1:
                    step = F.when(at == n, F.when(F.get("_b", F.lit(f)) <= b, 2 * n).otherwise(2 * n + 1)).otherwise(step)
            at = step
        sums: dict[int, dict] = {}
        for r in rows.groupBy(at.alias("n"), "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            sums.setdefault(r["n"], {})[r["f"], r["b"]] = (r["g"], r["h"])
        for n in sorted(x for x in sums if x.bit_length() == depth + 1):
            own = sums[n]
            g_all = sum(g for (f, _), (g, _) in own.items() if f == 0)
            h_all = sum(h for (f, _), (_, h) in own.items() if f == 0)
            best = (1e-6, None)
            for f in sorted({f for f, _ in own}):
                g = h = 0.0
                for b in range(len(cuts[f])):
                    dg, dh = own.get((f, b), (0.0, 0.0))
                    g, h = g + dg, h + dh
                    gain = g * g / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
                    if h > 0.5 and h_all - h > 0.5 and round(gain, 6) > best[0]:
                        best = (round(gain, 6), (f, b, _leaf(g, h), _leaf(g_all - g, h_all - h)))
            leaves[n] = _leaf(g_all, h_all)
            if best[1]:
                f, b, leaves[2 * n], leaves[2 * n + 1] = best[1]
                nodes[n] = (f, b)

    def built(n: int):
        return [nodes[n][0], cuts[nodes[n][0]][nodes[n][1]], built(2 * n), built(2 * n + 1)] if n in nodes else leaves.get(n, 0.0)

    return built(1)


def tree_value(tree: list | float, x: str = "_x") -> Column:
    """A tree as a CASE expression over the feature array."""
    if not isinstance(tree, list):
        return F.lit(float(tree))
    f, cut, left, right = tree
    return F.when(F.get(x, F.lit(f)) <= F.lit(cut), tree_value(left, x)).otherwise(tree_value(right, x))


def fit_trees(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[float], float, list]:
    """Suffix rates, bias and trees, from at most ``train_rows`` rows of _x, _slot, _y (1: block) and _key."""
    n = labelled.count()
    if n > train_rows:  # a hash threshold first, so that tasks send few more rows than are wanted
        least = int((1 - 1.1 * train_rows / n) * 2.0**64) - (1 << 63)
        labelled = labelled.filter(F.xxhash64("_key") >= max(least, -(1 << 63)))
    sample = labelled.orderBy(F.xxhash64("_key").desc(), "_key").limit(train_rows)
    sample = stored(sample.select("_x", "_slot", F.col("_y").cast("double").alias("_y"), (F.xxhash64("_key") % 2 == 0).alias("_even")), "urls")
    rates = _rates(sample)
    train = sample.filter(~F.col("_even")).select(_all_features(rates).alias("_x"), "_y")
    width = len(lexical_features(F.lit(""), F.lit(""), F.lit(""))) + 1
    marks = [k / BINS for k in range(1, BINS)]
    first = train.agg(F.count("*").alias("n"), F.sum("_y").alias("y"), *(F.percentile_approx(F.get("_x", F.lit(k)), marks).alias(f"q{k}") for k in range(width))).first()
    if not first["n"]:
        forget(sample)
        return rates, 0.0, []
    cuts = [sorted(set(first[f"q{k}"])) for k in range(width)]
    bias = round(math.log((first["y"] + 1) / (first["n"] - first["y"] + 1)), 6)
    index = [sum((F.when(F.get("_x", F.lit(k)) > t, 1).otherwise(0) for t in c), F.lit(0)) for k, c in enumerate(cuts)]
    binned = stored(train.select("_x", "_y", F.array(*index).alias("_b")), "urlbins")
    trees: list = []
    for _ in range(TREES):
        score = sum((tree_value(t) for t in trees), F.lit(bias))
        trees.append(_tree(binned, score, cuts))
    forget(binned)
    forget(sample)
    return rates, bias, trees


def judge_urls(pages: DataFrame, id_col: str = "page_id", url: str = "url", train_rows: int = TRAIN_ROWS, labels: DataFrame | None = None) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict and p_block, the trees' probability.

    ``labels`` (url, block) are the labelled urls; without them, those of ``pages`` that a rule judges.
    """
    d = with_features(pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("_url")), "_url")
    if labels is None:
        labelled = d.filter("_rule IS NOT NULL").select("_x", "_slot", F.expr("_rule.verdict = 'block'").cast("int").alias("_y"), F.col("_url").alias("_key"))
    else:
        known = labels.filter("block IS NOT NULL").select(F.col("url").alias("_url"), F.col("block").cast("int").alias("_y"))
        labelled = with_features(known, "_url").select("_x", "_slot", "_y", F.col("_url").alias("_key"))
    rates, bias, trees = fit_trees(labelled, train_rows)
    score = sum((tree_value(t, "_all") for t in trees), F.lit(bias))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
    d = d.withColumn("_all", _all_features(rates)).withColumn("p_block", F.round(p, 6))
    return d.select(
        "page_id",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", F.when(F.col("p_block") > 0.5, "block").otherwise("allow")).alias("verdict"),
        "p_block",
    )


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts for the whole of ``pages``."""
    return judge_urls(read_table(spark, sf_dir, "pages"))
