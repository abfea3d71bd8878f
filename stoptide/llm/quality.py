"""Quality rules by weak supervision (DataFrame functions only).

Rules vote good (+1), bad (-1) or abstain (0). Expectation-maximisation over the counts of vote
patterns, of which there are at most 3 to the number of rules however many documents there are,
estimates how often each rule is right in each class and how common good documents are. A
document's posterior probability of being good replaces an all-must-pass filter.

Defined results: null or empty text has no words, so all counts are 0 and it fails the base rule;
a null doc_id is kept as a null; repeated rows are judged alike, each on its own; an empty table
gives an empty result. Columns of the input other than the id and the text are not looked at by
``judge_quality`` and pass through ``quality_filter`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.llm.common import WORD_GAP, read_table, stored

#: Frequent function words of the languages the rules know.
FUNCTION_WORDS = (
    "the of and to in is that it for on was be with as this by at from are an "
    "der die das und den ist von zu mit nicht ein eine auf für im dem sich des als auch "
    "le la les de et un une du des est que en pour dans il au sur qui par "
    "el los las y en que un una por con para del se su al lo como más"
).split()

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
EM_ROUNDS = 50


def text_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the struct ``_f`` of counts over each whole text."""
    body = F.coalesce(F.col(text), F.lit(""))
    w = docs.withColumn("_w", F.array_remove(F.split(body, WORD_GAP), ""))
    w = w.withColumn(
        "_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    ).withColumn(
        "_h",
        F.when(
            F.size("_w") >= 3,
            F.expr("slice(transform(_w, (x, i) -> xxhash64(x, get(_w, i + 1), get(_w, i + 2))), 1, size(_w) - 2)"),
        ),
    )
    # only texts in which some window recurs pay for the sort
    w = w.withColumn(
        "_s",
        F.expr("CASE WHEN size(array_distinct(_h)) < size(_h) THEN sort_array(transform(_h, (h, i) -> struct(h AS h, i AS i))) END"),
    )
    twice = "filter(_s, (s, k) -> coalesce(s.h = get(_s, k - 1).h, false) OR coalesce(s.h = get(_s, k + 1).h, false))"
    return w.select(
        *docs.columns,
        F.struct(
            F.size("_w").cast("long").alias("n_words"),
            F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(body, r"[^#*$%&|<>]++", "")).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.expr(
                f"CASE WHEN _s IS NULL THEN 0 ELSE size(array_distinct(flatten(transform({twice}, s -> array(s.i, s.i + 1, s.i + 2))))) END"
            )
            .cast("long")
            .alias("n_repeat_words"),
            F.size("_lines").cast("long").alias("n_lines"),
            F.length(F.regexp_replace(body, r"[\p{L}\x20\x09-\x0D]++", "")).cast("long").alias("n_other"),
            F.length(F.regexp_replace(body, r"[^\p{Lu}]++", "")).cast("long").alias("n_upper"),
            F.size(F.array_intersect("_w", F.array(*map(F.lit, sorted(set(FUNCTION_WORDS)))))).cast("long").alias("n_function"),
        ).alias("_f"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> list[Column]:
    """The rules, each a vote over ``_f``; shares are of words, characters or lines."""
    f = {x: F.col(f"_f.{x}") for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_other", "n_upper", "n_function")}
    f["n_letters"] = f["word_chars"] - f["n_other"]
    words, chars = F.greatest(f["n_words"], F.lit(1)), F.greatest(f["word_chars"], F.lit(1))
    return [
        _vote(f["n_words"] >= 80, f["n_words"] < MIN_WORDS),
        _vote(f["word_chars"].between(3 * words, 9 * words), (f["word_chars"] < 2 * words) | (f["word_chars"] > 14 * words)),
        _vote(50 * f["n_symbols"] <= words, 10 * f["n_symbols"] > words),
        _vote(10 * f["n_dup_lines"] <= f["n_lines"], 3 * f["n_dup_lines"] > f["n_lines"]),
        _vote(20 * f["n_repeat_words"] <= words, 5 * f["n_repeat_words"] > words),
        _vote(100 * f["n_letters"] >= 88 * chars, 100 * f["n_letters"] < 75 * chars),
        _vote(8 * f["n_upper"] <= f["n_letters"], 2 * f["n_upper"] > f["n_letters"]),
        _vote(f["n_function"] >= 3, (f["n_function"] == 0) & (f["n_words"] >= 20)),
    ]


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], rounds: int = EM_ROUNDS) -> tuple[float, list[dict]]:
    """EM over (votes, count) pairs: the share of good documents, and per rule P(vote | class).

    Each class keeps a weak prior that a rule is right more often than wrong, so the classes can't
    swap; abstaining carries evidence as any vote does.
    """
    n_rules = len(patterns[0][0]) if patterns else 0
    total = sum(n for _, n in patterns)
    prior = 0.85
    start = {True: {1: 0.8, 0: 0.15, -1: 0.05}, False: {1: 0.35, 0: 0.25, -1: 0.4}}
    table = [{c: dict(start[c]) for c in (True, False)} for _ in range(n_rules)]
    weight = max(1.0, 0.01 * total)
    for _ in range(rounds if total else 0):
        sums = [{c: {v: weight * start[c][v] for v in (1, 0, -1)} for c in (True, False)} for _ in range(n_rules)]
        good = 0.0
        for vote, n in patterns:
            p = posterior(vote, prior, table)
            good += n * p
            for r, v in enumerate(vote):
                sums[r][True][v] += n * p
                sums[r][False][v] += n * (1 - p)
        prior = min(0.99, max(0.01, good / total))
        table = [{c: {v: s[c][v] / sum(s[c].values()) for v in s[c]} for c in s} for s in sums]
    return prior, table


def posterior(vote: tuple[int, ...], prior: float, table: list[dict]) -> float:
    """P(good | votes) under the fitted rules."""
    odds = math.log(prior) - math.log1p(-prior)
    for r, v in enumerate(vote):
        odds += math.log(table[r][True][v]) - math.log(table[r][False][v])
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def fit_rules(feats: DataFrame) -> tuple[float, list[dict]]:
    """The rules' accuracies from the vote patterns of all documents."""
    rules = votes()
    names = [f"_v{i}" for i in range(len(rules))]
    counted = feats.select(*(r.cast("int").alias(n) for r, n in zip(rules, names, strict=True))).groupBy(*names).count()
    return fit_votes(sorted((tuple(row[:-1]), row[-1]) for row in counted.collect()))  # at most 3 ** 8 rows


def judged(feats: DataFrame, model: tuple[float, list[dict]]) -> DataFrame:
    """Adds base_failed, p_good and kept: the fitted log-odds as one expression, without a join."""
    prior, table = model
    odds = F.lit(math.log(prior) - math.log1p(-prior))
    for rule, t in zip(votes(), table, strict=False):
        gain = {v: math.log(t[True][v]) - math.log(t[False][v]) for v in (1, 0, -1)}
        odds = odds + F.when(rule == 1, gain[1]).when(rule == -1, gain[-1]).otherwise(gain[0])
    words, repeats = F.col("_f.n_words"), F.col("_f.n_repeat_words")
    return (
        feats.withColumn("base_failed", (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words))
        .withColumn("p_good", F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))
    )


def quality_filter(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that are kept, with the input's columns.

    Features are worked out twice, for the fit and for the verdict, as a stored copy of them would have
    to hold every text too. The number that each row gets keeps the optimizer from moving the verdict
    below the features, where it would work them out again for every vote that looks at them.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    feats = text_features(docs.toDF(*names), names[docs.columns.index(text)])
    kept = judged(feats.withColumn("_row", F.monotonically_increasing_id()), fit_rules(feats)).filter("kept AND _row >= 0")
    return kept.select(*names).toDF(*docs.columns)


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``_f``, base_failed, p_good and kept; features are kept in a shared table."""
    feats = stored(text_features(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))).drop("text"), "quality")
    return judged(feats, fit_rules(feats))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over the whole of ``documents``."""
    out = judge_quality(read_table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select("doc_id", *(F.col(f"_f.{x}").alias(x) for x in base), "base_failed", "kept", F.round("p_good", 6).alias("p_good"))
