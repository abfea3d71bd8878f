"""Spelling variants grouped by a symmetric-delete join.

1. Words are counted over all texts, by partial sums in each task before the shuffle.
2. Every word of the vocabulary emits itself and its distinct single deletions as keys, each with the
   stretch of places whose deletion gives that key (a run of equal letters has one key).
3. Words meet on equal keys. Of the same length, they differ by one replacement exactly if their
   stretches share a place; of lengths that differ by one, exactly if the key is the shorter word.
   Two near words share no more than one key, so each pair comes once and needs no distinct step.
4. Per word: the number of near words, and the near word of largest count. Words that share a key are
   at most (letters) x (key length + 1), whatever the size of the corpus.
5. Roots: each word's form is replaced by that form's form until nothing changes; each round doubles
   the way that is covered, and a form has at least twice its word's count, so rounds are few.

Defined results: null and empty texts hold no words; a null id is never altered by ``op13``; repeated
rows count again; equal counts go to the smaller word in code-point order; no word of enough
occurrences, or an empty table, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.llm.common import forget, lower_ascii, read_table, stored

#: The letters of a word.
NOT_LETTERS = r"[^A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form occurs at least so many times as often as its word.
FORM_RATIO = 2


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, word): every run of letters of every text, A-Z lower-cased, each occurrence a row."""
    words = F.split(lower_ascii(F.col(text)), NOT_LETTERS)
    return docs.select(F.col(id_col), F.explode(words).alias("word")).filter("word <> ''")


def count_words(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def deletion_keys(vocabulary: DataFrame) -> DataFrame:
    """(key, size, lo, hi, word, n): each word under itself (no place) and under each distinct single deletion."""
    itself = vocabulary.select(F.col("word").alias("key"), F.length("word").alias("size"), F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi"), "word", "n")
    # a deletion stands for a run of equal letters from its first place on
    starts = "filter(sequence(0, length(word) - 1), i -> i = 0 OR substr(word, i + 1, 1) <> substr(word, i, 1))"
    parts = vocabulary.withColumn("_s", F.expr(starts)).select("word", "n", "_s", F.posexplode("_s").alias("_k", "lo"))
    size = F.length("word")
    key = F.concat(F.substring("word", F.lit(1), F.col("lo")), F.substring("word", F.col("lo") + 2, size))
    last = F.coalesce(F.expr("get(_s, _k + 1)"), size) - 1
    return itself.union(parts.select(key.alias("key"), size.alias("size"), F.col("lo"), last.alias("hi"), "word", "n"))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two different words one inserted, deleted or replaced code point apart, both ways, once each."""
    keys = deletion_keys(vocabulary)
    a, b = keys.alias("a"), keys.alias("b")
    replaced = (F.col("a.size") == F.col("b.size")) & (F.col("a.lo") <= F.col("b.hi")) & (F.col("b.lo") <= F.col("a.hi"))
    longer = (F.col("a.size") == F.col("b.size") + 1) & F.col("b.lo").isNull()
    shorter = (F.col("b.size") == F.col("a.size") + 1) & F.col("a.lo").isNull()
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.word") != F.col("b.word")) & (replaced | longer | shorter))
    return met.select(F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))


def word_forms(vocabulary: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest count, if that is ``ratio`` times the word's own."""
    best: Column = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = near_pairs(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    d = vocabulary.join(near, "word", "left").withColumn("_ok", -F.col("best.less") >= ratio * F.col("n"))
    return d.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.expr("if(_ok, best.near, NULL)").alias("form"), F.expr("if(_ok, -best.less, NULL)").alias("form_n"))


def word_roots(forms: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(word, root) of each word with a form: the last of its forms. Counts double along the way, so it ends."""
    now = stored(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    for _ in range(most_rounds):
        far = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = now.join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        after = stored(stepped, "forms")
        forget(now)
        now = after.drop("moved")
        now._stored_at = after._stored_at
        if after.filter("moved").limit(1).count() == 0:
            return now
    raise RuntimeError(f"forms don't end after {most_rounds} rounds")


def spelling_groups(words: DataFrame) -> DataFrame:
    """From the occurrences (word): word, form, root, n, n_near, form_n of every word that is long and frequent enough."""
    vocabulary = stored(count_words(words), "words")
    forms = stored(word_forms(vocabulary), "near")
    forget(vocabulary)
    out = forms.join(word_roots(forms), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_planted_slips(words: DataFrame) -> DataFrame:
    """(word): one letter is missing where 97 divides the crc32 of ``<doc_id>:<word>``; which one, that number tells too."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
    at = (F.col("_h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return words.withColumn("_h", h).select(F.when(F.col("_h") % 97 == 0, cut).otherwise(F.col("word")).alias("word"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form, root and near words."""
    return spelling_groups(with_planted_slips(letter_runs(read_table(spark, sf_dir, "documents"))))
