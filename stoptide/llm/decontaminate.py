"""Benchmark decontamination by template canonicalisation (DataFrame functions only).

Texts and benchmark items become templates: words in lower case without punctuation, where names
(capitalised words, but for the common openings of sentences), numbers and units after numbers are
typed placeholders.
Windows of templates are hash-joined; where they meet, the words behind the placeholders are
compared, and a match counts only if each value of the item stands for one value of the text and
the other way round, so re-parameterised questions are found and look-alikes are not. Windows of the
words themselves, in lower case and with no placeholders, are joined too: what stands there word for
word is a match whatever its capitals, its numbers, or what surrounds it. A window that many items
hold, such as the standard opening of questions, counts for none of them, unless an item has no other:
so a text with such an opening neither meets all items nor looks like one.

Defined results: null or empty text or items match nothing; an item shorter than the window is one
window of its own length; items that are repeated are each matched; a document found twice under
one doc_id is one row; rows without a doc_id or item_id can't be named and match nothing; empty
tables give an empty result; other columns are ignored by ``find_leaks`` and untouched by
``drop_leaks``, which tells rows apart by their texts, so that rows without a doc_id, or of one doc_id
with different texts, are judged each on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stoptide.llm.common import forget, read_table, stored, text_key

#: Words in a window, the least share of an item's windows that makes a leak, and the plain words that a
#: window with placeholders needs (half of it, if it is shorter than twice that).
WINDOW, SHARE, PLAIN = 8, 0.2, 2
#: A window that more different items than this hold tells none of them apart.
RARE = 4
#: The benchmark's windows are sent to all tasks only up to this many (about 64 MB).
BROADCAST_WINDOWS = 1_000_000
#: Units that are placeholders after a number.
UNITS = "mm|cm|dm|m|km|in|ft|yd|mi|mg|g|kg|t|lb|lbs|oz|ml|cl|l|s|sec|min|h|hr|hrs|hours|hour|minutes|minute|seconds|second|days|day|weeks|week|months|month|years|year|meters|metres|kilometers|kilometres|grams|kilograms|liters|litres|miles|feet|inches|pounds|dollars|euros|cents|usd|eur|gbp|percent|degrees|mph|kmh|w|kw|kwh|v|hz|khz|mhz|ghz|kb|mb|gb|tb"
#: Words that are capitalised only because a sentence or a question opens with them.
OPENINGS = (
    "a all an and any are as assume at before both but by calculate can choose complete compute consider could define describe determine did do does each either "
    "every evaluate explain find for from give given had has have he her here his how i if in is it its let list many may might most must my name no not of on "
    "one or our prove read select she should show simplify since so solve some state suppose than that the their then there these they this those three to true "
    "two under until use was we were what when where whether which while who whom whose why will with would write yes you your"
)
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
_KEEP = r"[^\p{L}\p{N}\x{E000}-\x{E002}]+"


def template_words(text: Column) -> Column:
    """The words of a text's template."""
    opening = "|".join(w[0].upper() + w[1:] for w in OPENINGS.split())
    c = F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}])(?!(?:{opening})(?![\p{{L}}\p{{N}}]))\p{{Lu}}[\p{{L}}\p{{N}}]*+", NAME)
    c = F.concat(F.lit(" "), F.lower(F.regexp_replace(c, _KEEP, " ")), F.lit(" "))
    c = F.regexp_replace(c, r"(?<= )\p{N}++(?= )", NUMBER)
    c = F.regexp_replace(c, rf"(?<=\x{{E001}} )(?:{UNITS})(?= )", UNIT)
    return F.array_remove(F.split(c, " "), "")


def plain_words(text: Column) -> Column:
    """The words that stand behind a template, one for one."""
    return F.array_remove(F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), _KEEP, " ")), " "), "")


def _windows(hashes: str, length: int) -> str:
    """SQL for the array of hashes of all windows of a length, from the words' hashes; null where there are none.

    Words are reached by index: a slice in the lambda would copy the whole text for each window.
    """
    words = ", ".join(["x", *(f"get({hashes}, i + {k})" for k in range(1, length))])
    return f"CASE WHEN size({hashes}) >= {length} THEN slice(transform({hashes}, (x, i) -> xxhash64({words})), 1, size({hashes}) - {length - 1}) END"


def _window_hash(words: Column) -> Column:
    """The hash that ``_windows`` gives a window, from its words: arrays are hashed element by element."""
    return F.xxhash64(F.transform(words, lambda x: F.xxhash64(x)))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, exact, len, j, item_id, n_item, b_slots): the windows that count, word for word, and with
    placeholders those that have some and enough plain words.

    Of each kind only an item's rare windows count, if it has any; ``n_item`` is the number of places
    with a window that counts.
    """
    t = items.filter("item_id IS NOT NULL").select("item_id", template_words(F.col("text")).alias("_t"), plain_words(F.col("text")).alias("_p"))
    t = t.filter(F.size("_p") > 0).withColumn("len", F.least(F.size("_p"), F.lit(window))).withColumn("_same", _window_hash(F.col("_p")))
    t = t.select("*", F.explode(F.expr("sequence(0, size(_p) - len)")).alias("j"))
    t = t.select("*", _slots("_t", "_p", "j", "len").alias("b_slots"))
    cols = ("len", "j", "item_id", "_same")
    word_for_word = t.select(_window_hash(F.expr("slice(_p, j + 1, len)")).alias("h"), F.lit(True).alias("exact"), *cols, F.filter("b_slots", lambda x: F.lit(False)).alias("b_slots"))
    typed = t.filter(F.size("b_slots") > 0).filter(F.col("len") - F.size("b_slots") >= F.least(F.lit(PLAIN), F.col("len") / 2))
    every = word_for_word.union(typed.select(_window_hash(F.expr("slice(_t, j + 1, len)")).alias("h"), F.lit(False).alias("exact"), *cols, "b_slots"))
    held = every.groupBy("h", "exact").agg((F.count_distinct("_same") <= RARE).alias("_rare"))
    own = Window.partitionBy("item_id", "_same", "exact")
    counted = every.join(held, ["h", "exact"]).withColumn("_any", F.bool_or("_rare").over(own)).filter("_rare OR NOT _any")
    places = F.size(F.collect_set("j").over(Window.partitionBy("item_id", "_same")))
    return counted.withColumn("n_item", places).select("h", "exact", "len", "j", "item_id", "n_item", "b_slots")


def _slots(words: str, plain: str, at: str, length: str) -> Column:
    """The placeholders of a window: where in it, of which type, and the word behind."""
    return F.expr(
        f"filter(transform(sequence(0, {length} - 1), k -> struct(k AS k, get({words}, {at} + k) AS type, get({plain}, {at} + k) AS value)), "
        f"s -> s.type IN ('{NAME}', '{NUMBER}', '{UNIT}'))"
    )


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, n_windows, n_item, first_word, changed): items that documents contain.

    ``n_windows`` of the item's ``n_item`` windows stand in the document, word for word or with
    consistent values;
    ``changed`` tells that some value differs, that is, that the question was re-parameterised.
    """
    bench = stored(benchmark_windows(items, window), "bench")
    rows = bench.groupBy("len").count().collect()  # at most ``window`` rows
    lengths = sorted(r["len"] for r in rows) or [window]
    small = sum(r["count"] for r in rows) <= BROADCAST_WINDOWS
    d = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    # outer explodes: from the others the optimizer derives a filter that works out the text's template
    # again for every word; their null hashes meet nothing
    # only ids and hashes are exploded; the words behind placeholders are fetched for the few that meet
    hashed = d.select("doc_id", *(F.transform(w(F.col("text")), lambda x: F.xxhash64(x)).alias(x) for x, w in (("_t", template_words), ("_p", plain_words))))
    sides = [F.struct(F.lit(exact).alias("exact"), F.expr(_windows(x, n)).alias("hs")) for n in lengths for exact, x in ((False, "_t"), (True, "_p"))]
    flat = hashed.select("doc_id", F.explode_outer(F.array(*sides)).alias("_s"))
    flat = flat.select("doc_id", F.col("_s.exact").alias("exact"), F.posexplode_outer("_s.hs").alias("i", "h"))
    # a window that several items share meets a document once; its items follow
    known = bench.select("h", "exact").distinct()
    found = stored(flat.filter("h IS NOT NULL").join(F.broadcast(known) if small else known, ["h", "exact"]), "leaks")
    met = found.join(F.broadcast(bench) if small else bench, ["h", "exact"])
    plain = met.filter("exact").withColumn("d_slots", F.col("b_slots"))
    again = met.filter("NOT exact")
    ids = stored(again.select("doc_id").distinct(), "ids")
    few = ids.count() <= BROADCAST_WINDOWS
    texts = d.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").withColumn("_t", template_words(F.col("text"))).withColumn("_p", plain_words(F.col("text")))
    again = again.join(texts, "doc_id").filter(F.expr("xxhash64(transform(slice(_t, i + 1, len), x -> xxhash64(x))) = h"))
    cols = ("doc_id", "item_id", "exact", "j", "i", "n_item", "b_slots")
    met = plain.select(*cols, "d_slots").union(again.select(*cols, _slots("_t", "_p", "i", "len").alias("d_slots")))
    pairs = "zip_with(b_slots, d_slots, (b, d) -> struct(b.type AS type, b.value AS b, d.value AS d))"
    line = met.groupBy("doc_id", "item_id", "n_item", "exact", (F.col("i") - F.col("j")).alias("shift")).agg(
        F.collect_set("j").alias("js"),
        F.min("i").alias("first_word"),
        F.array_distinct(F.flatten(F.collect_set(F.expr(pairs)))).alias("ps"),
    )
    one_way = "size(array_distinct(transform(ps, p -> struct(p.type, p.b)))) = size(ps)"
    other_way = "size(array_distinct(transform(ps, p -> struct(p.type, p.d)))) = size(ps)"
    line = line.filter(f"{one_way} AND {other_way}").withColumn("changed", F.exists("ps", lambda p: p.b != p.d))
    out = line.groupBy("doc_id", "item_id", "n_item").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("js")))).cast("long").alias("n_windows"),
        F.min("first_word").cast("long").alias("first_word"),
        F.bool_or("changed").alias("changed"),
    )
    out = out.filter(F.col("n_windows") >= F.lit(share) * F.col("n_item"))
    out = stored(out.select("doc_id", "item_id", "n_windows", F.col("n_item").cast("long").alias("n_item"), "first_word", "changed"), "found")
    for done in (found, ids, bench):
        forget(done)
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """The documents that contain no item, with the input's columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = F.col(names[docs.columns.index("text")])
    leaks = find_leaks(plain.select(text_key(text).alias("doc_id"), text.alias("text")), items, window, share)
    leaks = stored(leaks.select("doc_id").distinct(), "leaking")
    small = leaks.count() <= BROADCAST_WINDOWS
    own = plain.withColumn("_k", text_key(text))
    return own.join(F.broadcast(leaks) if small else leaks, F.col("_k") == F.col("doc_id"), "left_anti").select(*names).toDF(*docs.columns)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents contain, over the whole of both tables."""
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
