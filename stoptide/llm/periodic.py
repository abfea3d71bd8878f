"""Periodic runs of words by harmonic grid probing.

A run of period p and length L >= 2p holds a grid point jp with (j+1)p inside it, so testing whether
the words at jp and (j+1)p are equal, for every p and j, meets every run in about n ln n tests.

1. The tests of all texts of a piece are made together, for periods from one power of two to the
   next: none of these divides another, so all divisors of a period have been dealt with before.
2. A grid point inside a run already found, whose period divides p, is skipped.
3. Of the points that are left, those go whose neighbours close the stretch of equal words before it
   is long enough. The others are extended to both sides by comparing arrays in chunks that double.
4. A stretch of m equal words p apart is a run of length m + p. If its smallest period were q < p, q
   would divide p (L >= 2p) and the run of period q would be the same stretch: it was found before.

Words are compared by 64-bit hashes. Nothing is shuffled: a text is dealt with where it is read, by
pieces of about 2 MB of whole texts; a longer text is a piece of its own.

Defined results: null, empty and blank texts have no words and no run; repeated rows give repeated
results; a null id is kept (and has no rewriting in ``op12``); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.llm.common import WORD_GAP, give_back, mix, pieces, read_table, text_bytes, word_hashes, word_spans

#: A run has at least this many words, and twice its period.
LEAST_WORDS = 12
#: Grid points tested at a time; words looked at on either side, in turn, before a stretch is extended.
TESTS, NEARS = 1_000_000, (1, 8, 64)
MARGIN = NEARS[-1]

Run = tuple[int, int, int]


def _separated(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' words on end, each text between values that equal nothing else, and where each text begins."""
    n = len(first) - 1
    out = mix(np.arange(1, len(words) + n + 2 * MARGIN + 2, dtype=np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    begin = first[:-1] + np.arange(n) + MARGIN
    out[np.arange(len(words)) + np.repeat(np.arange(n) + MARGIN, np.diff(first))] = words
    return out, begin


def _counted(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes: each member's group, and its number within."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    return group, np.arange(len(group)) - (np.cumsum(sizes) - sizes)[group]


def _reach(w: np.ndarray, x: int, p: int, most: int, step: int) -> int:
    """How many words from x on, in one direction, equal those p later: arrays in doubling chunks."""
    done, chunk = 0, 32
    while done < most:
        n = min(chunk, most - done)
        a = x + done if step > 0 else x - done - n + 1
        differ = np.flatnonzero(w[a : a + n] != w[a + p : a + p + n])
        if len(differ):
            return done + (int(differ[0]) if step > 0 else n - 1 - int(differ[-1]))
        done, chunk = done + n, 2 * chunk
    return most


def _closed_early(w: np.ndarray, x: np.ndarray, p: np.ndarray, least: int, near: int) -> np.ndarray:
    """Whether the stretch of equal words around x ends within ``near`` words on both sides and is too short."""
    steps = np.arange(1, near + 1)
    right, left = x[:, None] + steps, x[:, None] - steps
    right, left = (np.logical_and.accumulate(w[at] == w[at + p[:, None]], axis=1).sum(axis=1) for at in (right, left))
    return (right < near) & (left < near) & (1 + right + left < np.maximum(p, least - p))


def _survivors(w: np.ndarray, begin: np.ndarray, sizes: np.ndarray, texts: np.ndarray, low: int, high: int, least: int, run_at: np.ndarray, run_period: np.ndarray) -> zip:
    """The grid points (text, place, period) of periods from low to high that may stand in a run not yet found."""
    of, k = _counted(np.minimum(high - 1, sizes[texts] // 2) - low + 1)
    text, p = texts[of], low + k
    pair, j = _counted((sizes[text] - 1) // p)
    p = p[pair]
    x = begin[text][pair] + j * p
    same = w[x] == w[x + p]
    x, p, text = x[same], p[same], text[pair[same]]
    held = run_at[x]
    new = (held == 0) | (held != run_at[x + p]) | (p % run_period[held] != 0)
    x, p, text = x[new], p[new], text[new]
    for near in NEARS:
        part = TESTS // near  # so many at a time
        keep = ~np.concatenate([_closed_early(w, x[i : i + part], p[i : i + part], least, near) for i in range(0, len(x), part)] or [np.zeros(0, bool)])
        x, p, text = x[keep], p[keep], text[keep]
    return zip(text.tolist(), x.tolist(), p.tolist(), strict=True)


def find_runs(words: np.ndarray, first: np.ndarray, least: int = LEAST_WORDS) -> list[list[Run]]:
    """For each text its runs (start, length, smallest period), in order; ``first`` has each text's first word, and the end."""
    sizes = np.diff(first)
    found: list[dict[tuple[int, int], int]] = [{} for _ in sizes]
    longest = int(sizes.max()) if len(sizes) else 0
    w, begin = _separated(words, first)
    run_at = np.zeros(len(w), dtype=np.int32)  # the longest run found so far that covers a place; 0 is none
    run_period, run_length, n_runs = np.ones(64, dtype=np.int64), np.zeros(64, dtype=np.int64), 1
    low = 1
    while 2 * low <= longest:
        texts = np.flatnonzero(sizes >= 2 * low)
        a_period = int(sizes[texts].sum()) // low + 1
        high = max(low + 1, min(2 * low, longest // 2 + 1, low + TESTS // a_period))
        before, end = None, 0
        for text, x, p in _survivors(w, begin, sizes, texts, low, high, least, run_at, run_period):
            if before == (text, p) and x < end:
                continue
            at, size = int(begin[text]), int(sizes[text])
            right, left = _reach(w, x, p, at + size - p - x, 1), _reach(w, x - 1, p, x - at, -1)
            before, end = (text, p), x + right
            start, length = x - left, left + right + p
            if length < max(2 * p, least) or (start - at, length) in found[text]:
                continue
            found[text][start - at, length] = p
            if n_runs == len(run_period):
                run_period, run_length = np.resize(run_period, 2 * n_runs), np.resize(run_length, 2 * n_runs)
            run_period[n_runs], run_length[n_runs] = p, length
            now = run_at[start : start + length]
            now[run_length[now] < length] = n_runs
            n_runs += 1
        low = high
    return [sorted((s, n, p) for (s, n), p in x.items()) for x in found]


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stay when each run keeps only its first period: false inside any run behind it."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """For each text its words with one space between, as an Arrow column."""
    sizes = ends - starts + 1
    out_at = np.concatenate([[0], np.cumsum(sizes)])
    word, k = _counted(sizes)
    at = starts[word] + k
    at[out_at[1:] - 1] = 0
    body = data[at] if len(at) else np.zeros(0, np.uint8)
    body[out_at[1:] - 1] = 0x20
    # a text ends before its last word's space
    spaces = np.zeros(len(body), dtype=bool)
    last = first[1:][np.diff(first) > 0]
    spaces[out_at[last] - 1] = True
    n = out_at[first[1:]] - out_at[first[:-1]]
    offsets = np.concatenate([[0], np.cumsum(np.maximum(n - 1, 0))])
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body[~spaces]))


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """Per row: doc_id, n_words, runs (start and length in words, smallest period; by start, then period) and the text without repetitions."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            for i, j in pieces(len(at) - 1, at):
                part = data[at[i] : at[j]]
                starts, ends, first = word_spans(part, at[i : j + 1] - at[i])
                runs = find_runs(word_hashes(part, starts, ends, fold=False), first, least)
                stay = np.ones(len(starts), dtype=bool)
                for k, found in enumerate(runs):
                    if found:
                        stay[first[k] : first[k + 1]] = kept_words(int(first[k + 1] - first[k]), found)
                left = np.concatenate([[0], np.cumsum(stay)])[first]
                rows = pa.array([[{"start": s, "length": n, "period": p} for s, n, p in x] for x in runs], RUNS)
                collapsed = joined(part, starts[stay], ends[stay], left)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(first)), rows, collapsed.cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
        give_back()

    return docs.select(id_col, text).mapInArrow(run, f"doc_id {id_type}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth text (by the crc32 of its id) repeats a stretch of itself from some word on to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("_g"), F.when(h % 10 == 0, F.array_remove(F.split(F.coalesce("text", F.lit("")), WORD_GAP), "")).alias("_w"))
    n = F.size("_w")
    a = F.col("_g") % n
    made = split.withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, 1 + F.floor((n - a) / (3 + F.col("_g") % 8))))
    again = F.expr("array_join(transform(_w, (x, i) -> if(i < _a, x, get(_w, int(_a + (i - _a) % _p)))), ' ')")
    return made.select("doc_id", F.when(F.col("_a").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, the longest one, and digests of the runs and of the text without repetitions."""
    found = periodic_runs(with_planted_runs(read_table(spark, sf_dir, "documents")))
    best = F.expr("array_min(transform(runs, r -> struct(-r.length AS l, r.start AS s, r.period AS p)))")
    d = found.withColumn("_b", best)
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return d.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_b.s").alias("start"),
        (-F.col("_b.l")).alias("length"),
        F.col("_b.p").alias("period"),
        F.expr("1000 * -_b.l div _b.p").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
