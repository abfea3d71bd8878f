"""Nearest neighbours, periodic runs and spelling groups against brute force and hostile inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import assert_same, connect
from pyspark.sql import functions as F

from stoptide.llm import neighbours, periodic, spelling
from stoptide.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# ------------------------------------------------------------- 11 neighbours


def plain_nearest(rows, k=10):
    v = {(i, tuple(x)) for i, x in rows if i is not None and x and all(y is not None and math.isfinite(y) for y in x) and any(x)}
    out = []
    for q in {i for i, _ in v if i % 100 == 0}:
        d = {}
        for a in [x for i, x in v if i == q]:
            for i, x in v:
                if i != q and len(x) == len(a):
                    d[i] = min(d.get(i, math.inf), math.sqrt(float(np.cumsum((np.array(a) - np.array(x)) ** 2)[-1])))
        out += [(q, n + 1, i, s) for n, (s, i) in enumerate(sorted((s, i) for i, s in d.items())[:k])]
    return sorted(out)


def test_neighbours_sql(spark):
    assert assert_same(neighbours.op11_neighbours(spark, SF), connect(SF), neighbours.OP11_SQL) == 50


@pytest.mark.parametrize("sizes", [(2048, 1024, 2048, 1 << 26), (16, 3, 20, 1 << 26), (5, 2, 10, 200)])
def test_neighbours_hostile(spark, monkeypatch, sizes):
    for name, value in zip(("BLOCK", "TILE", "LEAST_GROUP", "GROUP_BYTES"), sizes, strict=True):
        monkeypatch.setattr(neighbours, name, value)
    rng = random.Random(5)
    base = [[rng.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(5)] for _ in range(30)]
    rows = [(i, rng.choice(base) if rng.random() < 0.7 else [rng.uniform(-3, 3) for _ in range(5)]) for i in range(900)]
    one, odd = [1.0] * 4, [(900, None), (1000, [0.0] * 5), (1100, [1.0, None, 1.0, 1.0, 1.0]), (None, [1.0] * 5), (1400, [1.0, 2.0]), (1401, [1.0, 2.5]), (1500, [])]
    odd += [(1200, [math.nan, *one]), (1300, [math.inf, *one]), (200, [9.0] * 5), (201, [9.0] * 5), (201, [9.0] * 5), (300, base[0]), (300, base[0]), (7, [0.0, -0.0, 1.0, 0.0, 0.0]), (0, [-0.0, 0.0, 1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS id", "2 AS vector", "3 AS cell").repartition(5)
    assert sorted(map(tuple, neighbours.nearest(df, F.col("id") % 100 == 0).collect())) == plain_nearest(rows + odd)
    assert neighbours.nearest(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_tile_bounds_hold_and_are_tight():
    rng = np.random.default_rng(2)
    for dim in (3, 64, 1500):
        a, b = (neighbours.Block(np.arange(40), rng.normal(size=(40, dim)).astype("<f4")) for _ in range(2))
        low, high = neighbours.bounds(a, slice(0, 40), b)
        true = np.sqrt(((a.vectors[:, None].astype(float) - b.vectors[None].astype(float)) ** 2).sum(axis=2))
        assert (low <= true).all() and (true <= high).all() and (high - low).max() < 0.05 * true.mean()
        assert (neighbours.product(a, slice(0, 40), b) == a.codes.astype(np.int64) @ b.codes.astype(np.int64).T).all()


def test_equal_vectors_keep_the_smallest_ids():
    ids, v = np.array([9, 3, 3, 5, 1, 7]), np.array([[1, 0], [1, 0], [1, 0], [1, -0.0], [2, 0], [1, 0]], dtype="<f4")
    assert sorted(ids[neighbours.first_copies(ids, v, 2)].tolist()) == [1, 3, 5]


# ------------------------------------------------------------- 12 periodic runs


def plain_runs(w, least=12):
    n, out = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            if w[i] != w[i + p]:
                i += 1
                continue
            a = i
            while i < n - p and w[i] == w[i + p]:
                i += 1
            if i - a + p >= max(least, 2 * p):
                out.setdefault((a, i - a + p), p)
    return sorted((s, n, p) for (s, n), p in out.items())


def test_runs_against_every_period():
    rng = random.Random(1)
    for _ in range(300):
        docs = []
        for _ in range(rng.randint(1, 6)):
            n, k = rng.choice([0, 1, 5, 12, 13, 30, 80, 200]), rng.choice([1, 2, 3, 6, 50])
            d = [rng.randint(1, k) for _ in range(n)]
            if n > 20 and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, n // 4)
                d = [d[i] if i < a else d[a + (i - a) % p] for i in range(n)]
            docs.append(d)
        first, least = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64), rng.choice([12, 2, 5, 20])
        words = np.array([x for d in docs for x in d], dtype=np.uint64)
        assert periodic.find_runs(words, first, least) == [plain_runs(d, least) for d in docs]


def test_runs_within_runs():
    block = [1] * 20 + [2]
    runs = periodic.find_runs(np.array(block * 40, dtype=np.uint64), np.array([0, 840]))[0]
    assert (0, 840, 21) in runs and len(runs) == 41


def test_periodic_query(spark, texts):
    rows = QUERIES["op12_periodic_runs"][0](spark, SF).collect()
    assert len(rows) == len(texts) and any(r["n_runs"] for r in rows)
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or "")
        n, h = len(w), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        m, s, q = min(((-m, s, q) for s, m, q in runs), default=(None,) * 3)
        best = (s, -m, q, -1000 * m // q) if runs else (None,) * 4
        lines, kept = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda x: (x[0], x[2]))), " ".join(x for i, x in enumerate(w) if i not in gone)
        assert tuple(r) == (r["doc_id"], len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_periodic_hostile(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a " * 50_000), (None, "b " * 13 + "é"), (5, "x" * 20_000), (5, "x" * 20_000), (6, "A a " * 7), (7, "end " + "x " * 14)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS runs", "2 AS _w", "3 AS collapsed")
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(df).collect()]
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 50_000, [(0, 50_000, 1)], "a"), (None, 14, [(0, 13, 1)], "b é"), (5, 1, [], "x" * 20_000), (5, 1, [], "x" * 20_000)]
    want += [(6, 14, [(0, 14, 2)], "A a"), (7, 15, [(1, 14, 1)], "end x")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.periodic_runs(df.limit(0)).count() == 0 and periodic.with_planted_runs(df).count() == len(rows)


# ------------------------------------------------------------- 13 spelling


def plain_spelling(rows):
    c = Counter()
    for i, t in rows:
        for w in re.findall(r"[A-Za-zÀ-ÿ]+", lower(t)):
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            c[w] += 1
    v = {w: n for w, n in c.items() if len(w) >= 5 and n >= 3}
    letters, out = sorted({x for w in v for x in w}), {}
    for w in v:
        near = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + a + w[i + k :] for i in range(len(w) + 1) for a in letters for k in (0, 1)}
        near = {x for x in near if x in v and x != w}
        n, form = min(((-v[x], x) for x in near), default=(0, None))
        out[w] = (form, v[w], len(near), -n) if -n >= 2 * v[w] else (None, v[w], len(near), None)

    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w

    return sorted(((w, f, root(w), n, k, fn) for w, (f, n, k, fn) in out.items()), key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()), key=str)


def test_spelling_query(spark, texts):
    got = rows_of(QUERIES["op13_spelling"][0](spark, SF))
    assert got == plain_spelling(texts.items()) and any(r[1] and r[1] != r[2] for r in got)


def test_spelling_hostile(spark):
    rng = random.Random(3)
    rows = [(None if k % 7 == 0 else k, " ".join("".join(rng.choice("aabé") for _ in range(rng.choice([4, 5, 5, 6, 7]))) for _ in range(60))) for k in range(40)]
    rows += [(1, None), (2, ""), (2, "Aaaaa ÀAAAA aaaaa"), (2, "Aaaaa ÀAAAA aaaaa"), (3, "Àaaaa " * 3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS word", "2 AS n")
    got = rows_of(spelling.spelling_groups(spelling.with_planted_slips(spelling.letter_runs(df))))
    assert got == plain_spelling(rows) and len(got) > 100
    assert spelling.spelling_groups(spelling.letter_runs(df.limit(0))).count() == 0


def test_near_pairs_come_once(spark):
    words = ["aaaaa", "aaaaaa", "aabaa", "abaaa", "baaaa", "ababa", "aabba", "aaaab"]
    v = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    got = Counter((r["word"], r["near"]) for r in spelling.near_pairs(v).collect())

    def apart(a, b):
        return len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1 or any(a == b[:i] + b[i + 1 :] for i in range(len(b))) or any(b == a[:i] + a[i + 1 :] for i in range(len(a)))

    assert got == Counter((a, b) for a in words for b in words if a != b and apart(a, b))
