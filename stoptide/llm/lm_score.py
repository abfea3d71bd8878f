"""Language-model scoring by a weighted backoff automaton over words.

States are the empty context, words, and word pairs; an arc reads a word, and a failure arc drops the
oldest word at a price. Every training word and pair is an arc, and every triple that occurs
``LEAST_ARC`` times or more, whatever the size of the corpus. With counts c, n and n of words, pairs
and triples, N training tokens and V distinct ones:

* p(w) = (c(w) + FLOOR) / (N + FLOOR * (V + 1)), the one beside the V standing for all unknown words;
* p(w | b) = (n(b w) + PRIOR * p(w)) / (c(b) + PRIOR): the arc's weight; failing costs PRIOR / (c(b) + PRIOR);
* p(w | a b) = (n(a b w) - DISCOUNT) / n(a b), if that triple is an arc, plus p(w | b) times what the
  arcs of a b leave over, which is what failing costs.

Each sums to one over all words. A text is read once from left to right: from the state that the words
so far have led to, the arc of the next word is taken, after as many failures as it needs; their
logarithms add up, and the arc's target is the next state. A state is the longest of pair, word and
nothing that was trained on, so any two words fix it. A long text is therefore read in several spans
side by side, each of which is entered two words early.

No table of arcs is sent whole. Documents are packed into blocks of bounded size. A block asks ranges
of word hashes, and ranges of pair hashes with the words that follow each pair, for the counts of all
blocks; keys travel sorted and packed, once there, and only counts come back, from which the block
builds the part of the automaton that its texts can reach. Of a word's hash 56 bits travel, of a
pair's 48, of a following word's 28 beside its pair.

Defined results: null or empty text is its end alone; rows without an id are scored and neither
train nor are held out; repeated rows count and are scored each; without training rows all
probabilities are 1 and scores 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.llm.common import crc_mod, give_back, hashed_words, mix, packed, read_table, stored, unpacked

#: Tokens of a block, and bytes of text to a range of pairs.
BLOCK_TOKENS, RANGE_BYTES = 1_250_000, 16_000_000
#: The smoothing: what every word has beside its count, the weight of the lower order under a word, what
#: a triple's count is lowered by, and the least count of a triple that makes an arc.
FLOOR, PRIOR, DISCOUNT, LEAST_ARC = 0.5, 10.0, 0.5, 2
#: Tokens of a span: texts of a block are read side by side, longer ones as several spans.
SPAN = 512
#: The end of a text, as a word's hash.
END = np.uint64(0xE0D0E0D0E0D0D1)
#: Bits of the hashes of words, of pairs, and of words that follow a pair.
WORD_BITS, PAIR_BITS, FOLLOW_BITS = 56, 48, 28
_LEFT = np.uint64(0x9E3779B97F4A7C15)


def _tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per piece of the column: its rows, their tokens on end (each text's end included), first token of each."""
    for i, j, words, first in hashed_words(texts):
        out = np.full(len(words) + (j - i), END, dtype=np.uint64)
        out[np.arange(len(words)) + np.repeat(np.arange(j - i), np.diff(first))] = words >> np.uint64(64 - WORD_BITS)
        yield i, j, out, first + np.arange(j - i + 1)


def _ranges(keys: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Where each range of ascending keys of so many bits begins (one more at the end)."""
    return np.searchsorted((keys >> np.uint64(bits - 32)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))


class Grams:
    """The distinct pairs and triples of texts, and where they stand.

    ``pairs`` are hashes in order; ``pair[i]`` is that of the i-th place ``at2`` that ends one.
    ``follow`` are the last words of the distinct triples in order of their first two words' pair
    (``fan`` of each pair); ``triple[i]`` and ``context[i]`` are the triple and the pair before the
    i-th place ``at3`` that ends a triple.
    """

    def __init__(self, flat: np.ndarray, first: np.ndarray):
        left = np.ones(len(flat), dtype=bool)
        left[first[:-1]] = False
        self.at2 = np.flatnonzero(left)
        self.pairs, self.pair = np.unique(mix(flat[self.at2 - 1] * _LEFT + flat[self.at2]) >> np.uint64(64 - PAIR_BITS), return_inverse=True)
        inner = left[self.at2 - 1]
        self.at3 = self.at2[inner]
        self.context = self.pair[np.flatnonzero(inner) - 1]
        keys, self.triple = np.unique(self.context.astype(np.uint64) << np.uint64(FOLLOW_BITS) | flat[self.at3] >> np.uint64(WORD_BITS - FOLLOW_BITS), return_inverse=True)
        self.follow = (keys & np.uint64((1 << FOLLOW_BITS) - 1)).astype(np.uint32)
        self.fan = np.bincount((keys >> np.uint64(FOLLOW_BITS)).astype(np.int64), minlength=len(self.pairs))


BLOCK_SCHEMA = "block bigint, body binary, words binary, sizes array<int>, train array<boolean>, held array<boolean>, doc_ids array<{id}>"


def blocks_of(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, train, held) as blocks: the documents' ids, sizes and flags, all their tokens
    as the block's word numbers (common words first), and the words' hashes in order, their training
    counts and their numbers."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held_tokens, id_kind = TaskContext.get().partitionId(), 0, 0, None
        tokens: list[np.ndarray] = []
        ids: list = []
        train: list[bool] = []
        held: list[bool] = []

        def flush() -> pa.RecordBatch:
            nonlocal number, held_tokens
            words, back = np.unique(np.concatenate(tokens), return_inverse=True)
            sizes = np.array([len(x) for x in tokens], dtype=np.int32)
            counts = np.bincount(back[np.repeat(np.array(train), sizes)], minlength=len(words))
            rank = np.empty(len(words), dtype=np.uint64)
            rank[np.argsort(-np.bincount(back, minlength=len(words)), kind="stable")] = np.arange(len(words), dtype=np.uint64)
            planes = np.ascontiguousarray(rank[back].astype("<u4").view(np.uint8).reshape(-1, 4).T)
            cols = [[part * (1 << 30) + number], [zstandard.ZstdCompressor(level=3).compress(planes.tobytes())], [packed(words, counts.astype(np.uint64), rank)], [sizes], [list(train)], [list(held)]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.bool_())]
            names = ["block", "body", "words", "sizes", "train", "held", "doc_ids"]
            out = pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), pa.array([list(ids)], pa.list_(id_kind))], names=names)
            number, held_tokens = number + 1, 0
            for x in (tokens, ids, train, held):
                x.clear()
            return out

        for b in batches:
            id_kind = b.schema.field(0).type
            own, b_train, b_held = b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()
            for i, j, words, first in _tokens(b.column(1)):
                for k in range(i, j):
                    tokens.append(words[first[k - i] : first[k - i + 1]].copy())
                    ids.append(own[k])
                    train.append(b_train[k])
                    held.append(b_held[k])
                    held_tokens += len(tokens[-1])
                    if held_tokens >= BLOCK_TOKENS:
                        yield flush()
        if tokens:
            yield flush()
        give_back()

    return docs.select("doc_id", "text", "train", "held").mapInArrow(run, BLOCK_SCHEMA.format(id=id_type))


def _unpacked_block(body: bytes, words: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's word numbers, first token of each text, and its words' hashes in order, counts and numbers."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), dtype=np.uint8)
    ids = np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view("<u4").astype(np.int64)
    keys, counts, rank = unpacked(words, 3)
    return ids, np.append([0], np.cumsum(sizes, dtype=np.int64)), keys, counts, rank.astype(np.int64)


def word_counts(blocks: DataFrame, parts: int) -> DataFrame:
    """(block, part, body): the training counts, over all blocks, of each block's words by ranges; and per
    range the number of its tokens and of its words that were trained on (n, v)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keys, counts, _ = unpacked(words, 3)
                edge = _ranges(keys, WORD_BITS, parts)
                asked = [k for k in range(parts) if edge[k] < edge[k + 1]]
                bodies = [packed(keys[edge[k] : edge[k + 1]], counts[edge[k] : edge[k + 1]]) for k in asked]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(asked), pa.int64()), pa.array(asked, pa.int32()), pa.array(bodies, pa.binary())], names=["block", "part", "body"])

    def answer(part: pa.Table) -> pa.Table:
        held = [unpacked(x, 2) for x in part["body"].to_pylist()]
        keys, back = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
        counts = np.bincount(back, weights=np.concatenate([x[1] for x in held]), minlength=len(keys)).astype(np.uint64)
        cut = np.cumsum([0, *(len(x[0]) for x in held)])
        bodies = [packed(counts[back[a:b]], ascending=False) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        first = [0] * (len(held) - 1)
        return pa.table({"block": part["block"], "part": part["part"], "body": pa.array(bodies, pa.binary()), "n": pa.array([int(counts.sum()), *first]), "v": pa.array([int((counts > 0).sum()), *first])})

    asked = blocks.select("block", "words").mapInArrow(ask, "block bigint, part int, body binary")
    return asked.groupBy("part").applyInArrow(answer, "block bigint, part int, body binary, n bigint, v bigint")


def gram_counts(blocks: DataFrame, parts: int) -> DataFrame:
    """(block, part, body, more): over all blocks, of each block's pairs by ranges the training counts, the
    sums and the numbers of arcs that follow them (body), and of its triples the counts of arcs (more)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                one = b.slice(row, 1)
                sizes = one.column(3).flatten().to_numpy()
                ids, first, keys, _, rank = _unpacked_block(one.column(1)[0].as_py(), one.column(2)[0].as_py(), sizes)
                hashes = np.empty(len(keys), dtype=np.uint64)
                hashes[rank] = keys
                train = np.repeat(one.column(4).flatten().to_numpy(zero_copy_only=False), sizes)
                g = Grams(hashes[ids], first)
                del ids
                n2 = np.bincount(g.pair[train[g.at2]], minlength=len(g.pairs)).astype(np.uint64)
                n3 = np.bincount(g.triple[train[g.at3]], minlength=len(g.follow)).astype(np.uint32)
                edge, begin = _ranges(g.pairs, PAIR_BITS, parts), np.append([0], np.cumsum(g.fan))
                asked = [k for k in range(parts) if edge[k] < edge[k + 1]]
                pairs = [packed(*(x[edge[k] : edge[k + 1]] for x in (g.pairs, n2, g.fan.astype(np.uint64)))) for k in asked]
                more = [packed(*(x[begin[edge[k]] : begin[edge[k + 1]]] for x in (g.follow, n3)), ascending=False) for k in asked]
                del g
                yield pa.RecordBatch.from_arrays([pa.array([one.column(0)[0].as_py()] * len(asked), pa.int64()), pa.array(asked, pa.int32()), pa.array(pairs, pa.binary()), pa.array(more, pa.binary())], names=["block", "part", "body", "more"])
        give_back()

    def answer(part: pa.Table) -> pa.Table:
        held = [unpacked(x, 3) for x in part["body"].to_pylist()]
        more = [unpacked(x, 2, np.uint32, ascending=False) for x in part["more"].to_pylist()]
        pairs, pair = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
        n2 = np.bincount(pair, weights=np.concatenate([x[1] for x in held]), minlength=len(pairs)).astype(np.uint64)
        context = np.repeat(pair, np.concatenate([x[2] for x in held]).astype(np.int64)).astype(np.uint64)
        triples, triple = np.unique(context << np.uint64(FOLLOW_BITS) | np.concatenate([x[0] for x in more]), return_inverse=True)
        n3 = np.bincount(triple, weights=np.concatenate([x[1] for x in more]), minlength=len(triples)).astype(np.uint64)
        n3[n3 < LEAST_ARC] = 0
        under = (triples >> np.uint64(FOLLOW_BITS)).astype(np.int64)
        s, t = np.bincount(under, weights=n3, minlength=len(pairs)).astype(np.uint64), np.bincount(under[n3 > 0], minlength=len(pairs)).astype(np.uint64)
        cut, cut3 = np.cumsum([0, *(len(x[0]) for x in held)]), np.cumsum([0, *(len(x[0]) for x in more)])
        bodies = [packed(*(x[pair[a:b]] for x in (n2, s, t)), ascending=False) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        counts = [packed(n3[triple[a:b]], ascending=False) for a, b in zip(cut3[:-1], cut3[1:], strict=True)]
        return pa.table({"block": part["block"], "part": part["part"], "body": pa.array(bodies, pa.binary()), "more": pa.array(counts, pa.binary())})

    asked = blocks.select("block", "body", "words", "sizes", "train").mapInArrow(ask, "block bigint, part int, body binary, more binary")
    return asked.groupBy("part").applyInArrow(answer, "block bigint, part int, body binary, more binary")


class Automaton:
    """States, arcs and failure arcs; weights are log10 probabilities.

    State 0 is the empty context, 1 to ``words`` are the words, those after it the pairs. ``keys`` are
    state * words + word of all arcs, in order, with their ``weights`` and ``targets``; ``fail_to`` and
    ``fail_cost`` are the failure arc of each state. The empty context has an arc for every word.
    """

    def __init__(self, words: int, arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], fail_to: np.ndarray, fail_cost: np.ndarray):
        self.words, self.fail_to, self.fail_cost = words, fail_to, fail_cost
        keys = np.concatenate([state * words + word for state, word, _, _ in arcs])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.weights, self.targets = (np.concatenate([x[k] for x in arcs])[order] for k in (2, 3))

    def read(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each state reads one word: the weight, failures included, and the next state."""
        weight, after, at = np.zeros(len(state)), np.empty(len(state), dtype=np.int64), np.arange(len(state))
        while len(at):
            key = state * self.words + word
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            has = self.keys[arc] == key
            weight[at[has]] += self.weights[arc[has]]
            after[at[has]] = self.targets[arc[has]]
            at, state, word = at[~has], state[~has], word[~has]
            weight[at] += self.fail_cost[state]
            state = self.fail_to[state]
        return weight, after

    def traverse(self, ids: np.ndarray, first: np.ndarray, span: int = SPAN) -> np.ndarray:
        """The weight of every token: all texts are read side by side, a token a step."""
        sizes = np.diff(first)
        spans = -(-sizes // span)
        text = np.repeat(np.arange(len(sizes)), spans)
        start = first[text] + span * (np.arange(len(text)) - np.repeat(np.cumsum(spans) - spans, spans))
        stop = np.minimum(start + span, first[text + 1])
        enter = np.maximum(start - 2, first[text])
        longest = np.argsort(enter - stop, kind="stable")
        start, stop, enter = start[longest], stop[longest], enter[longest]
        weights, state = np.zeros(len(ids)), np.zeros(len(start), dtype=np.int64)
        for step in range(int((stop - enter).max(initial=0))):
            n = int(np.searchsorted(enter - stop, -step, side="left"))  # spans that aren't read to their end
            at = enter[:n] + step
            weight, state = self.read(state[:n], ids[at])
            own = at >= start[:n]
            weights[at[own]] = weight[own]
        return weights


def automaton_of(ids: np.ndarray, g: Grams, c: np.ndarray, n2: np.ndarray, s: np.ndarray, t: np.ndarray, n3: np.ndarray, total: int, distinct: int) -> Automaton:
    """The part of the automaton that a block's texts reach, from the counts of its words (c), of its pairs
    (n2, with the sums s and numbers t of the arcs that follow them) and of its triples (n3)."""
    words, pairs = len(c), len(g.pairs)
    one = (c + FLOOR) / (total + FLOOR * (distinct + 1))
    everything = np.arange(words)
    ends = np.empty(pairs, dtype=np.int64)  # a place that ends each pair
    ends[g.pair] = g.at2
    left, right = ids[ends - 1], ids[ends]
    two = (n2 + PRIOR * one[right]) / (c[left] + PRIOR)
    known = np.flatnonzero(n2 > 0)
    rest = np.ones(pairs)
    rest[known] = (n2 - s + DISCOUNT * t)[known] / n2[known]
    ends = np.empty(len(g.follow), dtype=np.int64)  # a place that ends each triple
    ends[g.triple] = g.at3
    context = np.empty(len(g.follow), dtype=np.int64)
    context[g.triple] = g.context
    last = np.full(len(ids), -1, dtype=np.int64)
    last[g.at2] = g.pair
    last = last[ends]
    arc = np.flatnonzero(n3 > 0)
    three = (n3[arc] - DISCOUNT) / n2[context[arc]] + rest[context[arc]] * two[last[arc]]
    arcs = [
        (np.zeros(words, dtype=np.int64), everything, np.log10(one), np.where(c > 0, 1 + everything, 0)),
        (1 + left[known], right[known], np.log10(two[known]), 1 + words + known),
        (1 + words + context[arc], ids[ends[arc]], np.log10(three), 1 + words + last[arc]),
    ]
    fail_to = np.concatenate([[0], np.zeros(words, dtype=np.int64), 1 + right])
    with np.errstate(divide="ignore"):  # nothing fails from a pair whose arcs leave nothing over
        fail_cost = np.log10(np.concatenate([[1.0], PRIOR / (c + PRIOR), rest]))
    return Automaton(words, arcs, fail_to, fail_cost)


def score_texts(docs: DataFrame) -> DataFrame:
    """From (doc_id, text, train, held), per row: held_out, n_tokens, n_known, train_tokens, base_score, score."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text", *(F.coalesce(x, F.lit(False)).alias(x) for x in ("train", "held")))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // RANGE_BYTES
    blocks = stored(blocks_of(docs), "lm")
    words = stored(word_counts(blocks, 1 + parts // 16), "words")
    row = words.agg(F.sum("n"), F.sum("v")).first()
    total, distinct = int(row[0] or 0), int(row[1] or 0)
    kinds = {"block": "bigint", "part": "int", "body": "binary", "more": "binary", "words": "binary", "sizes": "array<int>", "held": "array<boolean>", "doc_ids": f"array<{id_type}>"}

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), *(F.col(x) if x in df.columns else F.lit(None).cast(t).alias(x) for x, t in kinds.items()))

    rows = shaped(blocks, 0).union(shaped(words.drop("n", "v"), 1)).union(shaped(gram_counts(blocks, parts), 2))

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("kind", "ascending"), ("part", "ascending")])
        kind, bodies = block["kind"].to_numpy(), block["body"].to_pylist()
        sizes = block["sizes"][0].values.to_numpy()
        ids, first, keys, _, rank = _unpacked_block(bodies[0], block["words"][0].as_py(), sizes)
        answers = [unpacked(bodies[k], 1, ascending=False)[0] for k in np.flatnonzero(kind == 1).tolist()]
        c, h = np.empty(len(keys)), np.empty(len(keys), dtype=np.uint64)
        c[rank], h[rank] = np.concatenate(answers), keys
        grams = np.flatnonzero(kind == 2).tolist()
        counts = [unpacked(bodies[k], 3, ascending=False) for k in grams] or [[np.zeros(0, np.uint64)] * 3]
        n2, s, t = (np.concatenate(x).astype(np.float64) for x in zip(*counts, strict=True))
        n3 = np.concatenate([np.zeros(0, np.uint64), *(unpacked(x, 1, ascending=False)[0] for x in block["more"].to_pylist() if x is not None)]).astype(np.float64)
        base = np.log10((c + 1.0) / (total + distinct + 1.0))
        logp = np.zeros(len(ids))
        if total:
            logp = automaton_of(ids, Grams(h[ids], first), c, n2, s, t, n3, total, distinct).traverse(ids, first)
        n = len(sizes)
        return pa.table(
            {
                "doc_id": block["doc_ids"][0].values, "held_out": block["held"][0].values,
                "n_tokens": pa.array(sizes.astype(np.int64)), "n_known": pa.array(np.add.reduceat((c[ids] > 0).astype(np.int64), first[:-1])),
                "train_tokens": pa.array(np.full(n, total, dtype=np.int64)), "base_score": pa.array(np.add.reduceat(base[ids], first[:-1])), "score": pa.array(np.add.reduceat(logp, first[:-1])),
            }
        )

    return rows.groupBy("block").applyInArrow(run, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the whole of ``documents``, learned from the rows that aren't held out."""
    rest = crc_mod(F.col("doc_id"), 7)
    docs = read_table(spark, sf_dir, "documents")
    return score_texts(docs.select("doc_id", "text", F.coalesce(rest != 2, F.lit(False)).alias("train"), F.coalesce(rest == 2, F.lit(False)).alias("held")))
