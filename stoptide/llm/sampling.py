"""SentencePiece encoding and decoding: distinct sampled segmentations by perturbed A-star search.

A text's lattice has an arc for every vocabulary piece that fits; a segmentation's probability is
the product of its pieces' weights over the sum of all segmentations. Gumbel top-k: the root of the
search stands for all segmentations and gets a Gumbel value; each step keeps the value on a sampled
arc and draws, for the set of the arcs not taken, the largest value below it. The set with the
largest value is opened next, so the first k paths are a sample of k without replacement. The value
of the best set left over is the threshold from which inclusion probabilities follow.

No piece crosses a blank, so the lattice is built once for each distinct blank-led chunk of a piece
of documents; all chunks are sampled side by side, and all documents of a piece are searched side by
side. Random numbers are hashes of the row's key and place, and what is summed across chunks is
summed in whole numbers, so results don't depend on partitions or retries. Memory is bounded by one
piece.

Weights: the vocabulary file is a BPE model whose scores are ranks; a piece of rank r weighs
1 / (r + ``RANK_OFFSET``). A character outside the vocabulary is its UTF-8 bytes' pieces, and so is
the character that pieces use for a blank, where the text itself holds it.

Defined results: null or empty text has one segmentation, the empty one, with probability 1; texts
with fewer than k segmentations get all they have, each with inclusion 1; rows are keyed by their id,
of any type, and rows without an id by their text; repeated rows get the same samples; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.llm.common import give_back, mix, pieces, read_table, text_bytes

RANK_OFFSET = 20
BLANK = "▁"
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_P = 0x100000001B3
#: Bytes of text that are searched side by side.
TEXT_BYTES = 500_000
#: Probabilities of arcs are whole multiples of 1 / ONE, logarithms on paths of 1 / FINE.
ONE, FINE = float(1 << 40), float(1 << 36)
#: Stands for the blank's character where a text itself holds it; no text holds this code point.
_OWN_BLANK = 0xD800


def default_vocabulary() -> str:
    """The public 32k piece vocabulary's path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _number(x: np.ndarray) -> np.ndarray:
    """A mixed hash as a number in (0, 1)."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def _seed(*parts: np.ndarray) -> np.ndarray:
    x = parts[0]
    for c, p in zip(_C, parts[1:], strict=False):
        x = mix(x * _C[3] + p * c)
    return x


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranges of so many numbers from each start, on end."""
    return np.arange(int(counts.sum())) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


class Vocabulary:
    """Pieces with log-weights and a hash lookup from code point strings."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.raw = [bytes([int(x[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else x.replace(BLANK, " ").encode() for i, x in enumerate(names)]
        ids = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)) and names[i]]
        weights = 1.0 / (np.arange(len(ids)) + RANK_OFFSET)
        self.byte_logp = float(np.log(weights[-1] / weights.sum()) - 2)
        self.logp = np.log(weights / weights.sum())
        self.ids = np.array(ids)
        self.names = [names[i] for i in ids]
        self.longest = max(map(len, self.names))
        self.keys = np.array([self._hash(x) for x in self.names], dtype=np.uint64)
        self.raw_size = np.array([len(x) for x in self.raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.raw_bytes = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        self.tables, left = [], np.arange(len(ids))
        for shift in (43, 22, 1):  # a piece whose slot is taken goes to the next table
            table = np.full(1 << 21, -1, dtype=np.int32)
            slot = ((self.keys[left] >> np.uint64(shift)) & np.uint64((1 << 21) - 1)).astype(np.int64)
            _, keep = np.unique(slot, return_index=True)
            table[slot[keep]] = left[keep]
            self.tables.append((np.uint64(shift), table))
            left = np.delete(left, keep)
        if len(left) or len(np.unique(self.keys)) < len(ids):
            raise ValueError("the vocabulary's hashes collide")

    @staticmethod
    def _hash(s: str) -> int:
        h = 0
        for c in s:
            h = (h * _P + ord(c) + 1) % (1 << 64)
        return int(mix(np.array([h], dtype=np.uint64))[0])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The pieces' numbers, -1 where there is none."""
        hashes = mix(hashes)
        out = np.full(len(hashes), -1, dtype=np.int32)
        todo = slice(None)
        for shift, table in self.tables:
            own = hashes[todo]
            at = table[((own >> shift) & np.uint64((1 << 21) - 1)).astype(np.int64)]
            taken = np.flatnonzero(at >= 0)
            good = self.keys[at[taken]] == own[taken]
            spot = taken if isinstance(todo, slice) else todo[taken]
            out[spot[good]] = at[taken[good]]
            todo = spot[~good]  # a taken slot with another key: the piece may be in the next table
            if not len(todo):
                break
        return out

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that pieces stand for, on end."""
        return self.raw_bytes[_ragged(self.raw_start[ids], self.raw_size[ids])]

    def decode(self, ids: list[int]) -> str:
        """The text that pieces stand for."""
        return self.spelled(np.array(ids, dtype=np.int64)).tobytes().decode("utf-8", "replace")[1:]


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattice:
    """The lattices of many chunks: nodes are code points, arcs are grouped by their start.

    ``points`` are the code points of all chunks on end, ``size`` how many each chunk has. Nodes are
    numbered from the chunks' ends back: first all last code points, then all last but one, and so on.
    """

    #: So many code points before a chunk's end, what is left of few chunks is worked through one by one.
    LEVELS, FEW = 64, 4
    #: Weights are scaled so that a character by itself weighs this; scales are renewed every so many code points.
    SINGLE, RENEW = 2.0**-9, 32

    def __init__(self, points: np.ndarray, size: np.ndarray, v: Vocabulary):
        n, wide = len(points), v.longest
        order = np.argsort(-size, kind="stable")
        rank = np.empty(len(size), dtype=np.int64)
        rank[order] = np.arange(len(size))
        levels = int(size.max()) if len(size) else 0
        #: The first node of each level: how many code points are left, its own included.
        floor = np.zeros(levels + 2, dtype=np.int64)
        np.cumsum(np.cumsum(np.bincount(size, minlength=levels + 1)[:0:-1])[::-1] if levels else [], out=floor[2:] if levels else None)
        left = np.repeat(np.cumsum(size), size) - np.arange(n)
        owner = np.repeat(rank, size)
        self.start = floor[size] + rank
        moved = np.empty(n, dtype=points.dtype)
        moved[floor[left] + owner] = points
        left, owner = np.repeat(np.arange(levels + 1), np.diff(floor)), np.arange(n)
        owner -= floor[left]
        froms, tos, found = [], [], []
        count, single = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        where, rest, mine, h = np.arange(n), left, owner, np.zeros(n, dtype=np.uint64)
        for length in range(1, wide + 1):
            now = floor[rest] + mine  # the node of the length's last code point
            h = h * np.uint64(_P) + moved[now].astype(np.uint64) + np.uint64(1)
            piece = v.find(h)
            if length == 1:
                single[:] = piece
            hit = np.flatnonzero(piece >= 0)
            froms.append(where[hit])
            tos.append(np.where(rest[hit] > 1, floor[rest[hit] - 1] + mine[hit], n))
            found.append(piece[hit].astype(np.int64))
            count[where[hit]] += 1
            on = int(np.searchsorted(rest, 2))  # levels stand in ascending order
            where, rest, mine, h = where[on:], rest[on:] - 1, mine[on:], h[on:]
            if not len(where):
                break
        bare = np.flatnonzero(single < 0)  # characters that only bytes can spell
        odd, which = np.unique(moved[bare], return_inverse=True)
        spelt = [[v.byte_id[y] for y in (BLANK if x == _OWN_BLANK else chr(x)).encode()] for x in odd.tolist()]
        single[bare] = len(v.ids) + which
        froms.insert(0, bare)
        tos.insert(0, np.where(left[bare] > 1, floor[left[bare] - 1] + owner[bare], n))
        found.insert(0, single[bare])
        count[bare] += 1
        logw = np.concatenate([v.logp, [len(x) * v.byte_logp for x in spelt]])
        self.first = np.concatenate([[0], np.cumsum(count)])
        #: By piece, those of the odd characters included: its ids on end.
        self.id_size = np.concatenate([np.ones(len(v.ids), dtype=np.int64), np.array([len(x) for x in spelt], dtype=np.int64)])
        self.id_start = np.cumsum(self.id_size) - self.id_size
        self.id_list = np.concatenate([v.ids, np.array([y for x in spelt for y in x], dtype=np.int64)])
        arcs, next_ = int(self.first[-1]), self.first[:-1].copy()
        self.to, self.piece = np.empty(arcs, dtype=np.int64), np.empty(arcs, dtype=np.int64)
        for a, b, x in zip(froms, tos, found, strict=True):  # an arc of each length from a node at most
            spot = next_[a]
            self.to[spot], self.piece[spot] = b, x
            next_[a] += 1
        self.at = np.repeat(np.arange(n), count)
        self.last = self.to == n
        #: The id of an arc's piece, -1 if it has several.
        self.id = np.where(self.id_size[self.piece] == 1, self.id_list[self.id_start[self.piece]], -1)
        # what a character by itself weighs is taken out of every arc over it, so that sums stay in range
        alone = logw[single] - np.log(self.SINGLE)
        depth = np.zeros(n + 1)  # by node the sum of its own and all later characters of its chunk
        for j in range(1, levels + 1):
            lo, hi = floor[j], floor[j + 1] if j < levels else n
            depth[lo:hi] = alone[lo:hi] + (depth[floor[j - 1] : floor[j - 1] + hi - lo] if j > 1 else 0.0)
            if j >= self.LEVELS and hi - lo <= self.FEW:
                for r in range(hi - lo):
                    nodes = floor[j:-1][floor[j:-1] + r < np.append(floor[j + 1 : -1], n)] + r
                    depth[nodes] = np.cumsum(np.concatenate([depth[lo + r : lo + r + 1], alone[nodes[1:]]]))
                break
        weight = np.exp(logw[self.piece] - (depth[self.at] - depth[self.to]))
        q = self._shares(weight, floor, levels, n)
        self.fine = np.round(np.log(q) * FINE).astype(np.int64)
        # per node its likeliest arc, tried first; the others share one rising line, so one search picks among them
        self.q = np.maximum(1, np.round(q * ONE)).astype(np.int64)
        self.whole = np.add.reduceat(self.q, self.first[:-1]) if n else count
        self.likely, self.top = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        if n:
            self.top = np.maximum.reduceat(self.q, self.first[:-1])
            hit = np.flatnonzero(self.q == self.top[self.at])[::-1]
            self.likely[self.at[hit]] = hit
        others = self.q.copy()
        others[self.likely] = 0
        self.line = np.cumsum(others)
        self.base = np.concatenate([[0], self.line])[self.first[:-1]]

    def _shares(self, weight: np.ndarray, floor: np.ndarray, levels: int, n: int) -> np.ndarray:
        """By arc its part of the weight of all ways from its node to the chunk's end."""
        q, total = np.empty(len(weight)), np.ones(n + 1)
        for j in range(1, levels + 1):
            lo, hi = int(floor[j]), int(floor[j + 1]) if j < levels else n
            if j > self.LEVELS and hi - lo <= self.FEW:
                self._shares_one_by_one(weight, floor, j, hi - lo, q, total, n)
                break
            arcs = slice(int(self.first[lo]), int(self.first[hi]))
            value = weight[arcs] * total[self.to[arcs]]
            total[lo:hi] = np.add.reduceat(value, self.first[lo:hi] - arcs.start)
            q[arcs] = value / total[self.at[arcs]]
            if j % self.RENEW == 0 and j < levels:
                m = (int(floor[j + 2]) if j + 1 < levels else n) - hi  # chunks that go on
                now = total[lo : lo + m].copy()
                for x in range(max(1, j - self.RENEW + 1), j + 1):
                    total[floor[x] : floor[x] + m] /= now
        return q

    def _shares_one_by_one(self, weight: np.ndarray, floor: np.ndarray, level: int, m: int, q: np.ndarray, total: np.ndarray, n: int) -> None:
        tops = [int(x) for x in floor] + [n]
        for r in range(m):
            held = {tops[x] + r: float(total[tops[x] + r]) for x in range(max(1, level - self.RENEW), level)}
            for j in range(level, len(floor)):
                node = tops[j] + r
                if node >= (tops[j + 1] if j + 1 < len(tops) else n):
                    break
                a, b = int(self.first[node]), int(self.first[node + 1])
                value = [w * held[x] for w, x in zip(weight[a:b].tolist(), self.to[a:b].tolist(), strict=True)]
                whole = float(np.add.reduceat(value, [0])[0])  # rounds as the sums side by side do
                q[a:b] = [x / whole for x in value]
                held[node] = whole
                if j % self.RENEW == 0:
                    held = {tops[x] + r: held[tops[x] + r] / whole for x in range(j - self.RENEW + 1, j + 1)}

    def walk(self, nodes: np.ndarray, seeds: np.ndarray, group: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Samples a way to its chunk's end from each node (-1: already there).

        The ways are laid on end, by groups of so many walkers, with room left before each group;
        returns arcs in order (-1: room) and how many each group has.
        """
        count = np.zeros(len(nodes), dtype=np.int64)
        steps = []
        live = np.flatnonzero(nodes >= 0)
        now, seed, step = nodes[live], seeds[live] * _C[3], 0
        while len(live) > (16 if step >= self.LEVELS else 0):
            u = _number(mix(seed + np.array([step], dtype=np.uint64) * _C[1]))
            r = (u * self.whole[now]).astype(np.int64)
            arc, more = self.likely[now], r - self.top[now]
            odd = np.flatnonzero(more >= 0)
            arc[odd] = np.searchsorted(self.line, self.base[now[odd]] + more[odd], side="right")
            steps.append((live, arc))
            count[live] += 1
            on = np.flatnonzero(~self.last[arc])
            live, now, seed = live[on], self.to[arc[on]], seed[on]
            step += 1
        tails = [self._walk_on(x, s, step) for x, s in zip(now.tolist(), seed, strict=True)]
        count[live] += np.array([len(x) for x in tails], dtype=np.int64)
        line = np.concatenate([[0], np.cumsum(count)])
        base = line[:-1] + np.repeat(np.cumsum(room), group)
        out = np.full(int(line[-1] + room.sum()), -1, dtype=np.int64)
        for k, (who, arc) in enumerate(steps):
            out[base[who] + k] = arc
        for who, arc in zip(live.tolist(), tails, strict=True):
            out[base[who] + step : base[who] + count[who]] = arc
        return out, np.diff(line[np.concatenate([[0], np.cumsum(group)])])

    def _walk_on(self, node: int, seed: np.uint64, step: int) -> list[int]:
        """The rest of a long chunk's way, arc by arc."""
        out: list[int] = []
        while True:
            places = np.arange(step, step + 1024, dtype=np.uint64)
            for u in _number(mix(seed + places * _C[1])).tolist():
                more = int(u * self.whole[node]) - self.top[node]
                arc = self.likely[node] if more < 0 else bisect_right(self.line, self.base[node] + more, self.first[node], self.first[node + 1])
                out.append(int(arc))
                if self.last[arc]:
                    return out
                node = self.to[arc]
            step += 1024


def chunks_of(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """The blank-led chunks of texts: code points of the distinct ones on end, the size of each, the
    number of each chunk in order, per text its first chunk, and all texts, led by a blank, with the
    first byte of each (one more at the ends)."""
    data, at = text_bytes(texts)
    led = (np.diff(at) > 0).astype(np.int64)
    shift = np.concatenate([[0], np.cumsum(led)])
    body = np.full(len(data) + int(shift[-1]), 0x20, dtype=np.uint8)
    body[np.arange(len(data)) + np.repeat(shift[1:], np.diff(at))] = data
    own = at + shift
    blank = body == 0x20
    starts = blank.copy()
    starts[1:] &= ~blank[:-1]
    starts[own[:-1][led > 0]] = True
    starts = np.flatnonzero(starts)
    offsets = np.append(starts, len(body))
    chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
    number, distinct = chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64), chunks.dictionary
    edge = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[: len(distinct) + 1] if len(distinct) else np.zeros(1, np.int64)
    raw = np.frombuffer(distinct.buffers()[2], dtype=np.uint8)[: edge[-1]] if len(distinct) else body[:0]
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32).copy()
    points[points == ord(BLANK)] = _OWN_BLANK
    points[points == 0x20] = ord(BLANK)
    return points, np.diff(heads[edge]), number, np.searchsorted(starts, own), body, own


class Samples:
    """What a piece's documents were sampled: per sample of order r, arcs on end, each document's
    first (``edge[r]``), the documents that have one (``has[r]``), and log-probabilities; ``kappa``."""

    def __init__(self, lattice: Lattice, body: np.ndarray, at: np.ndarray):
        self.lattice, self.body, self.at = lattice, body, at
        self.arcs: list[np.ndarray] = []
        self.edge: list[np.ndarray] = []
        self.has: list[np.ndarray] = []
        self.logp: list[np.ndarray] = []
        self.kappa = np.full(len(at) - 1, -np.inf)

    def ids(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the samples of order r on end, and the first of each document."""
        lat = self.lattice
        ids = lat.id[self.arcs[r]]
        if not len(ids) or ids.min() >= 0:
            return ids, self.edge[r]
        piece = lat.piece[self.arcs[r]]
        size = lat.id_size[piece]
        return lat.id_list[_ragged(lat.id_start[piece], size)], np.concatenate([[0], np.cumsum(size)])[self.edge[r]]

    def inclusion(self, r: int) -> np.ndarray:
        """The probability that a document's sample of order r is among its samples."""
        with np.errstate(over="ignore", invalid="ignore"):
            return np.where(self.kappa == -np.inf, 1.0, -np.expm1(-np.exp(np.minimum(700.0, self.logp[r] - self.kappa))))

    def decodes(self, ids: np.ndarray, edge: np.ndarray, v: Vocabulary) -> np.ndarray:
        """Whether each document's ids, decoded, are its text."""
        said = v.spelled(ids)
        cut = np.concatenate([[0], np.cumsum(v.raw_size[ids])])[edge]
        if len(said) == len(self.body) and (cut == self.at).all() and (said == self.body).all():
            return np.ones(len(edge) - 1, dtype=bool)
        size = np.diff(self.at)
        good = np.diff(cut) == size
        d = np.flatnonzero(good)
        wrong = np.flatnonzero(said[_ragged(cut[d], size[d])] != self.body[_ragged(self.at[d], size[d])])
        good[d[np.searchsorted(np.cumsum(size[d]), wrong, side="right")]] = False
        return good


#: No draw lifts a set's value this far above its log-weight: the uniform numbers have 53 bits.
REACH = 38.0


def _below(value: np.ndarray, mass: np.ndarray, noise: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The largest Gumbel value of sets of some log-mass, below a value."""
    draw = -np.log(_number(mix(_seed(noise, places.astype(np.uint64)))))
    return -np.logaddexp(-value, np.log(draw) - mass)


def search(texts: pa.Array, keys: np.ndarray, k: int, v: Vocabulary) -> Samples:
    """Up to k samples of each text, largest Gumbel value first."""
    points, size, chunk, bounds, body, at = chunks_of(texts)
    lat, n = Lattice(points, size, v), len(texts)
    out = Samples(lat, body, at)
    place, starts = (np.arange(len(chunk)) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.uint64), lat.start[chunk]
    sets: list[list[np.ndarray]] = []  # per path the sets left along it: document, place in the path, value
    slot = np.full((n, k, 2), -1, dtype=np.int64)  # nodes opened more than once: path and place of each
    gone = np.full((n, k, k + 1), -1, dtype=np.int64)  # and the arcs that were taken there
    value = -np.log(-np.log(_number(mix(_seed(keys, np.full(n, 1, np.uint64))))))
    # the branch to open next in each document: path, place, the arc to take there, and its slot
    who, path, spot, arc, own_slot = np.arange(n), np.full(n, -1), np.full(n, -1), np.full(n, -1), np.full(n, -1)
    for tag in range(k):
        if not len(who):
            break
        noise = _seed(keys, np.full(n, 2 * tag + 2, np.uint64))
        # the chunks to walk: what follows the branch
        begin, keep = bounds[who].copy(), spot + 1
        kept = [(p, mine := np.flatnonzero(path == p), _ragged(out.edge[p][who[mine]], keep[mine])) for p in range(tag)]
        for p, mine, src in kept:
            ended = np.concatenate([[0], np.cumsum(lat.last[out.arcs[p][src]])])
            ends = np.cumsum(keep[mine])
            begin[mine] += ended[ends - 1] - ended[ends - keep[mine]]
        counts = bounds[who + 1] - begin
        occ = slice(None) if not tag else _ragged(begin, counts)
        nodes = starts[occ]
        if tag:
            nodes[np.cumsum(counts) - counts] = np.where(lat.last[arc], -1, lat.to[arc])
        seeds = np.repeat(_seed(keys[who], np.full(len(who), 2 * tag + 3, np.uint64)), counts)
        # the new paths: the part before the branch, the arc, what was walked
        arcs, grown = lat.walk(nodes, _seed(seeds, place[occ]), counts, keep)
        length = np.zeros(n, dtype=np.int64)
        length[who] = keep + grown
        edge = np.concatenate([[0], np.cumsum(length)])
        for p, mine, src in kept:
            arcs[_ragged(edge[who[mine]], keep[mine])] = out.arcs[p][src]
        if tag:
            arcs[edge[who] + spot] = arc
        line = np.concatenate([[0], np.cumsum(lat.fine[arcs])])
        before = lambda d, t: (line[edge[d] + t] - line[edge[d]]) / FINE  # noqa: B023, E731
        logp = np.full(n, np.nan)
        logp[who] = before(who, length[who])
        out.arcs.append(arcs)
        out.edge.append(edge)
        out.has.append(who)
        out.logp.append(logp)
        sets.append(_left_sets(lat, arcs, edge, who, keep, before, value, noise, k))
        if tag:
            # what is left at the branch's node belongs to the new path from now on
            slot[who, own_slot] = np.stack([np.full(len(who), tag), spot], axis=1)
            left = _options(lat, arc, gone[who, own_slot])[1]
            some = np.flatnonzero(left > 0)
            d, t = who[some], spot[some]
            mass = before(d, t) + np.log(left[some] / lat.whole[lat.at[arc[some]]])
            for x, y in zip(range(3), (d, t, _below(value[d], mass, noise[d], t)), strict=True):
                sets[tag][x] = np.concatenate([sets[tag][x], y])
        # the next to open: the largest value of each document
        best, best_path, best_at = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for p, (d, _, x) in enumerate(sets):
            top = np.full(n, -np.inf)
            np.maximum.at(top, d, x)
            up = np.flatnonzero((x == top[d]) & (x > best[d]))[::-1]
            best[d[up]], best_path[d[up]], best_at[d[up]] = x[up], p, up
        out.kappa[who] = best[who]
        who = who[best[who] > -np.inf]
        if tag + 1 == k or not len(who):
            break
        path = best_path[who]
        spot = np.zeros(len(who), dtype=np.int64)
        then = np.zeros(len(who), dtype=np.int64)
        for p in range(tag + 1):
            mine = np.flatnonzero(path == p)
            spot[mine] = sets[p][1][best_at[who[mine]]]
            sets[p][2][best_at[who[mine]]] = -np.inf
            then[mine] = out.arcs[p][out.edge[p][who[mine]] + spot[mine]]
        value[who] = best[who]
        same = (slot[who, :, 0] == path[:, None]) & (slot[who, :, 1] == spot[:, None])
        own_slot = np.where(same.any(axis=1), same.argmax(axis=1), tag)
        new = np.flatnonzero(~same.any(axis=1))
        gone[who[new], tag, 0] = then[new]
        u = _number(mix(_seed(noise[who], spot.astype(np.uint64), np.full(len(who), tag + 7, np.uint64))))
        arc = _picked(lat, then, gone[who, own_slot], u)
        held = (gone[who, own_slot] >= 0).sum(axis=1)
        gone[who, own_slot, held] = arc
    return out


def _options(lat: Lattice, arc: np.ndarray, gone: np.ndarray) -> tuple[tuple, np.ndarray]:
    """The weights of all arcs at the arcs' nodes, those that are gone without any; and their sums."""
    node = lat.at[arc]
    counts = lat.first[node + 1] - lat.first[node]
    arcs, row = _ragged(lat.first[node], counts), np.repeat(np.arange(len(arc)), counts)
    q = np.where((arcs[:, None] == gone[row]).any(axis=1), 0, lat.q[arcs])
    line = np.cumsum(q)
    ends = np.cumsum(counts)
    base = np.concatenate([[0], line])[ends - counts]
    return (arcs, line, base), (line[ends - 1] if len(ends) else base) - base


def _picked(lat: Lattice, arc: np.ndarray, gone: np.ndarray, u: np.ndarray) -> np.ndarray:
    """One of the arcs left at each node, by their weights."""
    (arcs, line, base), left = _options(lat, arc, gone)
    return arcs[np.searchsorted(line, base + (u * left).astype(np.int64), side="right")]


def _left_sets(lat: Lattice, arcs: np.ndarray, edge: np.ndarray, who: np.ndarray, keep: np.ndarray, before, value: np.ndarray, noise: np.ndarray, k: int) -> list[np.ndarray]:
    """For the arcs of each path behind its branch, the largest value of the other arcs of its node.

    Sets far along a path weigh so little that they can't be among the k + 1 largest; the values are
    worked out from the front until that is certain, and the rest are left out.
    """
    found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
    live, lo, size = who, keep, 64
    while len(live):
        upto = edge[live + 1] - edge[live]
        on = lo < upto
        live, lo, upto = live[on], lo[on], upto[on]
        counts = np.minimum(size, upto - lo)
        at, d = _ragged(lo, counts), np.repeat(live, counts)
        arc = arcs[edge[d] + at]
        rest = lat.whole[lat.at[arc]] - lat.q[arc]
        some = np.flatnonzero(rest > 0)
        d, at, arc = d[some], at[some], arc[some]
        mass = before(d, at) + np.log(rest[some] / lat.whole[lat.at[arc]])
        for x, y in zip(found, (d, at, _below(value[d], mass, noise[d], at)), strict=True):
            x.append(y)
        lo, size = lo + counts, 2 * size
        if len(live):
            least = np.full(len(edge) - 1, np.inf)
            least[live] = before(live, lo) + REACH
            certain = sum(np.bincount(d[x > least[d]], minlength=len(least)) for d, x in zip(found[0], found[2], strict=True))
            on = certain[live] <= k
            live, lo = live[on], lo[on]
    return [np.concatenate(x) for x in found]


def sample_piece(texts: list[str], keys: np.ndarray, k: int, v: Vocabulary) -> list[list[tuple[np.ndarray, float, float]]]:
    """Per text up to k samples (ids, log-probability, inclusion probability), largest Gumbel value first."""
    found = search(pa.array(texts, pa.string()), keys, k, v)
    out: list[list[tuple[np.ndarray, float, float]]] = [[] for _ in texts]
    for r, has in enumerate(found.has):
        (ids, edge), inclusion = found.ids(r), found.inclusion(r)
        for d in has.tolist():
            out[d].append((ids[edge[d] : edge[d + 1]], float(found.logp[r][d]), float(inclusion[d])))
    return out


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """The id, the text, and a hash of the id, or of the text where there is no id."""
    key = F.coalesce(F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col))), F.xxhash64(F.lit("no id"), F.col(text)))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), key.alias("key"))


def _searched(b: pa.RecordBatch, k: int, v: Vocabulary, seed: int) -> Iterator[tuple[pa.RecordBatch, Samples]]:
    """The pieces of a batch of ``_keyed`` rows, and what each was sampled."""
    for lo in range(0, b.num_rows, 500):
        rows = b.slice(lo, 500)
        _, at = text_bytes(rows.column(1))
        for i, j in pieces(rows.num_rows, at, TEXT_BYTES):
            part = rows.slice(i, j - i)
            keys = mix(part.column(2).to_numpy(zero_copy_only=False).view(np.uint64) + np.uint64(seed) * _C[1])
            yield part, search(part.column(1), keys, k, v)
    give_back()


def sample_segmentations(docs: DataFrame, k: int = 3, path: str | None = None, seed: int = 0, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id and ``samples``, up to k distinct (ids, logp, inclusion), in order of their Gumbel values."""
    path, id_type = path or default_vocabulary(), docs.schema[id_col].dataType.simpleString()
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("logp", pa.float64()), ("inclusion", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, found in _searched(b, k, vocabulary(path), seed):
                rows: list[list] = [[] for _ in range(part.num_rows)]
                for r, has in enumerate(found.has):
                    (ids, edge), inclusion = found.ids(r), found.inclusion(r)
                    for d in has.tolist():
                        rows[d].append({"ids": ids[edge[d] : edge[d + 1]], "logp": found.logp[r][d], "inclusion": inclusion[d]})
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(kind))], names=["doc_id", "samples"])

    return _keyed(docs, id_col, text).mapInArrow(run, f"doc_id {id_type}, samples array<struct<ids:array<int>,logp:double,inclusion:double>>")


def segmentation_digest(docs: DataFrame, k: int = 3, path: str | None = None, seed: int = 0) -> DataFrame:
    """Per row: doc_id, and per sample its pieces, crc32 of its ids, log-probability, inclusion, and whether decoding gives the text back."""
    path, id_type = path or default_vocabulary(), docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_samples", "n_pieces", "ids_crc32", "logp", "inclusion", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for b in batches:
            for part, found in _searched(b, k, v, seed):
                n = part.num_rows
                cols: list[list] = [[[] for _ in range(n)] for _ in range(4)]
                same = np.ones(n, dtype=bool)
                for r, has in enumerate(found.has):
                    ids, edge = found.ids(r)
                    good = found.decodes(ids, edge, v)
                    same[has] &= good[has]
                    raw, cut = memoryview(ids.astype("<u4").tobytes()), (4 * edge).tolist()
                    logp, inclusion = found.logp[r].round(6).tolist(), found.inclusion(r).round(9).tolist()
                    for d in has.tolist():
                        cols[0][d].append((cut[d + 1] - cut[d]) // 4)
                        cols[1][d].append(zlib.crc32(raw[cut[d] : cut[d + 1]]))
                        cols[2][d].append(logp[d])
                        cols[3][d].append(inclusion[d])
                kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
                counts = pa.array([len(x) for x in cols[0]], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), counts, *(pa.array(x, t) for x, t in zip(cols, kinds, strict=True)), pa.array(same)], names=names)

    return _keyed(docs, "doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_samples bigint, n_pieces array<bigint>, ids_crc32 array<bigint>, logp array<double>, inclusion array<double>, round_trip boolean"
    )


def op10_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three distinct sampled segmentations of each whole text of ``documents``."""
    return segmentation_digest(read_table(spark, sf_dir, "documents"))
