"""Token-id files: an adaptive context-mixing range coder in independently reset, checksummed blocks.

Per id, the last id seen after the same two ids is predicted, or else the one seen after the same one
id; whether it hits is coded with a probability that mixes, in the logistic domain and with weights
that learn, what orders 1 and 2 make of their predictions and how frequent order 0 finds the predicted
id; an id that is missed is coded by order 0, whose counts are those of the segment and stand in its
file. All arithmetic is exact, so any machine decodes what another wrote.

A shard is a range of documents in ascending order of ids; it consists of segments of whole
documents, closed before they pass ``SEGMENT`` ids (a longer document is one by itself), and a
segment's ids are cut into blocks of ``BLOCK`` ids. Every block starts from a fresh
model and carries its CRC-32, so blocks are coded and decoded side by side, and damage is found and
stays within one block. Files are Parquet tables with a row per segment, so that any store works.

Defined results: null or empty text is its end id alone; null doc_ids come first; rows with the same
doc_id stay in the order of their text's checksum; an empty table gives empty files and result;
other columns are ignored. A tokenizer with ids of 65536 and more, or whose tokens cross white space,
raises ValueError.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.llm.common import pieces, read_table, stored, text_bytes

END_ID = 2
BLOCK, SEGMENT = 1024, 4_000_000
MAGIC = b"TIDE2"
SLOTS = 1024
#: Bytes of text that are encoded at once.
PIECE_BYTES = 8_000_000
#: A lane's range stays from 2^32 to 2^48; words have 16 bits.
_MASK, _LEAST, _WIDE = (1 << 48) - 1, 1 << 32, (1 << 32) - 1

# ---------------------------------------------------------------- integer logistic tables

_GRID = np.arange(4096)
#: ln(p / (1 - p)) in 1/256, for p in 1/4096, and back; rounded once here to integers.
STRETCH = np.round(256 * np.log((_GRID + 0.5) / (4095.5 - _GRID))).astype(np.int32)
SQUASH = np.clip(np.round(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256.0))), 16, 4080).astype(np.int64)


class _Order0:
    """The frequencies of a segment's ids, at least one each, which add up to 2^bits; lookups are narrow, so that they stay in the cache."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        self.ids, self.counts, n = ids, counts, len(ids)
        self.bits = max(16, int(n).bit_length() + 2)
        spare, total = (1 << self.bits) - n, max(1, int(counts.sum()))
        freq = 1 + counts * spare // total
        if n:
            freq[np.argmax(counts)] += (1 << self.bits) - int(freq.sum())
        self.span = np.zeros(65536, dtype=np.int64)  # where an id's share begins, times 2^32, and its frequency
        self.span[ids] = np.cumsum(freq) - freq << 32 | freq
        self.holder = np.repeat(ids.astype(np.uint16), freq) if n else np.zeros(1 << self.bits, dtype=np.uint16)
        self.stretch = STRETCH[np.minimum((self.span & _WIDE) >> self.bits - 12, 4095)]

    def packed(self) -> bytes:
        body = zlib.compress(self.ids.astype("<u2").tobytes() + self.counts.astype("<u4").tobytes(), 1)
        return struct.pack("<II", len(self.ids), zlib.crc32(body)) + body

    @classmethod
    def unpacked(cls, data: bytes) -> _Order0:
        n, crc = struct.unpack_from("<II", data)
        if zlib.crc32(data[8:]) != crc:
            raise ValueError("the counts are damaged")
        body = zlib.decompress(data[8:])
        return cls(np.frombuffer(body, "<u2", n).astype(np.int64), np.frombuffer(body, "<u4", n, 2 * n).astype(np.int64))


# In the coders and the model, masks are multiplied: half of a lane's choices can't be foreseen, which np.where pays for.


class _Encoder:
    """The range coder of many lanes; a carry is added to the word that is out."""

    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, dtype=np.int64), np.full(lanes, 1 << 48, dtype=np.int64)
        self.room = 2 * BLOCK + 8  # an id takes 28 bits at most
        self.words = np.zeros(lanes * self.room, dtype=np.uint16)  # a lane's words stand together
        self.at = np.arange(lanes) * self.room

    def code(self, k: int, p: np.ndarray, best: np.ndarray, order0: _Order0, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes an id in each of the first k lanes: whether it is best, with probability p / 4096, else by order 0."""
        low, width, at = self.low[:k], self.range[:k], self.at[:k]
        own = ids.astype(np.int64)
        miss = (own != best).astype(np.int64)
        span = order0.span.take(own)
        cut = (width >> 12) * p
        unit = width - cut >> order0.bits
        low += (cut + unit * (span >> 32)) * miss
        np.add(cut, (unit * (span & _WIDE) - cut) * miss, out=width)
        over = np.flatnonzero(low > _MASK)
        if len(over):
            low &= _MASK
            over = at[over]
            while len(over):
                over -= 1
                more = self.words[over] + np.uint16(1)
                self.words[over] = more
                over = over[more == 0]
        self.words[at] = (low >> 32).astype(np.uint16)
        small = (width < _LEAST).astype(np.int64)
        shift = small << 4
        low <<= shift
        low &= _MASK
        width <<= shift
        at += small
        again = np.flatnonzero(width < _LEAST)
        while len(again):
            self.words[at[again]] = low[again] >> 32
            low[again] = low[again] << 16 & _MASK
            width[again] <<= 16
            at[again] += 1
            again = again[width[again] < _LEAST]
        return miss, ids

    def finish(self) -> list[bytes]:
        """Each lane's words."""
        for _ in range(3):
            self.words[self.at] = self.low >> 32
            self.low = self.low << 16 & _MASK
            self.at += 1
        words = self.words.astype("<u2", copy=False)
        return [words[b * self.room : end].tobytes() for b, end in enumerate(self.at.tolist())]


class _Decoder:
    """The same from the lanes' words; a damaged lane may read those of others, and its checksum tells."""

    def __init__(self, bodies: list[np.ndarray]):
        self.words = np.concatenate([*bodies, np.zeros(8, dtype=np.uint16)])
        size = np.array([len(x) for x in bodies], dtype=np.int64)
        self.at = np.cumsum(size) - size
        self.range, self.value = np.full(len(bodies), 1 << 48, dtype=np.int64), np.zeros(len(bodies), dtype=np.int64)
        for _ in range(3):
            self.value = self.value << 16 | self.words.take(self.at, mode="clip")
            self.at += 1

    def code(self, k: int, p: np.ndarray, best: np.ndarray, order0: _Order0, ids: None = None) -> tuple[np.ndarray, np.ndarray]:
        value, width, at = self.value[:k], self.range[:k], self.at[:k]
        cut = (width >> 12) * p
        miss = (value >= cut).astype(np.int64)
        unit = width - cut >> order0.bits
        # exact: both are under 2^48 and the quotient is under 2^20, so no quotient is rounded up to a whole number
        place = ((value - cut) / unit).astype(np.int64)
        out = order0.holder.take(place, mode="clip").astype(np.int64)
        span = order0.span.take(out)
        value -= (cut + unit * (span >> 32)) * miss
        np.add(cut, (unit * (span & _WIDE) - cut) * miss, out=width)
        small = (width < _LEAST).astype(np.int64)
        shift = small << 4
        value <<= shift
        value |= self.words.take(at, mode="clip").astype(np.int64) * small
        width <<= shift
        at += small
        again = np.flatnonzero(width < _LEAST)
        while len(again):
            value[again] = value[again] << 16 | self.words.take(at[again], mode="clip")
            width[again] <<= 16
            at[again] += 1
            again = again[width[again] < _LEAST]
        np.minimum(value, width, out=value)  # only a damaged lane's value reaches its range
        out -= best
        out *= miss
        out += best
        return miss, out.astype(np.int32)


class _Model:
    """The predictions of many lanes."""

    def __init__(self, lanes: int, order0: _Order0):
        self.order0 = order0
        self.guess = np.zeros(2 * lanes * SLOTS, dtype=np.int32)  # orders 1 and 2: the id last seen, times 8, and its trust
        self.right = np.full(lanes * 16, 2048, dtype=np.int32)  # per order and trust: how often it is right, of 4096
        self.weight = np.full((3, lanes), 24000, dtype=np.int32)
        lane = np.arange(lanes)
        self.lanes, self.base = lanes, np.stack([lane, lanes * SLOTS + lane])  # a slot's lanes stand together
        self.rate = np.stack([lane * 16, lane * 16 + 8])

    def code(self, coder: _Encoder | _Decoder, k: int, one: np.ndarray, two: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
        """Codes an id in each of the first k lanes; one and two are the ids before, in 32 bits, whose products may wrap."""
        place = np.empty((2, k), dtype=np.int32)
        near = one * np.int32(40503)
        np.right_shift(near, 4, out=place[0])
        near += two * np.int32(60493)
        np.right_shift(near, 3, out=place[1])
        place &= SLOTS - 1
        slot = place.astype(np.int64)
        slot *= self.lanes
        slot += self.base[:, :k]
        entry = self.guess.take(slot)
        guess, trust = entry >> 3, entry & 7
        pick = guess[1] - guess[0]
        pick *= np.minimum(trust[1], 1)
        pick += guess[0]
        best = pick.astype(np.int64)
        which = trust.astype(np.int64)
        which += self.rate[:, :k]
        rate = self.right.take(which)
        st = np.empty((3, k), dtype=np.int32)
        STRETCH.take(rate, out=st[:2], mode="clip")
        self.order0.stretch.take(best, out=st[2], mode="clip")
        sign = (guess[0] == pick).astype(np.int32)
        sign <<= 1
        sign -= 1
        st[0] *= sign
        weight = self.weight[:, :k]
        part = weight * st
        dot = part[0] + part[1]
        dot += part[2]
        dot >>= 16
        dot += 2047
        p = SQUASH.take(dot, mode="clip")
        miss, last = coder.code(k, p, best, self.order0, ids)
        # learn: weights by the error, each order's rate by whether it was right
        error = 1 - miss
        error <<= 12
        error -= p
        st *= error.astype(np.int32)
        st >>= 9
        weight += st
        np.maximum(weight, 0, out=weight)
        np.minimum(weight, 1 << 18, out=weight)
        good = (guess == last).astype(np.int32)
        aim = good * 4095
        aim -= rate
        aim >>= 5
        aim += rate
        self.right[which] = aim
        # trust rises by one where it hits, up to 7, and is halved where it misses; missed at 1 or less the guess is replaced
        half = trust >> 1
        kept = np.minimum(half, 1)
        guess -= last
        guess *= kept
        guess += last
        guess <<= 3
        guess += half
        guess -= kept
        guess += 1
        kept -= half
        kept += trust
        trust += 1
        trust >>= 3
        kept -= trust
        kept *= good
        guess += kept
        self.guess[slot] = guess
        return last


def _shape(n_ids: int) -> tuple[int, np.ndarray]:
    n = -(-n_ids // BLOCK)
    return n, np.minimum(BLOCK, n_ids - BLOCK * np.arange(n))


def _pass(grid: np.ndarray, size: np.ndarray, coder: _Encoder | _Decoder, order0: _Order0) -> None:
    """Codes the lanes' ids step by step; a decoder fills the grid."""
    n, model = len(size), _Model(len(size), order0)
    zero, known = np.zeros(n, dtype=np.int32), isinstance(coder, _Encoder)
    for t in range(int(size.max()) if n else 0):
        k = n if t < size[-1] else n - 1  # only the last block can be shorter
        one, two = grid[t - 1] if t else zero, grid[t - 2] if t > 1 else zero
        out = model.code(coder, k, one[:k], two[:k], grid[t, :k] if known else None)
        if not known:
            grid[t, :k] = out


def encode_blocks(ids: np.ndarray) -> bytes:
    """Ids under 65536 as blocks: per block its count, its bytes, the CRC-32 of its ids, then its words; at the end order 0's counts."""
    if len(ids) and not 0 <= ids.min() <= ids.max() < 65536:
        raise ValueError("ids must be under 65536")
    n, size = _shape(len(ids))
    padded = np.zeros(n * BLOCK, dtype=np.int32)
    padded[: len(ids)] = ids
    counts = np.bincount(ids.astype(np.int64), minlength=1)
    seen = np.flatnonzero(counts)
    order0, coder = _Order0(seen, counts[seen]), _Encoder(n)
    _pass(np.ascontiguousarray(padded.reshape(n, BLOCK).T), size, coder, order0)
    own = ids.astype("<u4").tobytes()
    out = [MAGIC, struct.pack("<I", n)]
    for b, body in enumerate(coder.finish()):
        out += [struct.pack("<III", size[b], len(body), zlib.crc32(own[4 * b * BLOCK : 4 * (b + 1) * BLOCK])), body]
    return b"".join([*out, order0.packed()])


def decode_blocks(data: bytes) -> np.ndarray:
    """The ids; raises ValueError if a block's checksum doesn't fit, or that of the counts."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    (n,), at = struct.unpack_from("<I", data, len(MAGIC)), len(MAGIC) + 4
    size, crc, bodies = np.zeros(n, dtype=np.int64), [], []
    for b in range(n):
        size[b], length, check = struct.unpack_from("<III", data, at)
        bodies.append(np.frombuffer(data, dtype="<u2", count=length // 2, offset=at + 12))
        crc.append(check)
        at += 12 + length
    order0 = _Order0.unpacked(data[at:])
    grid = np.zeros((BLOCK, n), dtype=np.int32)
    _pass(grid, size, _Decoder(bodies), order0)
    out = np.ascontiguousarray(grid.T).reshape(-1)[: int(size.sum())]
    own = out.astype("<u4").tobytes()
    for b in range(n):
        if zlib.crc32(own[4 * b * BLOCK : 4 * (b + 1) * BLOCK]) != crc[b]:
            raise ValueError(f"block {b} is damaged")
    return out


# ---------------------------------------------------------------- tokens


def default_tokenizer() -> str:
    """The public tokenizer's path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _runs(table: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs table[start : start + size] on end."""
    ends = np.cumsum(size)
    at = np.repeat(start - ends + size, size)
    at += np.arange(len(at))
    return table.take(at)


def _strings(x: pa.Array) -> list[str]:
    return x.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Encodes texts chunk by chunk.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its parts
    between ASCII white space; each distinct part is given to the library once. Where the tokenizer
    lower-cases and marks the ends of words, a part of letters and closing marks is its letters (those of
    Latin-1 in lower case) and its marks, and many runs of letters are one text for the library.
    """

    MOST, AT_ONCE = 500_000, 500
    #: Parts whose ids must be those of the whole, whatever white space is between and around them.
    PROBES = ("a", "The", "end.", "42", "don't", "é", "漢字", "x" * 30)
    MARKS = string.punctuation
    NO_MARKS = "[^" + "".join("\\" + x for x in MARKS) + "]+"
    #: Letters whose lower case is one letter and which normal forms leave alone.
    LATIN, LATIN_LOWER = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$", "^[a-zß-öø-ÿ]+$"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = _tokenizer(path)
        vocab = self.tokenizer.get_vocab()
        if max(vocab.values()) >= 65536:
            raise ValueError(f"{path}: ids must be under 65536")
        ids = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        for gap in (" ", "\t", "\n", "\x0b", "\x0c", "\r", "  \n"):
            if ids(gap + gap.join(self.PROBES) + gap) != [y for x in self.PROBES for y in ids(x)]:
                raise ValueError(f"{path}: its tokens cross white space")
        self.closes = np.zeros(65536, dtype=bool)
        self.closes[[i for x, i in vocab.items() if x.endswith("</w>")]] = True
        letters = (string.ascii_uppercase, "The", "enD", *string.ascii_uppercase)
        self.plain = all(ids(x + y) == ids(x.lower()) + ids(y) and self.closes[ids(x)].sum() == 1 for x in letters for y in (*self.MARKS, "?!", "...", "***", self.MARKS))
        # lower-case letters stay as they are and together, so their runs need only the tokenizer's model, and its bytes beyond ASCII
        self.bare, self.latin = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.bare.normalizer = self.latin.normalizer = normalizers.Sequence([])
        split, as_bytes = pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bare.pre_tokenizer, self.latin.pre_tokenizer = split, pre_tokenizers.Sequence([split, as_bytes])
        runs = " ".join([*string.ascii_lowercase, *(x.removesuffix("</w>") for x in list(vocab)[::97] if x.removesuffix("</w>").isalpha() and x.isascii() and x.islower())])
        self.plain &= self.bare.encode(runs, add_special_tokens=False).ids == ids(runs)
        upper = [chr(x) for x in (*range(0xC0, 0xD7), *range(0xD8, 0xDF))]
        runs = [*map(str.lower, upper), "ß", "ÿ", *("en" + x.lower() + "on" for x in upper), "".join(upper).lower() + "ßÿ"]
        self.plain &= self.latin.encode(" ".join(runs), add_special_tokens=False).ids == ids(" ".join(runs)) and all(ids(x) == ids(x.lower()) for x in upper)

        self.known: dict[str, int] = {"": 0}  # where a unit stands in start and size
        self.start, self.size, self.table = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.seen = np.zeros(1, np.int32)  # in how many chunks, those before the last forgetting for half
        self.new_ids: list[np.ndarray] = []
        self.new_sizes: list[np.ndarray] = []

    def _forget(self) -> None:
        """Forgets the units that stood in the fewest chunks; half of the most stay, or fewer."""
        half = min(self.MOST // 2, len(self.seen))
        keep = self.seen > np.partition(self.seen, -half)[-half]
        keep[0] = True
        own = np.flatnonzero(keep)
        self.known = dict(zip(compress(self.known, keep.tolist()), range(len(own)), strict=True))
        self.table = _runs(self.table, self.start[own], self.size[own])
        self.size, self.seen = self.size[own], self.seen[own] >> 1
        self.start = np.cumsum(self.size) - self.size

    def _add(self, units: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units)), strict=True))
        self.new_ids.append(ids)
        self.new_sizes.append(sizes)

    def _learn(self, new: pa.Array) -> None:
        alone = new
        if self.plain:  # every run of letters has a closing token, so as many as there are runs means one each
            run, ascii_only = pc.utf8_is_alpha(new), pc.string_is_ascii(new)
            alone, beyond = [new.filter(pc.invert(run))], new.filter(pc.and_not(run, ascii_only))
            latin = pc.match_substring_regex(beyond, self.LATIN_LOWER)
            for tokenizer, own in ((self.bare, new.filter(pc.and_(run, ascii_only))), (self.latin, beyond.filter(latin)), (self.tokenizer, beyond.filter(pc.invert(latin)))):
                runs = _strings(own)
                groups = [runs[i : i + self.AT_ONCE] for i in range(0, len(runs), self.AT_ONCE)]
                for group, e in zip(groups, tokenizer.encode_batch_fast([" ".join(x) for x in groups], add_special_tokens=False), strict=True):
                    ids = np.array(e.ids, dtype=np.int32)
                    ends = np.flatnonzero(self.closes[ids]) + 1
                    if len(ends) == len(group):
                        self._add(group, ids, np.diff(ends, prepend=0))
                    else:  # letters that fall apart once they are normalised
                        alone.append(pa.array(group, pa.large_string()))
            alone = pa.concat_arrays(alone)
        if len(alone):
            names = _strings(alone)
            own = [np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(names, add_special_tokens=False)]
            self._add(names, np.concatenate(own), np.array([len(x) for x in own], dtype=np.int64))
        self.size, self.table = np.concatenate([self.size, *self.new_sizes]), np.concatenate([self.table, *self.new_ids])
        self.start = np.cumsum(self.size) - self.size
        self.seen = np.append(self.seen, np.zeros(len(self.size) - len(self.seen), np.int32))
        self.new_sizes, self.new_ids = [], []

    def _units(self, words: pa.Array) -> np.ndarray:
        """Two units for each word: its letters and its marks, or the word and nothing."""
        at = np.zeros((len(words), 2), dtype=np.int64)
        if not self.plain:
            at[:, 0] = self._places(words)
            return at
        core = pc.ascii_rtrim(words, characters=self.MARKS)
        plain = pc.utf8_is_alpha(core)
        beyond = pc.and_not(plain, pc.string_is_ascii(core))
        letters = core.filter(beyond)
        latin = pc.match_substring_regex(letters, self.LATIN)
        # a few letters are a letter and a sign once they are normalised, and the sign stands with the marks
        whole = pc.and_not(pc.utf8_is_alpha(pc.utf8_normalize(letters, "NFC")), pc.match_substring(letters, "\u0130"))
        plain = pc.replace_with_mask(plain, beyond, pc.or_(latin, whole))
        letters = pc.if_else(latin, pc.utf8_lower(letters), pc.if_else(whole, letters, words.filter(beyond)))
        first = pc.replace_with_mask(pc.if_else(plain, pc.ascii_lower(core), words), beyond, letters)
        marked = pc.and_(plain, pc.not_equal(pc.binary_length(core), pc.binary_length(words)))
        marks = pc.replace_substring_regex(words.filter(marked), self.NO_MARKS, "")
        places = self._places(pa.concat_arrays([first, marks]))
        at[:, 0] = places[: len(words)]
        at[marked.to_numpy(zero_copy_only=False), 1] = places[len(words) :]
        return at

    def _places(self, units: pa.Array) -> np.ndarray:
        """Where the units stand; new ones are learned."""
        own = units.dictionary_encode()
        names = _strings(own.dictionary)
        at = np.fromiter(map(self.known.get, names, repeat(-1)), dtype=np.int64, count=len(names))
        new = np.flatnonzero(at < 0)
        if len(new):
            self._learn(own.dictionary.take(pa.array(new)))
            at[new] = np.fromiter(map(self.known.__getitem__, [names[i] for i in new.tolist()]), dtype=np.int64, count=len(new))
        self.seen[at] += 1
        return at.take(own.indices.to_numpy(zero_copy_only=False))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids on end, each text's closed by the end id, and the number of ids of each."""
        if len(self.known) > self.MOST:
            self._forget()
        parts = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        at = parts.offsets.to_numpy()
        flat = parts.flatten().dictionary_encode()
        unit = self._units(flat.dictionary)
        size = self.size[unit]
        table = np.append(_runs(self.table, self.start[unit.reshape(-1)], size.reshape(-1)), np.int32(END_ID))
        size = np.append(size[:, 0] + size[:, 1], 1)
        start = np.cumsum(size) - size
        order = np.insert(flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), at[1:] - at[0], len(unit))
        lengths = size[order]
        last = at[1:] - at[0] + np.arange(len(texts))
        return _runs(table, start[order], lengths), np.diff(np.cumsum(lengths)[last], prepend=0)


@cache
def _encoder(path: str) -> Encoder:
    """One for all tasks of a worker: what it knows is bounded, and the next task's words are much the same.

    A task has one core, and its worker has others beside it: the library's own threads would only take turns there.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


FILE_SCHEMA = "shard int, seq int, first bigint, n_ids bigint, doc_ids array<{id}>, sizes array<int>, payload binary"


def write_tokens(docs: DataFrame, path: str | None = None, name: str = "tokens", segment_ids: int = SEGMENT, shards: int | None = None) -> DataFrame:
    """Encodes (doc_id, text) in ascending doc_id order and writes the files; returns them as a table."""
    path, id_type = path or default_tokenizer(), docs.schema["doc_id"].dataType.simpleString()
    Encoder(path)  # raises here what would fail in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, encoder = TaskContext.get().partitionId(), _encoder(path)
        seq = first = held = 0
        ids: list[np.ndarray] = []
        names: list = []
        sizes: list[np.ndarray] = []
        kind = None

        def segment() -> pa.RecordBatch:
            nonlocal seq, first, held
            flat = np.concatenate(ids)
            cols = [[shard], [seq], [first], [len(flat)], [names], [np.concatenate(sizes)], [encode_blocks(flat)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(kind), pa.list_(pa.int32()), pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["shard", "seq", "first", "n_ids", "doc_ids", "sizes", "payload"])
            seq, first, held = seq + 1, first + len(flat), 0
            ids.clear()
            names.clear()
            sizes.clear()
            return out

        for b in batches:
            kind = b.schema.field(0).type
            _, at = text_bytes(b.column(1))
            for i, j in pieces(b.num_rows, at, PIECE_BYTES):
                flat, size = encoder.encode(b.column(1).slice(i, j - i))
                own, ends = b.column(0).slice(i, j - i).to_pylist(), np.cumsum(size)
                lo = 0
                while lo < len(own):  # as many documents as the segment still holds
                    begun = int(ends[lo] - size[lo])
                    hi = int(np.searchsorted(ends, begun + segment_ids - held, side="right"))
                    if hi <= lo and names:
                        yield segment()
                        continue
                    hi = max(hi, lo + 1)
                    ids.append(flat[begun : ends[hi - 1]])
                    sizes.append(size[lo:hi])
                    names += own[lo:hi]
                    held += int(ends[hi - 1]) - begun
                    lo = hi
        if names:
            yield segment()

    by_id = F.col("doc_id").asc_nulls_first()
    rows = docs.select("doc_id", "text")
    rows = rows.repartitionByRange(shards, by_id) if shards else rows.repartitionByRange(by_id)
    ordered = rows.sortWithinPartitions(by_id, F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return stored(ordered.mapInArrow(run, FILE_SCHEMA.format(id=id_type)), name)


def read_tokens(files: DataFrame) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""
    id_type = files.schema["doc_ids"].dataType.elementType.simpleString()
    sums = files.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # a row a shard
    base, total = {}, 0
    for r in sums:
        base[r["shard"]] = total
        total += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                one = b.slice(row, 1)
                ids = decode_blocks(one.column(4)[0].as_py())
                sizes = one.column(3).flatten().to_numpy().astype(np.int64)
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                start = base[one.column(0)[0].as_py()] + one.column(1)[0].as_py() + ends - sizes
                yield pa.RecordBatch.from_arrays([one.column(2).flatten(), pa.array(start), pa.array(sizes), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("shard", "first", "doc_ids", "sizes", "payload").mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the whole of ``documents`` as token files and reads them back."""
    return read_tokens(write_tokens(read_table(spark, sf_dir, "documents")))
