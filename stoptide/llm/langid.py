"""Language identification by bit-sliced Bloom filters over byte n-grams.

One filter holds all languages: every position has a bit per language, and the positions of an
n-gram, and-ed, name all languages that contain it. A language contains an n-gram that was seen twice
or more in it and makes up ``LEAST_SHARE`` of its n-grams, whatever other languages do; so a language
has at most 1 / ``LEAST_SHARE`` of them, at any size of the corpus, and each language's slice of the
filter, sized by the largest language, is at most a third full. Of a text, the n-grams found per
language are counted, corrected for the filter's false positives (its fill to the power of the number
of positions), and the largest count decides. The counts behind the filter cover all training rows.

Defined results: ``und`` with score 0 for null text or text without a letter, or if nothing was
learned; a text of known letters but no known n-gram gets the commonest language with score 0; rows
without an id are never training rows nor held out; repeated rows are judged alike, each on its own
(training counts them each); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.llm.common import crc_mod, forget, mix, pieces, read_table, stored, text_bytes

GRAM, HASHES = 4, 3
#: Positions of the filter: a power of two, at least eight to an n-gram of the largest language, from 2 to 8 MB a 64 languages.
LEAST_POSITIONS, MOST_POSITIONS = 1 << 18, 1 << 20
#: A language contains an n-gram seen this often in it, and at this part of its n-grams or more.
LEAST_COUNT, LEAST_SHARE = 2, 1e-5

_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
for _i in range(26):
    _FOLD[0x41 + _i] = _FOLD[0x61 + _i] = 0x61 + _i


def grams_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts as 32-bit codes, and each text's first (one more at the end).

    Each text is set between blanks; whatever is no letter is a blank; n-grams with two blanks in a
    row or a blank in the middle only are left out.
    """
    n = len(at) - 1
    body = np.full(len(data) + 2 * n + GRAM, 0x20, dtype=np.uint8)
    shift = 2 * np.arange(n) + 1
    where = np.arange(len(data)) + np.repeat(shift, np.diff(at))
    body[where] = _FOLD[data]
    wide = body.astype(np.uint32)
    codes = wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]
    blank = body == 0x20
    good = ~((blank[:-3] & blank[1:-2]) | (blank[1:-2] & blank[2:-1]) | (blank[2:-1] & blank[3:]))
    keep = np.flatnonzero(good)
    first = np.searchsorted(keep, np.append(at[:-1] + 2 * np.arange(n), at[-1] + 2 * n))
    return codes[keep], first


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of rows (lang, text): summed in each task before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str, codes: np.ndarray, counts: np.ndarray) -> None:
            if lang in total:
                codes, counts = np.append(total[lang][0], codes), np.append(total[lang][1], counts)
            keys, back = np.unique(codes, return_inverse=True)
            total[lang] = keys, np.bincount(back, weights=counts, minlength=len(keys)).astype(np.int64)

        for b in batches:
            langs, (data, at) = b.column(0).to_pylist(), text_bytes(b.column(1))
            for i, j in pieces(len(langs), at):
                codes, first = grams_of(data[at[i] : at[j]], at[i : j + 1] - at[i])
                names = sorted(set(langs[i:j]))
                row = np.repeat(np.array([names.index(x) for x in langs[i:j]]), np.diff(first))
                for k, lang in enumerate(names):
                    own, counts = np.unique(codes[row == k], return_counts=True)
                    add(lang, own, counts)
        for lang, (codes, counts) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _positions(codes: np.ndarray, size: int) -> np.ndarray:
    """HASHES positions of each n-gram, as rows."""
    seeds = np.arange(1, HASHES + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    return (mix(codes.astype(np.uint64)[None, :] + seeds) % np.uint64(size)).astype(np.int64)


class Filter:
    """The bit-sliced filter: ``bits[word, position]`` holds a bit for each of 64 languages."""

    def __init__(self, langs: list[str], bits: np.ndarray, common: str):
        self.langs, self.bits, self.common = langs, bits, common
        self.fill = [float(((bits[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()) ** HASHES for k in range(len(langs))]

    def counts(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per text and language the n-grams found, corrected for false positives."""
        at = _positions(codes, self.bits.shape[1])
        size = np.diff(first).astype(float)
        out = np.zeros((len(size), len(self.langs)))
        for w in range(len(self.bits)):
            masks = self.bits[w][at[0]]
            for p in at[1:]:
                masks = masks & self.bits[w][p]
            for k in range(64 * w, min(64 * w + 64, len(self.langs))):
                hit = np.concatenate([[0], np.cumsum((masks >> np.uint64(k % 64)) & np.uint64(1))]).astype(float)
                found = hit[first[1:]] - hit[first[:-1]]
                out[:, k] = np.maximum(0, (found - self.fill[k] * size) / max(1e-9, 1 - self.fill[k]))
        return out


def fit_filter(train: DataFrame, size: int | None = None) -> Filter | None:
    """Learns from rows (lang, text) without nulls; None if there are none."""
    counts = stored(count_grams(train), "grams")
    sums = sorted((r["lang"], r["n"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect())  # a row a language
    if not sums:
        forget(counts)
        return None
    langs = [x for x, _ in sums]
    total, number = F.create_map(*(F.lit(y) for x in sums for y in x)), F.create_map(*(F.lit(y) for x in enumerate(langs) for y in x[::-1]))
    contained = (F.col("n") >= LEAST_COUNT) & (F.col("n") >= LEAST_SHARE * total[F.col("lang")])
    member = stored(counts.filter(contained).select("gram", number[F.col("lang")].alias("k")), "members")
    forget(counts)
    most = member.groupBy("k").count().agg(F.max("count")).first()[0] or 0
    size = size or min(MOST_POSITIONS, max(LEAST_POSITIONS, 1 << (8 * most).bit_length()))
    words = (len(langs) + 63) // 64

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            at = _positions(b.column(0).to_numpy(zero_copy_only=False), size).ravel()
            word, bit = np.tile(k // 64, HASHES), np.tile(np.left_shift(np.int64(1), k % 64), HASHES)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(word), pa.array(bit)], names=["at", "word", "bit"])

    filled = member.mapInArrow(spread, "at bigint, word bigint, bit bigint").groupBy("at", "word").agg(F.bit_or("bit").alias("bits"))
    rows = filled.toPandas()  # size * words rows at most
    forget(member)
    bits = np.zeros((words, size), dtype=np.uint64)
    bits[rows["word"].to_numpy(), rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Filter(langs, bits, max(sums, key=lambda x: x[1])[0])


def identify(docs: DataFrame, model: Filter | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred and score, the winner's part of all languages' counts."""
    id_type = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            texts, (data, at) = b.column(1), text_bytes(b.column(1))
            said, score = [], []
            for i, j in pieces(len(texts), at):
                if m is None:
                    said += ["und"] * (j - i)
                    score += [0.0] * (j - i)
                    continue
                part = data[at[i] : at[j]]
                own = at[i : j + 1] - at[i]
                counts = m.counts(*grams_of(part, own))
                ascii_letters = np.concatenate([[0], np.cumsum((_FOLD[part] != 0x20) & (part < 0x80))])
                plain = ascii_letters[own[1:]] > ascii_letters[own[:-1]]
                total, best = counts.sum(axis=1), counts.argmax(axis=1)
                for k in range(j - i):
                    if not plain[k] and not any(x.isalpha() for x in texts[i + k].as_py() or ""):
                        said.append("und")
                        score.append(0.0)
                    else:
                        said.append(m.langs[best[k]] if total[k] > 0 else m.common)
                        score.append(float(counts[k, best[k]] / total[k]) if total[k] > 0 else 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(said, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(id_col, text).mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the whole of ``documents``, learned from the rows that aren't held out."""
    docs = read_table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = fit_filter(docs.filter(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text"))
    out = identify(docs, model)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", F.round("score", 6).alias("score"))
