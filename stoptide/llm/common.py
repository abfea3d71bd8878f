"""Shared helpers: reading tables, shared scratch tables, packed columns, and vectorised word hashing.

Scratch tables stand in the folder that the cluster names in ``spark.checkpoint.dir``, which every
executor shares.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.sources.scratch import new_folder

#: The ASCII white space that separates words in every contract: space, tab to carriage return.
WORD_BREAKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: The same as a Java and Python regular expression.
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Text is hashed in pieces of about this many bytes, whole documents each, to bound memory.
PIECE_BYTES = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, by Spark's own reader so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(df: DataFrame) -> None:
    """Deletes a table made by ``stored`` once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_bytes(df: DataFrame) -> int:
    """The size on disk of a table made by ``stored``."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def packed(*columns: np.ndarray, ascending: bool = True) -> bytes:
    """Equally long columns of unsigned numbers of one width; the first is kept as differences if ascending."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0)) if ascending else columns[0]
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T for x in (first, *columns[1:])]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(np.concatenate(planes)).tobytes())


def unpacked(body: bytes, n: int, kind: type = np.uint64, ascending: bool = True) -> list[np.ndarray]:
    """The ``n`` columns."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), dtype=np.uint8).reshape(n, np.dtype(kind).itemsize, -1)
    out = [np.ascontiguousarray(x.T).reshape(-1).view(kind) for x in planes]
    return [np.cumsum(out[0], dtype=kind) if ascending else out[0], *out[1:]]


def give_back() -> None:
    """Returns freed memory to the system: a worker lives on between stages, beside others."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def text_key(text: Column) -> Column:
    """A name of a text, 128 bits wide; null and empty texts have names of their own."""
    return F.struct(F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text, text.isNull()).alias("k2"))


def lower_ascii(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(c, UPPER, LOWER)


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def _byte_table(fold: bool) -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = mix(x)
    for upper, lower in zip(UPPER, LOWER, strict=True):
        x[ord(upper)] = x[ord(lower)] if fold else x[ord(upper)]
    return x


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(WORD_BREAKS)] = True
_BYTES, _BYTES_AS_WRITTEN = _byte_table(True), _byte_table(False)
_BASE = 0x9E3779B97F4A7C15 | 5
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, PIECE_BYTES)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _POWERS[key] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][: n + 1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts on end, and each text's offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return whole, at - at[0]


def word_spans(data: np.ndarray, at: np.ndarray, is_break: np.ndarray = _BREAK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and per text the index of its first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~is_break[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hashes of the words, A-Z lower-cased if ``fold``; equal words give equal hashes wherever they stand."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_BYTES if fold else _BYTES_AS_WRITTEN)[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def pieces(n: int, at: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes; a longer text is a range of its own."""
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def hashed_words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each piece of the column: its row range, its words' hashes, and each row's first word."""
    data, at = text_bytes(texts)
    for i, j in pieces(len(at) - 1, at):
        part, own = data[at[i] : at[j]], at[i : j + 1] - at[i]
        starts, ends, first = word_spans(part, own)
        yield i, j, word_hashes(part, starts, ends), first
