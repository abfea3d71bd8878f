"""Exact nearest neighbours by a block matrix join with int8 tiles.

1. Vectors are packed where they are read into blocks: per vector its int8 codes, their scale, the
   norm of what rounding left over, and the vector itself.
2. Queries and candidates are dealt into groups of bounded size; a cell is a query group times a
   candidate group. Blocks travel once to each cell of their row or column, queries first in it.
3. In a cell each candidate block meets the queries in tiles. A tile's products of codes are exact
   integers, so |d - d'| <= e_q + e_c bounds the distance d by the codes' d' and the rounding norms.
   Pairs whose lower bound is over the query's k-th best so far, or the k-th smallest upper bound of
   the tile, go; the others are recomputed from the vectors in double precision.
4. What is left enters a heap of k a query; the cells' heaps are merged by query.

Within a block, equal vectors are compared once and keep their k + 1 smallest ids: no other copy can
be among the k nearest of any query. So a vector that a third of all rows share costs k + 1 rows a block.

Defined results: vectors that are null, zero, or hold null or non-finite components, and rows without
an id, take no part; vectors are compared only with those of the same dimension; repeated rows count
once, and an id that stands for several vectors is as near as its nearest; a query's own id is never
its neighbour; ties go to the smaller id; fewer candidates give fewer rows; an empty table gives an
empty result; other columns are ignored. Nothing is approximate: recall is 1.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stoptide.llm.common import give_back, read_table, stored

#: Rows of a block, queries of a tile, and bytes of vectors in a query group.
BLOCK, TILE, GROUP_BYTES = 2048, 1024, 64 << 20
#: Rows of a candidate group, at least (for few rows) and at most.
LEAST_GROUP, MOST_GROUP = 2048, 65_536
#: float32 holds every sum of so many products of two codes.
EXACT_DIM = (1 << 24) // (127 * 127)
BLOCK_SCHEMA = "dim int, is_query boolean, number bigint, n int, ids binary, vectors binary, codes binary, scale binary, rest binary"


class Block:
    """Vectors of one dimension with their codes; ``norm`` is the length of scale times codes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        wide = vectors.astype(np.float64)
        self.scale = np.abs(wide).max(axis=1) / 127 if len(ids) else np.zeros(0)
        self.codes = np.rint(wide / self.scale[:, None]).astype(np.int8)
        self.rest = np.sqrt(((wide - self.scale[:, None] * self.codes) ** 2).sum(axis=1))
        self._weigh()

    def _weigh(self) -> None:
        self.as_float = self.codes.astype(np.float32)
        self.norm2 = self.scale**2 * (self.codes.astype(np.float64) ** 2).sum(axis=1)

    def row(self) -> list[bytes]:
        return [x.tobytes() for x in (self.ids, self.vectors, self.codes, self.scale, self.rest)]

    @classmethod
    def read(cls, dim: int, kind: str, ids: bytes, vectors: bytes, codes: bytes, scale: bytes, rest: bytes) -> Block:
        out = cls.__new__(cls)
        out.ids, out.vectors = np.frombuffer(ids, np.int64), np.frombuffer(vectors, kind).reshape(-1, dim)
        out.codes, out.scale, out.rest = np.frombuffer(codes, np.int8).reshape(-1, dim), np.frombuffer(scale), np.frombuffer(rest)
        out._weigh()
        return out


def first_copies(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """The rows to keep so that of equal vectors only the ``most`` smallest distinct ids stay."""
    raw = np.ascontiguousarray(vectors + vectors.dtype.type(0)).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
    _, which = np.unique(raw, return_inverse=True)
    order = np.lexsort((ids, which))
    which, ids = which[order], ids[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (which[1:] != which[:-1]) | (ids[1:] != ids[:-1])
    order, which = order[new], which[new]
    return order[np.arange(len(order)) - np.searchsorted(which, which) < most]


def product(a: Block, i: slice, b: Block) -> np.ndarray:
    """The products of codes, exact: sums of more terms than float32 holds are added in double precision."""
    dim = a.codes.shape[1]
    parts = (a.as_float[i, k : k + EXACT_DIM] @ b.as_float[:, k : k + EXACT_DIM].T for k in range(0, dim, EXACT_DIM))
    return sum((x.astype(np.float64) for x in parts), np.zeros((1, 1)))


def bounds(a: Block, i: slice, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances of a tile, rounding of the bounds themselves allowed for."""
    squared = a.norm2[i, None] + b.norm2 - 2 * a.scale[i, None] * b.scale * product(a, i, b)
    near = np.sqrt(np.maximum(squared, 0))
    slack = a.rest[i, None] + b.rest + 1e-7 * (np.sqrt(a.norm2[i, None]) + np.sqrt(b.norm2))
    return near - slack, near + slack


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, in double precision, components added in order."""
    return np.sqrt(np.add.accumulate((a.astype(np.float64) - b.astype(np.float64)) ** 2, axis=1)[:, -1])


class Heaps:
    """The k nearest ids of each query so far."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.heaps, self.worst = k, [[] for _ in range(n)], np.full(n, np.inf)

    def push(self, query: int, score: float, vec_id: int) -> None:
        heap, entry = self.heaps[query], (-score, -vec_id)
        if len(heap) == self.k and entry <= heap[0]:
            return
        same = next((i for i, x in enumerate(heap) if x[1] == -vec_id), None)
        if same is not None:
            if entry <= heap[same]:
                return
            heap[same] = entry
            heapq.heapify(heap)
        elif len(heap) == self.k:
            heapq.heapreplace(heap, entry)
        else:
            heapq.heappush(heap, entry)
        if len(heap) == self.k:
            self.worst[query] = -heap[0][0]

    def meet(self, queries: Block, block: Block) -> None:
        """Takes in what a block of candidates holds."""
        surplus = len(block.ids) - len(np.unique(block.ids))
        for at in range(0, len(queries.ids), TILE):
            i = slice(at, min(at + TILE, len(queries.ids)))
            low, high = bounds(queries, i, block)
            own = queries.ids[i, None] == block.ids
            high[own] = np.inf
            limit, k = self.worst[i].copy(), self.k + surplus
            if k <= high.shape[1]:
                limit = np.minimum(limit, np.partition(high, k - 1, axis=1)[:, k - 1])
            q, c = np.nonzero(~(low > limit[:, None]) & ~own)
            for some in range(0, len(q), 1 << 16):
                qs, cs = q[some : some + (1 << 16)], c[some : some + (1 << 16)]
                score = distances(queries.vectors[i][qs], block.vectors[cs])
                close = ~(score > self.worst[i][qs])
                for x, s, v in zip((at + qs[close]).tolist(), score[close].tolist(), block.ids[cs[close]].tolist(), strict=True):
                    self.push(x, s, v)

    def rows(self, ids: np.ndarray) -> list[tuple[int, int, float]]:
        return [(int(q), -v, -s) for q, heap in zip(ids, self.heaps, strict=True) for s, v in heap]


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector")).filter(F.col("id").isNotNull() & (F.size("vector") > 0) & fine & F.exists("vector", lambda x: x != 0))


BLOCK_TYPES = (pa.int32(), pa.bool_(), pa.int64(), pa.int32(), *[pa.binary()] * 5)


def packed_blocks(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """Blocks of candidates, and of queries apart, numbered by their smallest id; no shuffle."""
    kind = "<f4" if rows.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).cast(pa.large_list(pa.float32() if kind == "<f4" else pa.float64()))
            at = lists.offsets.to_numpy()
            flat, sizes = lists.values.to_numpy(zero_copy_only=False).astype(kind), np.diff(at)
            ids, asked = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                of_dim = np.flatnonzero(sizes == dim)
                for query in (True, False):
                    rows_ = of_dim[asked[of_dim]] if query else of_dim
                    for j in range(0, len(rows_), BLOCK):
                        some = rows_[j : j + BLOCK]
                        vectors = flat[at[some][:, None] + np.arange(dim)]
                        stay = np.arange(len(some)) if query else first_copies(ids[some], vectors, k + 1)
                        block = Block(ids[some][stay], vectors[stay])
                        head = (int(dim), query, int(block.ids.min()), len(block.ids))
                        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*head, *block.row()), BLOCK_TYPES, strict=True)], names)
        give_back()

    names = [x.split()[0] for x in BLOCK_SCHEMA.split(", ")]
    return rows.select("id", "vector", F.coalesce(is_query, F.lit(False)).alias("q")).mapInArrow(run, BLOCK_SCHEMA)


def cell_heaps(kind: str, k: int):
    """Reads each cell's blocks, queries first, and gives its heaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, queries, heaps = None, [], None, None

        def told() -> pa.RecordBatch:
            rows = heaps.rows(queries.ids)
            columns = [np.array([r[x] for r in rows], dtype=t) for x, t in ((0, np.int64), (1, np.int64), (2, np.float64))]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["cell"] != cell:
                    if heaps is not None:
                        yield told()
                    cell, parts, queries, heaps = r["cell"], [], None, None
                block = Block.read(r["dim"], kind, *(r[x] for x in ("ids", "vectors", "codes", "scale", "rest")))
                if r["is_query"]:
                    parts.append(block)
                elif parts:
                    if heaps is None:
                        queries = parts[0] if len(parts) == 1 else _together(parts)
                        heaps = Heaps(len(queries.ids), k)
                    heaps.meet(queries, block)
        if heaps is not None:
            yield told()
        give_back()

    return run


def _together(parts: list[Block]) -> Block:
    out = Block.__new__(Block)
    for name in ("ids", "vectors", "codes", "scale", "rest"):
        setattr(out, name, np.concatenate([getattr(x, name) for x in parts]))
    out._weigh()
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest others of each row for which ``is_query`` (over ``id``) holds."""
    rows = usable(vectors, id_col, vector)
    kind = "<f4" if rows.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"
    spark, width = rows.sparkSession, 4 if kind == "<f4" else 8
    blocks = stored(packed_blocks(rows, is_query, k), "blocks")
    size = blocks.agg(
        F.sum(F.when(F.col("is_query"), F.col("n")).otherwise(0)).alias("asked"), F.sum(F.when(F.col("is_query"), 0).otherwise(F.col("n"))).alias("rows"), F.max("dim").alias("dim")
    ).first()
    asked, count, dim = size["asked"] or 0, size["rows"] or 0, size["dim"] or 1
    across = max(1, -(-asked * dim * (width + 5) // GROUP_BYTES))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    down = max(1, -(-count // MOST_GROUP), min(-(-2 * tasks // across), count // LEAST_GROUP))
    group = F.pmod(F.xxhash64("number", "n"), F.when(F.col("is_query"), across).otherwise(down))
    other = F.explode(F.expr(f"if(is_query, sequence(0, {down - 1}), sequence(0, {across - 1}))")).alias("other")
    dealt = blocks.select("*", group.alias("own"), other)
    cell = F.struct("dim", F.when(F.col("is_query"), F.col("own")).otherwise(F.col("other")).alias("row"), F.when(F.col("is_query"), F.col("other")).otherwise(F.col("own")).alias("column"))
    dealt = dealt.withColumn("cell", F.to_json(cell)).drop("own", "other").repartition("cell").sortWithinPartitions("cell", F.desc("is_query"), "number", "n")
    heaps = dealt.mapInArrow(cell_heaps(kind, k), "query_id bigint, vec_id bigint, score double")
    merged = heaps.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every vector whose id is divisible by 100."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


#: The plain definition; distances in double precision.
OP11_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, embedding::DOUBLE[] AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND list_count(embedding) = len(embedding) AND list_max(embedding) < 'Infinity'::FLOAT AND list_min(embedding) > '-Infinity'::FLOAT
        AND (list_max(embedding) > 0 OR list_min(embedding) < 0)
), d AS (
    SELECT q.vec_id AS query_id, c.vec_id, min(list_distance(q.x, c.x)) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0 GROUP BY ALL
)
SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS int) AS rank, vec_id, score FROM d
QUALIFY rank <= 10
"""
