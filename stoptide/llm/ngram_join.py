"""N-gram Jaccard join by prefix filters under several global token orders.

A document is the set of its n-word shingles. Two sets that overlap by the threshold must share a
token among the first ``size - ceil(t * size) + 1`` of each, whatever order all tokens are put in.

1. Equal sets are one class, named by a 128-bit fingerprint; copies are never expanded into pairs.
2. Under the first order (by hash) the classes stay that share enough tokens of a lengthened prefix:
   one of k tokens more must hold k tokens of the overlap. The k is one and a half plain prefixes, so
   three fifths of the lengthened one must stand elsewhere; sets that share only what is frequent
   in a large corpus don't reach that. Prefix tokens travel once, sorted and packed, by ranges of
   their hashes; a bit for each comes back.
3. Of those, the frequency of each shingle gives the second order (rare first, by hash) and the
   third (rare first, by another hash). A pair is proposed by the second, if sizes and positions of
   the shared token still allow the threshold; it is verified only if prefixes also meet under the
   first and the third.
4. In a token's group, pairs are proposed with a few leaders first; what their verified links join
   needs no further comparison. A last round compares, in the groups that still hold several
   components, each pair of different components that sizes, positions and the counts of tokens by
   part allow. No group is collected.
5. Links are counted inside each component, where all of them are: its classes are dealt into blocks,
   and each two blocks give their classes' numbers of links by products of incidence matrices, so no
   pair is ever a row.

Defined results: null or empty text has no shingles and is linked with nothing; a text of fewer
words than n is one shingle; repeated rows are copies of each other; a null doc_id is kept, never
is a component's name unless the component has no other; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoptide.llm.common import forget, give_back, hashed_words, mix, packed, read_table, stored, text_key, unpacked
from stoptide.llm.components import star_components

#: Leaders proposed for each token's group, round by round; a last round handles what is left.
LEADERS = (1, 16)
#: Bits of the filter that spares the second reading's rows; rows beyond its use only cost time.
FILTER_BITS = 1 << 23
#: Prefix tokens that a task packs at once, and bytes of text to a range of their hashes.
CHUNK_TOKENS, RANGE_BYTES = 1 << 20, 20_000_000
#: Classes of a component in a block, on average, and tokens that a product of two blocks takes at once.
BLOCK, SLICE = 1024, 4096
#: Rows of keys that are sent to all tasks, at most (about 100 MB).
BROADCAST_KEYS = 1_000_000
#: Copies of a class from which on its rows are joined without a shuffle.
HOT_COPIES = 1000
#: Parts into which a set's tokens are counted; the counts bound from above what two sets share.
PARTS = 64


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Per text the sorted 64-bit hashes of its distinct n-word shingles."""
    for i, j, words, first in hashed_words(texts):
        del i, j
        grams = np.zeros(len(words), dtype=np.uint64)
        for k in range(n):
            if len(words) > k:
                grams[: len(words) - k] = mix(grams[: len(words) - k] * np.uint64(0x100000001B3) + words[k:] + np.uint64(k))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1].view(np.int64))
            elif b > a:
                whole = np.full(1, b - a, dtype=np.uint64)
                for k in range(a, b):
                    whole = mix(whole * np.uint64(0x100000001B3) + words[k : k + 1])
                yield whole.view(np.int64)
            else:
                yield np.zeros(0, dtype=np.int64)


def _fingerprint(x: np.ndarray) -> bytes:
    u = x.view(np.uint64)
    a = mix(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    b = mix(u * np.uint64(0x9E3779B97F4A7C15) + np.uint64(len(u))).sum(dtype=np.uint64)
    return np.array([a, b], dtype=">u8").tobytes()


def _agree(size, num: int, den: int):
    """Tokens that two linked sets are sure to share in their heads, for the smaller set's size."""
    least = -(-num * size // den)
    return np.maximum(1, np.minimum((1 + size - least) * 3 // 2, least))


def _head_length(size: int, num: int, den: int) -> int:
    return size - -(-num * size // den) + int(_agree(size, num, den))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in arrays], out=at[1:])
    return pa.ListArray.from_arrays(at, np.concatenate(arrays) if arrays else np.zeros(0, np.int64))


CHUNK_SCHEMA = "sid binary, size bigint, chunk bigint, part int, body binary, counts binary, sids binary, sizes binary"


def class_table(docs: DataFrame, n: int, num: int, den: int, parts: int) -> DataFrame:
    """From (key, text) three kinds of rows: per row its key, sid (the class, null without shingles) and
    size; per chunk of a task's new classes their sids and sizes, and which class holds which of the
    chunk's distinct head tokens; per chunk and range of hashes those tokens, and whether they stand in
    several of the chunk's classes.

    Of a token's hash the upper 48 bits travel: a chance meeting keeps a class that the next step drops.
    """
    key_type = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, held, kind = TaskContext.get().partitionId(), 0, 0, None
        seen: set[bytes] = set()  # 16 bytes a class of this task's rows
        names: list[bytes] = []
        sizes: list[int] = []
        heads: list[np.ndarray] = []

        def rows(keys: pa.Array | None, n_rows: int, **cols) -> pa.RecordBatch:
            kinds = {"key": kind, "sid": pa.binary(), "size": pa.int64(), "chunk": pa.int64(), "part": pa.int32(), "body": pa.binary(), "counts": pa.binary(), "sids": pa.binary(), "sizes": pa.binary()}
            return pa.RecordBatch.from_arrays([keys if keys is not None and k == "key" else pa.array(cols[k], t) if k in cols else pa.nulls(n_rows, t) for k, t in kinds.items()], names=list(kinds))

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, held
            chunk = task * (1 << 30) + number
            tokens = np.concatenate(heads).view(np.uint64) >> np.uint64(16)
            owner = np.repeat(np.arange(len(heads), dtype=np.uint32), [len(x) for x in heads])
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            start = np.flatnonzero(np.append(tokens[:-1] != tokens[1:], True)) + 1
            tokens, counts = tokens[start - 1], np.diff(start, prepend=0)
            yield rows(None, 1, chunk=[chunk], body=[packed(owner, ascending=False)], counts=[packed(counts.astype(np.uint32), ascending=False)], sids=[b"".join(names)], sizes=[np.array(sizes, dtype="<i8").tobytes()])
            edge = np.searchsorted((tokens >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
            asked = [k for k in range(parts) if edge[k] < edge[k + 1]]
            bodies = [packed(tokens[edge[k] : edge[k + 1]], (counts[edge[k] : edge[k + 1]] > 1).astype(np.uint64)) for k in asked]
            yield rows(None, len(asked), chunk=[chunk] * len(asked), part=asked, body=bodies)
            number, held = number + 1, 0
            names.clear()
            sizes.clear()
            heads.clear()

        for b in batches:
            kind = b.schema.field(0).type
            sids, all_sizes = [], []
            for s in shingle_sets(b.column(1), n):
                sid = _fingerprint(s) if len(s) else None
                if sid is not None and sid not in seen:
                    seen.add(sid)
                    names.append(sid)
                    sizes.append(len(s))
                    heads.append(s[: _head_length(len(s), num, den)])
                    held += len(heads[-1])
                    if held >= CHUNK_TOKENS:
                        yield from flush()
                sids.append(sid)
                all_sizes.append(len(s))
            yield rows(b.column(0), b.num_rows, sid=sids, size=all_sizes)
        if heads:
            yield from flush()
        give_back()

    return docs.select("key", "text").mapInArrow(run, f"key {key_type}, {CHUNK_SCHEMA}")


def wanted_classes(table: DataFrame, num: int, den: int) -> DataFrame:
    """The sids of classes of whose head tokens enough stand in other heads too."""

    def find(part: pa.Table) -> pa.Table:
        held = [unpacked(x, 2) for x in part["body"].to_pylist()]
        tokens = np.concatenate([x[0] for x in held])
        order = np.argsort(tokens, kind="stable")
        start = np.flatnonzero(np.append(True, tokens[order][1:] != tokens[order][:-1]))
        count = np.diff(np.append(start, len(tokens)))
        several = np.add.reduceat(np.concatenate([x[1] for x in held])[order], start) + count.astype(np.uint64) > 1
        shared = np.empty(len(tokens), dtype=bool)
        shared[order] = np.repeat(several, count)
        cut = np.cumsum([0, *(len(x[0]) for x in held)])
        bits = [np.packbits(shared[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.table({"chunk": part["chunk"], "part": part["part"], "body": pa.array(bits, pa.binary()), "n": pa.array(np.diff(cut))})

    told = table.filter("part IS NOT NULL").select("chunk", "part", "body").groupBy("part").applyInArrow(find, "chunk bigint, part int, body binary, n bigint")

    def decide(chunk: pa.Table) -> pa.Table:
        chunk = chunk.sort_by("part")
        own = next(r for r in chunk.to_pylist() if r["part"] is None)
        answers = [r for r in chunk.to_pylist() if r["part"] is not None]
        shared = np.concatenate([np.unpackbits(np.frombuffer(r["body"], np.uint8), count=r["n"]) for r in answers]).astype(bool)
        owner, counts = (unpacked(own[x], 1, np.uint32, ascending=False)[0] for x in ("body", "counts"))
        sizes = np.frombuffer(own["sizes"], dtype="<i8")
        met = np.bincount(owner[np.repeat(shared, counts)], minlength=len(sizes))
        good = met >= _agree(-(-num * sizes // den), num, den)  # the size of the smallest partner
        return pa.table({"sid": pa.array([own["sids"][16 * k : 16 * k + 16] for k in np.flatnonzero(good).tolist()], pa.binary())})

    none = {"counts": "binary", "sids": "binary", "sizes": "binary"}
    asked = table.filter("part IS NULL AND chunk IS NOT NULL").select("chunk", "part", "body", F.lit(None).cast("bigint").alias("n"), *none)
    both = asked.union(told.select("chunk", "part", "body", "n", *(F.lit(None).cast(t).alias(x) for x, t in none.items())))
    return both.groupBy("chunk").applyInArrow(decide, "sid binary").distinct()


def _slot(sid: bytes) -> int:
    return int.from_bytes(sid[-3:], "big") % FILTER_BITS


def set_table(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(sid, size, tokens) of the wanted classes, each once, read anew from the texts.

    A bit filter of fixed size, sent to all tasks, spares most other rows; the join makes it exact.
    """
    spark = docs.sparkSession
    slot = F.conv(F.substring(F.hex("sid"), 27, 6), 16, 10).cast("int") % F.lit(FILTER_BITS)
    words = wanted.select(slot.alias("k")).groupBy(F.expr("k div 64").alias("g")).agg(F.bit_or(F.expr("shiftleft(1L, k % 64)")).alias("w"))
    rows = words.toPandas()  # FILTER_BITS / 64 rows at most
    mask = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    mask[rows["g"].to_numpy(dtype=np.int64)] = rows["w"].to_numpy(dtype=np.int64)
    mask = np.unpackbits(mask.view(np.uint8), bitorder="little").astype(bool)
    sent = spark.sparkContext.broadcast(np.packbits(mask))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, seen = np.unpackbits(sent.value).astype(bool), set()
        for b in batches:
            sids, sets, spreads = [], [], []
            for s in shingle_sets(b.column(0), n):
                if not len(s):
                    continue
                sid = _fingerprint(s)
                if near[_slot(sid)] and sid not in seen:
                    seen.add(sid)  # 16 bytes a class of this task's rows
                    sids.append(sid)
                    sets.append(s)
                    spreads.append(np.bincount(s & (PARTS - 1), minlength=PARTS))
            if sids:
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.binary()), _lists(sets), _lists(spreads)], names=["sid", "tokens", "spread"])
        give_back()

    found = docs.select("text").mapInArrow(run, "sid binary, tokens array<bigint>, spread array<bigint>")
    once = found.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.first(F.struct("tokens", "spread")).alias("s"))
    return once.select(F.monotonically_increasing_id().alias("nid"), "sid", F.size("s.tokens").cast("long").alias("size"), "s.tokens", "s.spread")


def _ordered_prefixes(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(nid, size, head: [(pos, token)], third: [hash]) of classes that share a rare-first prefix token."""
    flat = sets.select("nid", F.explode("tokens").alias("token"))
    often = flat.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    # (df, token) is all that travels; the hashes are worked out where the lists meet
    shared = flat.join(often, "token").groupBy("nid").agg(F.collect_list(F.struct("df", "token")).alias("l"))
    shared = shared.select(
        "nid",
        F.expr("sort_array(transform(l, x -> struct(x.df AS df, xxhash64(x.token) AS h, x.token AS token)))").alias("ts"),
        F.expr("sort_array(transform(l, x -> struct(x.df AS df, xxhash64(x.token, 7) AS h)))").alias("us"),
    )
    # the tokens that stand alone come first in either order
    keep = f"size - ((({num} * size) + {den} - 1) div {den}) + 1 - alone"
    return (
        shared.join(sets.select("nid", "size"), "nid")
        .withColumn("alone", F.col("size") - F.size("ts"))
        .withColumn("n_head", F.expr(f"cast({keep} AS int)"))
        .filter("n_head > 0")
        .select(
            "nid",
            "size",
            F.expr("transform(slice(ts, 1, n_head), (t, i) -> struct(t.token AS token, alone + i AS pos))").alias("head"),
            F.expr("transform(slice(us, 1, n_head), t -> t.h)").alias("third"),
        )
    )


def _verified(pairs: DataFrame, sides: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose prefixes meet under the first and third order and whose sets reach the threshold."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("nid")).distinct()
    used = sides.join(ids, "nid", "left_semi")
    one = used.select(*(F.col(x).alias(f"{x}_a") for x in used.columns))
    two = used.select(*(F.col(x).alias(f"{x}_b") for x in used.columns))
    both = pairs.join(one, pairs.a == one.nid_a).join(two, F.col("b") == F.col("nid_b"))
    both = both.filter(F.arrays_overlap("first_a", "first_b") & F.arrays_overlap("third_a", "third_b"))
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return both.filter(common * (num + den) >= num * (F.col("size_a") + F.col("size_b"))).select("a", "b")


def join_classes(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, root) of the classes that links join."""
    heads = stored(_ordered_prefixes(sets, num, den), "heads")
    first = f"slice(tokens, 1, cast(size - ((({num} * size) + {den} - 1) div {den}) + 1 AS int))"
    sides = stored(sets.join(heads.select("nid", "third"), "nid").select("nid", "size", "tokens", F.expr(first).alias("first"), "third"), "sides")
    post = stored(heads.select("nid", "size", F.explode("head").alias("t")).select(F.col("t.token").alias("token"), F.col("t.pos").alias("pos"), "size", "nid"), "posts")
    scratch = [sides, post]
    forget(heads)
    roots, links = None, None
    for leaders in (*LEADERS, None):
        own = post
        if roots is not None:
            own = own.join(roots, post.nid == roots.node, "left").select(*post.columns, F.coalesce("root", "nid").alias("comp"))
        else:
            own = own.withColumn("comp", F.col("nid"))
        extra, cols = ([] if leaders else ["spread"]), ("nid", "pos", "size", "comp")
        if leaders:
            # one row a token and task travels; the stored leaders let a hot token's join be split
            best = own.groupBy("token", F.pmod(F.xxhash64("nid"), F.lit(leaders)).alias("k")).agg(F.min(F.struct(*cols)).alias("l"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            best = best.groupBy("token").agg(F.collect_list("l").alias("ls"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo < hi")
            lead = stored(best.select("token", F.explode("ls").alias("l")).select("token", "l.*"), "leaders")
        else:
            mixed = own.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("token")
            lead = own = stored(own.join(mixed, "token").join(sets.select("nid", "spread"), "nid"), "mixed")
        lead_rows = lead.select(F.col("token").alias("l_token"), *(F.col(x).alias(f"l_{x}") for x in (*cols, *extra)))
        reach = f"least(size - pos, l_size - l_pos) * {num + den} >= {num} * (size + l_size)"
        order = "nid != l_nid" if leaders else "nid > l_nid"
        close = f"least(size, l_size) * {den} >= {num} * greatest(size, l_size)"
        if extra:  # a part's counts differ by no more than the tokens that only one of the sets holds
            apart = "aggregate(zip_with(spread, l_spread, (x, y) -> abs(x - y)), 0L, (s, v) -> s + v)"
            reach += f" AND (size + l_size - {apart}) * {num + den} >= {2 * num} * (size + l_size)"
        met = own.join(lead_rows, F.expr(f"token = l_token AND {order} AND comp != l_comp AND {close} AND {reach}"))
        pairs = met.select(F.least("nid", "l_nid").alias("a"), F.greatest("nid", "l_nid").alias("b")).distinct()
        pairs = stored(pairs, "pairs")
        scratch.append(stored(_verified(pairs, sides, num, den), "new"))
        forget(pairs)
        forget(lead)
        links = scratch[-1] if links is None else links.union(scratch[-1])
        if roots is not None:
            forget(roots)
        roots = star_components(links)
    for x in scratch:
        forget(x)
    return roots


def count_links(members: DataFrame, num: int, den: int) -> DataFrame:
    """From classes (nid, root, size, tokens, copies) of components: (nid, links), the number of rows of
    other classes that each class's rows are linked with.

    Each two blocks of a component are one group; small components share groups.
    """
    size = members.groupBy("root").agg(F.count("*").alias("m")).withColumn("n", F.expr(f"cast((m + {BLOCK - 1}) div {BLOCK} AS int)"))
    size = stored(size, "components")
    groups = 1 + (size.filter("n = 1").agg(F.sum("m")).first()[0] or 0) // (2 * BLOCK)
    own = members.join(size.select("root", "n"), "root").withColumn("block", F.expr("CASE WHEN n > 1 THEN cast(pmod(xxhash64(nid), n) AS int) ELSE 0 END"))
    met = own.select(
        F.expr(f"CASE WHEN n > 1 THEN root ELSE pmod(xxhash64(root), {groups}L) END").alias("g"),
        *("root", "nid", "size", "copies", "tokens", "block", (F.col("n") > 1).alias("large")),
        F.explode(F.expr("sequence(0, n - 1)")).alias("other"),
    )
    met = met.withColumn("b1", F.least("block", "other")).withColumn("b2", F.greatest("block", "other"))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("root")
        root, nid, sizes, copies, block = (group[x].to_numpy() for x in ("root", "nid", "size", "copies", "block"))
        lists = group["tokens"].combine_chunks()
        offsets, tokens = lists.offsets.to_numpy(), lists.values.to_numpy()
        out_nid, out_links = [], []
        b1, b2 = group["b1"][0].as_py(), group["b2"][0].as_py()
        edge = np.flatnonzero(np.append(True, root[1:] != root[:-1])).tolist() + [len(root)]
        for lo, hi in zip(edge[:-1], edge[1:], strict=True):
            m = hi - lo
            row = np.repeat(np.arange(m), np.diff(offsets[lo : hi + 1]))
            _, column, count = np.unique(tokens[offsets[lo] : offsets[hi]], return_inverse=True, return_counts=True)
            again = count > 1  # a token of one class alone adds to no pair
            row, column = row[again[column]], (np.cumsum(again) - 1)[column][again[column]]
            left, right = (np.flatnonzero(block[lo:hi] == b) for b in (b1, b2))  # one of two blocks may be empty
            common = np.zeros((len(left), len(right)), dtype=np.float32)
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            for at in range(0, int(again.sum()), SLICE):
                a, b = np.searchsorted(column, (at, at + SLICE))
                holds = np.zeros((m, min(SLICE, int(again.sum()) - at)), dtype=np.float32)
                holds[row[a:b], column[a:b] - at] = 1
                common += holds[left] @ holds[right].T
            own = sizes[lo:hi]
            linked = common.astype(np.int64) * (num + den) >= num * (own[left][:, None] + own[right][None, :])
            if b1 == b2:
                np.fill_diagonal(linked, False)
            out_nid.append(nid[lo:hi][left])
            out_links.append(linked @ copies[lo:hi][right])
            if b1 != b2:
                out_nid.append(nid[lo:hi][right])
                out_links.append(linked.T @ copies[lo:hi][left])
        return pa.table({"nid": np.concatenate(out_nid), "links": np.concatenate(out_links).astype(np.int64)})

    # a block meets itself in one group, not in as many as it has classes
    counted = met.groupBy("g", "large", "b1", "b2").applyInArrow(run, "nid bigint, links bigint")
    out = stored(counted.groupBy("nid").agg(F.sum("links").alias("links")), "counted")
    forget(size)
    return out


def components_of(docs: DataFrame, n: int, num: int, den: int, links: bool) -> DataFrame:
    """From (key, text), per row: key, n_shingles, component (its smallest key), and n_links if asked."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    table = stored(class_table(docs, n, num, den, 1 + size // RANGE_BYTES), "classes")
    wanted = stored(wanted_classes(table, num, den), "wanted")
    rows = stored(table.filter("chunk IS NULL").select("key", "sid", "size"), "rows")
    forget(table)
    sets = stored(set_table(docs, wanted, n), "sets")
    forget(wanted)
    roots = join_classes(sets, num, den)
    classes = rows.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    joined = sets.select("nid", "sid").join(roots, F.col("nid") == F.col("node")).select("nid", "sid", "root").join(classes, "sid")
    joined = stored(joined, "joined")
    least = joined.groupBy("root").agg(F.min("least").alias("component"))
    named, more = joined.join(least, "root").select("nid", "sid", "component"), []
    if links:
        counted = count_links(joined.select("nid", "root", "copies").join(sets.select("nid", "size", "tokens"), "nid"), num, den)
        named, more = named.join(counted, "nid"), ["links"]
    named = classes.join(named.drop("nid"), "sid", "left").select("sid", F.coalesce("component", "least").alias("component"), "copies", *more)
    named = stored(named, "named")
    # a class of many copies would be one task's rows; there are few such classes, so they go to all tasks
    hot = named.filter(f"copies > {HOT_COPIES}")
    few = hot.count() <= BROADCAST_KEYS
    own = rows.select("key", F.col("size").alias("n_shingles"), "sid")
    if few:
        tagged = own.join(F.broadcast(hot), "sid", "left")
        out = tagged.filter("component IS NOT NULL")
        rest = tagged.filter("component IS NULL").select(*own.columns)
        out = out.unionByName(rest.join(named.filter(f"copies <= {HOT_COPIES}"), "sid", "left").select(*out.columns))
    else:
        out = own.join(named, "sid", "left")
    counts = [(F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links")] if links else []
    out = stored(out.select("key", "n_shingles", F.coalesce("component", "key").alias("component"), *counts), "components")
    for x in (rows, sets, joined, roots, named, *([counted] if links else [])):
        forget(x)
    return out


def ngram_components(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text: str = "text", links: bool = True) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, the smallest doc_id that links of Jaccard >= num/den
    reach, and n_links, the number of other rows that it is linked with, copies included."""
    out = components_of(docs.select(F.col(id_col).alias("key"), F.col(text).alias("text")), n, num, den, links)
    return out.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), *(["n_links"] if links else []))


def keep_one_each(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One row of each component, with the input's columns: that of the smallest doc_id, if several rows
    have that id the one whose text's hash is smallest, and any one of rows that share id and text.

    Rows are told apart by id and text, so rows without an id take part, and rows of one id with
    different texts are judged each on its own. Rows without words all stay.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), text_key(F.col("text")).alias("t"))
    found = components_of(docs.select(key.alias("key"), "text"), n, num, den, links=False)
    marks = found.filter("n_shingles > 0").groupBy("key").agg(F.count("*").alias("n"), F.first("component").alias("component"))
    marks = marks.filter("key != component OR n > 1").select(F.col("key.id").alias("_i"), "key.t.*", (F.col("key") == F.col("component")).alias("_once"))
    marks = stored(marks, "marks")
    forget(found)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    id_col, text = (F.col(names[docs.columns.index(x)]) for x in ("doc_id", "text"))
    small = marks.count() <= BROADCAST_KEYS
    own = plain.withColumn("_k", text_key(text))
    own = own.join(F.broadcast(marks) if small else marks, id_col.eqNullSafe(F.col("_i")) & (F.col("_k.k1") == F.col("k1")) & (F.col("_k.k2") == F.col("k2")), "left")
    once = own.filter("_once").dropDuplicates(["_i", "k1", "k2"])
    return own.filter("_once IS NULL").select(*names).union(once.select(*names)).toDF(*docs.columns)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of 3-word shingle sets of Jaccard 0.9 and more over the whole of ``documents``."""
    return ngram_components(read_table(spark, sf_dir, "documents"), 3, 90, 100)
