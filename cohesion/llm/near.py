"""What the similarity joins share: candidate graph, components, exact verification in blocks.

1. ``bucket_edges``: rows that share a band hash are linked to the smallest id of that bucket. Rows are
   combined inside each batch first, so a bucket with a third of all rows reaches the shuffle as a few rows.
2. ``components``: distributed union-find by alternating large and small stars, each round a written table.
3. ``verify``: all pairs at or above the threshold inside the candidate components, on full sets. Large
   components are dealt into chunks and every pair of chunks is a task, so no group is held whole; pairs are
   counted where they are found and never become rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, cut, give_back

#: Keys with at least 1/HOT of the rows are joined by broadcast: there are at most HOT of them.
HOT = 1000
#: Set elements in one chunk of a component.
CHUNK = 300_000
#: Sets of a block that are compared pair by pair, with how many elements at most, and rows that leave verification together.
FEW, FEW_ITEMS, TOLD = 5, 5_000, 5_000
#: Buckets that meet in one task, and rows combined before they are sent.
PART, SENT = 400_000, 60_000
#: Cells of a dense incidence matrix in verification.
DENSE = 4_000_000
#: Where in a 64-bit hash the bit positions of the Bloom filter begin.
SHIFTS = (0, 13, 26, 39)


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """rows joined with per_key, which has one row for a key and in column ``n`` how many rows it has (dropped
    here). Keys with a large share of ``total`` are at most HOT and are broadcast; the rest are shuffled."""
    hot = per_key.where(F.col(n) * HOT >= total)
    cold = per_key.where(F.col(n) * HOT < total).drop(n)
    return (rows.join(F.broadcast(hot.drop(n)), keys)
            .unionByName(rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)))


def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(id, bucket) of rows with an id and a list of buckets, many rows at once."""
    for b in sized(batches, SENT):
        ids, bands = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
        yield np.repeat(ids, np.diff(bands.offsets.to_numpy())), bands.flatten().to_numpy(zero_copy_only=False)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """In which of ``parts`` equal ranges each 64-bit hash lies."""
    return ((h.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def bucket_edges(rows: DataFrame, n: int, read: Callable = banded) -> DataFrame:
    """(a, b) with a > b from (id, bands): each id with the smallest of every bucket it shares. Buckets are hashes, ``n`` at
    most; a range of them meets in one task, to which each batch sends its own as one row. ``read`` tells ids and buckets
    of the rows."""
    parts = max(1, -(-n // PART))

    def combine(bucket: np.ndarray, ids: np.ndarray):
        """Distinct buckets, in order, with their smallest id; the other ids with it."""
        order = np.argsort(bucket)
        bucket, ids = bucket[order], ids[order]
        new = np.ones(len(bucket), bool)
        new[1:] = bucket[1:] != bucket[:-1]
        begin = np.flatnonzero(new)
        first = np.minimum.reduceat(ids, begin) if len(begin) else ids
        size = np.diff(np.append(begin, len(ids)))
        some = np.repeat(size > 1, size)
        lead, ids = np.repeat(first, size)[some], ids[some]
        return bucket[begin], first, np.stack([ids[ids != lead], lead[ids != lead]], 1)

    def sent(known: bool, cuts: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(np.diff(cuts))
        own = [slice(*cuts[k:k + 2]) for k in some]
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([known] * len(some), pa.bool_()), pa.array([x[k].tobytes() for k in own], pa.binary()),
                                           pa.array([y[k].tobytes() for k in own], pa.binary())], names=["part", "known", "x", "y"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bucket in read(batches):
            bucket, first, pairs = combine(bucket, ids)
            yield sent(False, np.searchsorted(part_of(bucket, parts), np.arange(parts + 1, dtype=np.uint64)), bucket, first)
            pairs = np.unique(pairs, axis=0)
            # pairs that are known go evenly to all parts, so they don't meet again in the hot bucket
            yield sent(True, np.linspace(0, len(pairs), parts + 1).astype(int), pairs[:, 0], pairs[:, 1])
        give_back()

    def told(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(a), 100_000):
            x, y = a[k:k + 100_000], b[k:k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["a", "b"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            for known, x, y in zip(*(b.column(c).to_pylist() for c in (1, 2, 3))):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                if known:
                    yield from told(x, y)
                else:
                    held.append((x, y))
        if held:
            pairs = combine(*(np.concatenate(c) for c in zip(*held)))[2]
            held = []
            yield from told(pairs[:, 0], pairs[:, 1])
        give_back()

    dealt = rows.select("id", "bands").mapInArrow(deal, "part int, known boolean, x binary, y binary")
    return dealt.repartitionById(parts, F.col("part")).mapInArrow(link, "a long, b long")


def sized(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least that many rows, but for the last."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _is_stars(edges: DataFrame) -> bool:
    """Whether each id has one edge at most and no root has one: large and small stars change nothing then."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("root").alias("root")).where("up > 1 or up + root > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id of ``edges`` (a, b); root is the smallest id of its component."""
    e = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _is_stars(e):
        total = e.count()
        # large star: larger neighbours go to the smallest of the neighbourhood
        both = e.select(F.col("a").alias("n"), F.col("b").alias("x")).unionByName(e.select(F.col("b").alias("n"), F.col("a").alias("x")))
        least = cut(both.groupBy("n").agg(F.least(F.min("x"), F.min("n")).alias("m"), F.count("*").alias("degree")), "large")
        large = cut(join_per_key(e.select(F.col("b").alias("n"), F.col("a").alias("x")), least, ["n"], "degree", 2 * total)
                    .select(F.col("x").alias("a"), F.col("m").alias("b")).distinct(), "large")
        # small star: smaller neighbours and the node itself go to the smallest
        least = cut(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree")), "small")
        small = (join_per_key(large, least, ["a"], "degree", total).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        e = cut(small.distinct(), "edges")
    return e.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())


def chunked(members: DataFrame) -> DataFrame:
    """(id, n, block) with ``chunks``: into how many parts its block is dealt."""
    sizes = members.groupBy("block").agg(F.ceil(F.sum("n") / CHUNK).cast("int").alias("chunks"), F.count("*").alias("members"))
    total = members.count()
    return join_per_key(members, cut(sizes.where("members > 1"), "blocks"), ["block"], "members", total)


def verify(sets: DataFrame, threshold: float) -> DataFrame:
    """(id, links, root) from (id, block, chunks, items): in each pair of chunks, the id's similar others counted,
    and the smallest id it is connected to there. Sum links by id; roots are edges of the final graph."""
    dealt = (sets.withColumn("c", F.pmod(F.xxhash64("id"), F.col("chunks")))
             .withColumn("d", F.explode(F.sequence(F.lit(0), F.greatest(F.col("chunks"), F.lit(1)) - 1)))
             .select("block", F.least("c", F.col("d").cast("long")).alias("i"), F.greatest("c", F.col("d").cast("long")).alias("j"), "id", (F.col("c") != F.col("d")).alias("apart"), "c", "items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, side, sets = None, [], [], []

        told, rows = [], 0  # most blocks are small: they leave together

        def close():
            links, root = similar(np.array(ids), np.array(side), sets, threshold, at[1] != at[2])
            told.append((ids, links, root))
            return len(ids)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*told)], names=["id", "links", "root"])

        for b in batches:
            items = b.column(5)
            offsets, values = items.offsets.to_numpy(), items.values.to_numpy(zero_copy_only=False)
            for k, (block, i, j, one, c) in enumerate(zip(*(b.column(x).to_pylist() for x in range(5)))):
                if (block, i, j) != at:
                    if len(ids) > 1:
                        rows += close()
                        if rows >= TOLD:
                            yield out()
                            told, rows = [], 0
                    at, ids, side, sets = (block, i, j), [], [], []
                if ids and ids[-1] == one:
                    continue  # a repeated row
                ids.append(one)
                side.append(c)
                sets.append(values[offsets[k]:offsets[k + 1]].copy())
        if len(ids) > 1:
            close()
        if told:
            yield out()
        told, ids, side, sets = [], [], [], []
        give_back()

    bound_batches(sets.sparkSession)
    return (dealt.select("block", "i", "j", "id", "c", "items").repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "id")
            .mapInArrow(run, "id long, links long, root long"))


def similar(ids: np.ndarray, side: np.ndarray, sets: list[np.ndarray], threshold: float, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """How many others each set is similar to, and the smallest id of those connected to it. With ``across`` only
    pairs of different sides count."""
    m = len(sets)
    if m <= FEW and sum(map(len, sets)) <= FEW_ITEMS:
        return _few(ids, side, sets, threshold, across)
    size = np.array([len(s) for s in sets], np.int64)
    token, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    run = np.cumsum(new) - 1
    count = np.bincount(run, minlength=1)
    shared = count[run] > 1  # others can't be in an intersection
    owner, run = owner[shared], run[shared]
    _, run = np.unique(run, return_inverse=True)
    width = int(run.max()) + 1 if len(run) else 0
    links, label = np.zeros(m, np.int64), np.arange(m)

    def found(i: int, others: np.ndarray) -> None:
        links[i] += len(others)
        links[others] += 1
        together = np.unique(label[np.append(others, i)])
        if len(together) > 1:
            label[np.isin(label, together)] = together[0]

    if width and m * width <= DENSE:
        matrix = np.zeros((m, width), np.float32)
        matrix[owner, run] = 1
        for a in range(0, m, 256):
            both = matrix[a:a + 256] @ matrix[a:].T
            near = both >= threshold * (size[a:a + 256, None] + size[None, a:] - both) - 1e-6
            for k in range(len(both)):
                others = a + np.flatnonzero(near[k])
                others = others[others > a + k]
                if across:
                    others = others[side[others] != side[a + k]]
                if len(others):
                    found(a + k, others)
    elif width:
        start = np.searchsorted(run, np.arange(width + 1))
        by_owner = np.argsort(owner, kind="stable")
        own_run, own_at = run[by_owner], np.searchsorted(owner[by_owner], np.arange(m + 1))
        for i in range(m):
            t = own_run[own_at[i]:own_at[i + 1]]
            if not len(t):
                continue
            n = start[t + 1] - start[t]
            at = np.repeat(start[t] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=m)
            others = np.flatnonzero(both >= threshold * (size[i] + size - both) - 1e-6)
            others = others[others > i]
            if across:
                others = others[side[others] != side[i]]
            if len(others):
                found(i, others)
    least = np.full(m, np.iinfo(np.int64).max)
    np.minimum.at(least, label, ids)
    return links, least[label]


def _few(ids: np.ndarray, side: np.ndarray, sets: list[np.ndarray], threshold: float, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """``similar`` of a few sets, pair by pair: a value that comes twice in two sets put together is in both."""
    m = len(sets)
    links, label = [0] * m, list(range(m))
    for i in range(m):
        for k in range(i + 1, m):
            if across and side[i] == side[k]:
                continue
            n = len(sets[i]) + len(sets[k])
            most = min(len(sets[i]), len(sets[k]))
            if most < threshold * (n - most) - 1e-6:
                continue  # too unlike in size
            both = np.concatenate([sets[i], sets[k]])
            both.sort()
            both = int((both[1:] == both[:-1]).sum())
            if both and both >= threshold * (n - both) - 1e-6:
                links[i] += 1
                links[k] += 1
                old, new = max(label[i], label[k]), min(label[i], label[k])
                label = [new if x == old else x for x in label]
    least = {}
    for x, one in zip(label, ids.tolist()):
        least[x] = min(one, least.get(x, one))
    return np.array(links, np.int64), np.array([least[x] for x in label], np.int64)


def key_filter(keys: DataFrame, column: str, n: int, most_bits: int = 1 << 24) -> np.ndarray:
    """A Bloom filter of a column of hashes, 16 bits a key and ``most_bits`` at most, so it is small whatever the
    corpus. It thins what is shuffled to a join; the join decides, so a full filter costs time and no rows."""
    bits = 1 << max(16, min(most_bits.bit_length() - 1, (16 * n).bit_length()))
    at = F.explode(F.array(*(F.shiftrightunsigned(column, s).bitwiseAND(F.lit(bits - 1)) for s in SHIFTS))).alias("bit")
    words = (keys.select(at).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")))
    out = np.zeros(bits // 64, np.int64)
    got = words.toPandas()
    out[got["word"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64)
    return out.view(np.uint64)


def may_hold(words: np.ndarray, keys: list[int] | np.ndarray) -> np.ndarray:
    """Whether each key may be one of the filter's."""
    key = np.array(keys, np.int64).view(np.uint64)
    held = np.ones(len(key), bool)
    for s in SHIFTS:
        bit = (key >> np.uint64(s)) & np.uint64(len(words) * 64 - 1)
        held &= ((words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)
    return held
