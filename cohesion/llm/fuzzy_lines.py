"""Line deduplication across the corpus: near-equal lines, one kept of each component.

A line is stripped, lower-cased and cut into runs of eight characters; a shorter
line is one shingle. One hash of each shingle fills ``BANDS * ROWS`` bins of its
line with the least value (empty bins borrow from others), which gives a MinHash
signature in one pass over the text. Lines that share a band meet; components of
that graph are verified by exact Jaccard on full shingle sets, and union-find over
the verified pairs gives the final components. The line kept is the first by
(doc_id, text key, line number).

Blank lines are paragraph breaks: never duplicates, always kept. Null texts count as
empty. A null doc_id is the smallest. Rows that repeat doc_id and text are the same
document and each get its result. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import arrow_map, bound_rows, cut, give_back
from .near import SENT, SHIFTS, bucket_edges, chunked, components, join_per_key, key_filter, may_hold, part_of, sized, verify
from .ngram_join import NULL_ID, band_hashes, keyed, mix

SHINGLE, THRESHOLD = 8, 0.8
#: A pair at 0.8 shares one of 12 buckets of 5 minima with probability 0.99, at 0.9 with 0.99998.
BANDS, ROWS = 12, 5
EMPTY = np.uint64(2**64 - 1)
BLOCK_CHARS = 16_384
#: One occurrence of a line: its key, where it stands, its length. The block of a key.
LINE = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("doc_id", "<i8"), ("d1", "<i8"), ("line", "<i4"), ("size", "<i4")])
BLOCK = np.dtype([("k1", "<i8"), ("block", "<i8")])
#: Occurrences in one row of ``read_lines``, and those that meet in one task.
TOGETHER, MEET = 20_000, 200_000
#: What is sent to meet: a line's first occurrence in a batch, its later ones, the blocks of keys.
FIRST, LATER, BLOCKS = range(3)


def line_key(line: str) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "replace"))
    a, b = h >> 64, h & (2**64 - 1)
    return a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b


def line_keys(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``line_key`` of each line, as two columns."""
    both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(s.encode("utf-8", "replace")) for s in lines]), ">i8").astype(np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, line) of every shingle; lines are not empty."""
    h = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h += np.uint64(1)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    end = np.cumsum(size)
    for step in (1, 2, 4):  # hashes of 2, 4, 8 characters
        after = h * np.uint64(pow(0x9E3779B97F4A7C15, step, 1 << 64))
        after[:-step] += h[step:]
        h = after
    count = np.maximum(size - SHINGLE + 1, 0)
    short = np.flatnonzero(count == 0)
    whole = np.fromiter((xxhash.xxh3_64_intdigest(lines[i].encode("utf-8", "replace")) for i in short), np.uint64, len(short))
    begins = np.ones(len(h), bool)  # where a whole shingle of one line begins
    for back in range(1, SHINGLE):
        begins[np.maximum(end - back, end - size)] = False
    return mix(np.concatenate([h[begins], whole])), np.concatenate([np.repeat(np.arange(len(lines)), count), short])


def signatures(lines: list[str], bins: int = BANDS * ROWS) -> np.ndarray:
    """The least hash in each bin of each line; an empty bin takes another's, found by trying bins in an order of its own.
    Lines are signed in blocks of about ``BLOCK_CHARS`` characters, whose arrays stay in the processor's cache."""
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines))) // BLOCK_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1), len(lines)] if lines else [0]
    return np.concatenate([np.zeros((0, bins), np.uint64), *(_sign(lines[a:b], bins) for a, b in zip(cuts, cuts[1:]))])


@lru_cache(maxsize=2)
def _donors(bins: int) -> np.ndarray:
    """For each bin, the order in which it tries the bins if it is empty."""
    rng = np.random.default_rng(11)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def _sign(lines: list[str], bins: int) -> np.ndarray:
    out = np.full((len(lines), bins), EMPTY)
    h, owner = shingle_hashes(lines)
    at = h >> np.uint64(32)
    at *= np.uint64(bins)
    at >>= np.uint64(32)
    owner *= bins
    owner += at.view(np.int64)
    h &= np.uint64(0xFFFFFFFF)
    np.minimum.at(out.ravel(), owner, h)
    row, col = np.nonzero(out == EMPTY)
    order = _donors(bins)[col]
    first = (out[row[:, None], order] != EMPTY).argmax(1)
    out[row, col] = out[row, order[np.arange(len(row)), first]]
    return out


def stripped(line: str) -> str:
    return line.strip().lower()


def prepared(text: str) -> list[tuple[int, str]]:
    """(line number, line stripped and lower-cased) of the lines that aren't blank."""
    return [(i, s) for i, line in enumerate(text.split("\n")) if (s := stripped(line))]


def read_lines(docs: DataFrame) -> DataFrame:
    """The lines that aren't blank, many in a row: ``n`` occurrences, which ``lines`` holds as LINE, and of the different lines
    among them ``id``, the first key, with ``bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen, found = {}, []  # the equal lines of a batch are signed once
            for k, text in enumerate(b.column(2).to_pylist()):
                found += [(k, i, seen.setdefault(s, len(seen))) for i, s in prepared(text)]
            owner, line, at = np.array(found, np.int64).reshape(-1, 3).T
            todo = list(seen)
            k1, k2 = line_keys(todo)
            lines = np.empty(len(found), LINE)
            lines["k1"], lines["k2"], lines["line"] = k1[at], k2[at], line
            lines["doc_id"], lines["d1"] = (b.column(c).to_numpy(zero_copy_only=False)[owner] for c in (0, 1))
            lines["size"] = np.fromiter(map(len, todo), np.int32, len(todo))[at]
            for k in range(0, len(lines), TOGETHER):
                some = slice(k, k + TOGETHER)
                bands = band_hashes(signatures(todo[some]), BANDS, ROWS)
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(lines[some])], pa.int32())} | {
                    c: pa.array([v.tobytes()], pa.binary()) for c, v in (("lines", lines[some]), ("id", k1[some]), ("bands", bands))})
        give_back()

    bound_rows(docs.sparkSession)
    return docs.select("doc_id", "k1", "text").mapInArrow(run, "n int, lines binary, id binary, bands binary")


def unpacked(batches: Iterator[pa.RecordBatch], *kinds: np.dtype) -> Iterator[list[np.ndarray]]:
    """The values in binary columns, those of many rows at once."""
    held, size = [], 0
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in range(len(kinds)))):
            held.append([np.frombuffer(x, kind) for x, kind in zip(row, kinds)])
            size += len(held[-1][0])
            if size >= SENT:
                yield [np.concatenate(c) for c in zip(*held)]
                held, size = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def read_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for ids, bands in unpacked(batches, np.int64, np.int64):
        yield np.repeat(ids, BANDS), bands


def combine(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first occurrence of each line, and the occurrences that aren't their line's first."""
    lines = lines[np.argsort(lines["k1"], kind="stable")]
    same = lines["k1"][1:] == lines["k1"][:-1]
    alone = ~(np.append(same, False) | np.append(False, same))[:len(lines)]
    rest = lines[~alone]
    rest = rest[np.lexsort([rest[c] for c in ("line", "d1", "doc_id", "k2", "k1")])]
    new = np.ones(len(rest), bool)
    new[1:] = (rest["k1"][1:] != rest["k1"][:-1]) | (rest["k2"][1:] != rest["k2"][:-1])
    first = rest[new]
    lead = first[np.cumsum(new) - 1]
    later = (rest["doc_id"] != lead["doc_id"]) | (rest["d1"] != lead["d1"]) | (rest["line"] != lead["line"])
    return np.concatenate([lines[alone], first]), rest[later]


def first_lines(packed: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """From ``read_lines`` and (id, root) of the candidates: each occurrence that isn't its line's first (doc_id, d1, line; such
    go whatever the line is near to), and the first of each line that has a block. ``n`` lines at most; a range of their keys
    meets in one task. A line's copies are combined before they are sent, so a common one is a few rows there."""
    parts = max(1, -(-n // MEET))

    def sent(kind: int, cuts: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(np.diff(cuts))
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([kind] * len(some), pa.int32()),
                                           pa.array([rows[slice(*cuts[k:k + 2])].tobytes() for k in some], pa.binary())], names=["part", "kind", "rows"])

    def by_key(kind: int, rows: np.ndarray) -> pa.RecordBatch:
        part = part_of(rows["k1"].copy(), parts)
        order = np.argsort(part, kind="stable")
        return sent(kind, np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64)), rows[order])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines, in unpacked(batches, LINE):
            first, later = combine(lines)
            yield by_key(FIRST, first)
            yield sent(LATER, np.linspace(0, len(later), parts + 1).astype(int), later)
        give_back()

    def deal_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sized(batches, SENT):
            rows = np.empty(b.num_rows, BLOCK)
            rows["k1"], rows["block"] = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            yield by_key(BLOCKS, rows)

    def told(lines: np.ndarray, block: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(lines), 100_000):
            some = lines[k:k + 100_000]
            more = {"k1": some["k1"], "k2": some["k2"], "n": some["size"], "block": block[k:k + 100_000]} if block is not None else {}
            cols = {"doc_id": some["doc_id"], "d1": some["d1"], "line": some["line"]} | more
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name].copy()) if f.name in cols else pa.nulls(len(some), f.type) for f in schema], schema=schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, blocks = [np.empty(0, LINE)], [np.empty(0, BLOCK)]
        for b in batches:
            for kind, rows in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                if kind == LATER:
                    yield from told(np.frombuffer(rows, LINE))
                elif kind == FIRST:
                    lines.append(np.frombuffer(rows, LINE))
                else:
                    blocks.append(np.frombuffer(rows, BLOCK))
        first, later = combine(np.concatenate(lines))
        lines = []
        yield from told(later)
        blocks = np.concatenate(blocks)
        blocks = blocks[np.argsort(blocks["k1"])]
        if len(blocks):
            at = np.minimum(np.searchsorted(blocks["k1"], first["k1"]), len(blocks) - 1)
            known = blocks["k1"][at] == first["k1"]
            yield from told(first[known], blocks["block"][at[known]])
        give_back()

    names = "doc_id long, d1 long, line int, k1 long, k2 long, n int, block long"
    schema = to_arrow_schema(T.StructType.fromDDL(names))
    dealt = "part int, kind int, rows binary"
    return (packed.select("lines").mapInArrow(deal, dealt).unionByName(blocks.select("id", "root").mapInArrow(deal_blocks, dealt))
            .repartitionById(parts, F.col("part")).mapInArrow(meet, names))


def line_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, d1, line) of every occurrence to drop, d1 being the text's key; rows that repeat a document may repeat its."""
    d = docs.select("doc_id", "k1", "text")
    packed = cut(read_lines(d), "lines")
    total = packed.agg(F.sum("n")).first()[0] or 0
    # the candidate graph goes by k1 alone: two lines that share it by chance are merely candidates
    candidates = components(bucket_edges(packed, total * BANDS, read_bands))
    # a line's later copies go, near to others or not; of near lines, all firsts but the least
    lines = cut(first_lines(packed, candidates, total).withColumn("id", F.monotonically_increasing_id()), "firsts")
    near = cut(chunked(lines.where("block is not null")), "members")
    several = near.count()
    place = F.col("d1")
    for s in SHIFTS:
        place = place.bitwiseXOR(F.shiftleft(F.col("line").cast("long"), s))
    words = key_filter(near.select(place.alias("place")), "place", several)

    def fetch():
        def f(cols):
            """The lines whose places the filter holds, in columns; no other is split from its text."""
            count = np.fromiter((t.count("\n") + 1 for t in cols["text"]), np.int64, len(cols["text"]))
            owner = np.repeat(np.arange(len(count)), count)
            line = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            place = np.array(cols["k1"], np.int64)[owner]
            for s in SHIFTS:
                place ^= line << s
            held = np.flatnonzero(may_hold(words, place))
            rows, of = [], -1
            for k, i in zip(owner[held].tolist(), line[held].tolist()):
                if k != of:
                    of, split = k, cols["text"][k].split("\n")
                if s := stripped(split[i]):
                    rows.append((cols["doc_id"][k], cols["k1"][k], i, s))
            names = ("doc_id", "d1", "line", "text")
            out = dict(zip(names, zip(*rows))) if rows else dict.fromkeys(names, ())
            out["k1"], out["k2"] = line_keys(out["text"])
            return out

        return f

    texts = arrow_map(d, "doc_id long, d1 long, line int, k1 long, k2 long, text string", fetch)
    texts = texts.join(near.select("id", "block", "chunks", "doc_id", "d1", "line", "k1", "k2"), ["doc_id", "d1", "line", "k1", "k2"])

    def items():
        def f(cols):
            h, owner = shingle_hashes(cols["text"])
            order = np.argsort(owner, kind="stable")
            h, owner = h[order].view(np.int64), owner[order]
            parts = np.split(h, np.searchsorted(owner, np.arange(1, len(cols["text"]))))
            return {"id": cols["id"], "block": cols["block"], "chunks": cols["chunks"], "items": [np.unique(p) for p in parts]}

        return f

    sets = arrow_map(texts.select("id", "block", "chunks", "text"), "id long, block long, chunks int, items array<long>", items)
    verified = cut(verify(sets, threshold).where("links > 0"), "verified")
    joined = components(verified.select(F.col("id").alias("a"), F.col("root").alias("b")))
    first = F.struct("doc_id", "d1", "line")
    member = cut(near.join(joined, "id").select("root", "doc_id", "d1", "line"), "joined")
    per_class = cut(member.groupBy("root").agg(F.min(first).alias("keep"), F.count("*").alias("texts")), "classes")
    hit = join_per_key(member, per_class, ["root"], "texts", several).where(first != F.col("keep"))
    return lines.where("block is null").select("doc_id", "d1", "line").unionByName(hit.select("doc_id", "d1", "line"))


def drop_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, n_lines, n_kept, text without the dropped lines."""
    d = keyed(docs)
    gone = cut(line_classes(d, threshold).groupBy("doc_id", F.col("d1").alias("k1")).agg(F.collect_set("line").alias("gone")), "gone")
    # texts that lose nothing, which a small filter tells for most, are not moved to meet their dropped lines
    words = key_filter(gone, "k1", gone.count())
    maybe = F.pandas_udf(lambda k: pd.Series(may_hold(words, k.to_numpy())), "boolean")
    at = d.select("doc_id", "k1", "text").withColumn("moved", maybe("k1"))

    def rebuild():
        def f(cols):
            out = {"doc_id": [None if i == NULL_ID else i for i in cols["doc_id"]], "n_lines": [], "n_kept": [], "text": []}
            for text, drop in zip(cols["text"], cols["gone"]):
                lines = text.split("\n")
                n = len(lines)
                if drop:
                    drop = set(drop)
                    lines = [x for i, x in enumerate(lines) if i not in drop]
                out["n_lines"].append(n)
                out["n_kept"].append(len(lines))
                out["text"].append("\n".join(lines))
            return out

        return f

    n = (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long")
    whole = at.where("not moved").select(F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), n.alias("n_lines"), n.alias("n_kept"), "text")
    joined = at.where("moved").drop("moved").join(gone, ["doc_id", "k1"], "left").select("doc_id", "text", "gone")
    return arrow_map(joined, "doc_id long, n_lines long, n_kept long, text string", rebuild).unionByName(whole)
