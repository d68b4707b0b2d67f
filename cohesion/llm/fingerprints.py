"""Document fingerprints by improbable features, for likeness of versions of a text.

A feature is a window of 64 bytes. Its rarity is how seldom windows of its
entropy are in the whole corpus (``entropy_counts``; a fixed number of entropy
bins, so small and bounded). In every run of 64 windows the rarest wins; a
window that wins often enough is selected. Selected features go, five bits
each, into a chain of 2048-bit Bloom filters of at most 160 features. Two
fingerprints are alike by how far the bit overlap of each filter with its best
match exceeds what chance gives, scaled to 0..1.

Texts under 64 bytes are one feature. The empty text has the empty fingerprint,
like only to itself (1.0). Null texts count as empty. Equal texts have equal
fingerprints within a run, as the corpus counts are the same.

The edited text of a document takes its second half from the next document in
descending order (doc_id, nulls last; then a hash of the text; the last is followed
by the first). Documents are dealt into ranges of that order, each with a copy of the
row that follows it, and read as sorted streams: no task holds a range in memory. A
doc_id that many rows have, null above all, is cut into ranges by the hash; rows equal in
doc_id and text stay in one range.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import arrow_map, bound_batches, text_or_empty

WINDOW, RUN, WINS = 64, 64, 16
BITS, HASHES, PER_FILTER = 2048, 5, 160
#: Entropy bins: c*log2(c) summed over a window's byte counts lies in 0..384; eighths are told apart.
SCALE = 8
N_BINS = WINDOW * 6 * SCALE + 1
#: Windows whose bins are found at once, bytes of texts taken together for that, selected windows hashed at once.
BLOCK, TOGETHER, HASHED = 32_768, 262_144, 4_096
#: Characters in one range of the order; sets how many ranges there are.
RANGE_CHARS = 32_000_000

_F = np.array([round(SCALE * 16 * c * math.log2(c)) if c else 0 for c in range(WINDOW + 2)], np.int32)
# what one more of a byte adds, by how many there are
_MORE = np.diff(_F)
# odd multipliers of the window hash, from a fixed seed
_MULT = np.random.default_rng(20240229).integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_AHEAD = np.arange(WINDOW)


def entropy_bins(b: np.ndarray) -> np.ndarray:
    """The bin of every window of 64 bytes; a low bin is high entropy."""
    n = max(0, len(b) - WINDOW + 1)
    out = np.empty(n, np.int16)
    for a in range(0, n, BLOCK):
        out[a:a + BLOCK] = _block_bins(b[a:a + BLOCK + WINDOW - 1])
    return out


def _block_bins(b: np.ndarray) -> np.ndarray:
    """Each step removes one byte and adds one, so only their counts in the window matter: equal bytes at each
    distance, summed forward and backward."""
    n = len(b)
    ahead, back, same = np.zeros(n, np.uint8), np.zeros(n, np.uint8), np.empty(n, bool)
    told = same.view(np.uint8)
    for d in range(1, WINDOW):
        m = n - d
        np.equal(b[:m], b[d:], out=same[:m])
        one = told[:m]
        x, y = ahead[:m], back[d:]
        np.add(x, one, out=x)
        np.add(y, one, out=y)
    s = np.empty(n - WINDOW + 1, np.int32)
    s[0] = _F[np.bincount(b[:WINDOW], minlength=256)].sum()
    s[1:] = _MORE[back[WINDOW:]]
    s[1:] -= _MORE[ahead[:n - WINDOW]]
    np.cumsum(s, out=s)
    return s >> 4


def bins_of_all(raws: list[bytes]) -> list[np.ndarray]:
    """``entropy_bins`` of each text, found over the texts put end to end: short arrays cost more to begin than to fill."""
    bins, at, out = entropy_bins(np.frombuffer(b"".join(raws), np.uint8)), 0, []
    for r in raws:
        out.append(bins[at:at + max(0, len(r) - WINDOW + 1)])
        at += len(r)
    return out


def groups(sizes: list[int]) -> list[slice]:
    """Runs of texts with about TOGETHER bytes, or one longer text."""
    place = np.cumsum(sizes) // TOGETHER if sizes else np.zeros(0, int)
    cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(sizes)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def entropy_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all texts fall in each entropy bin."""
    def make():
        def f(cols):
            total, raws = np.zeros(N_BINS, np.int64), [text.encode() for text in cols["text"]]
            for g in groups([*map(len, raws)]):
                total += np.bincount(np.concatenate(bins_of_all(raws[g])), minlength=N_BINS)[:N_BINS]
            bins = np.flatnonzero(total)
            return {"bin": bins.tolist(), "n": total[bins].tolist()}

        return f

    rows = arrow_map(docs.select(text_or_empty().alias("text")), "bin int, n long", make).groupBy("bin").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(N_BINS, np.int64)
    for r in rows:
        out[r["bin"]] = r["n"]
    return out


def rarity_ranks(counts: np.ndarray) -> np.ndarray:
    """0 for the rarest entropy bin that occurs; ties go to the higher entropy."""
    order = np.lexsort((np.arange(len(counts)), counts))
    ranks = np.empty(len(counts), np.int64)
    ranks[order] = np.arange(len(counts))
    return ranks


def around(b: bytes | np.ndarray, seam: int) -> bytes | np.ndarray:
    """The bytes of the windows over a seam."""
    return b[max(0, seam - WINDOW + 1):seam + WINDOW - 1]


def joined_bins(b: bytes | np.ndarray, seam: int, left: np.ndarray, right: np.ndarray, over: np.ndarray | None = None) -> np.ndarray:
    """The bins of two stretches of bytes put together at ``seam``, from the bins of the texts that they begin: a window's bin is
    that of its bytes, so only windows over the seam are new. ``over``: the bins of ``around(b, seam)``, if they are known."""
    a, c = max(0, seam - WINDOW + 1), max(0, len(b) - seam - WINDOW + 1)
    return np.concatenate([left[:a], entropy_bins(around(b, seam)) if over is None else over, right[:c]])


def select(b: np.ndarray, ranks: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Where the selected windows begin."""
    n = len(bins)
    if n == 0:
        return np.zeros(0, np.int64)
    key = (ranks[bins] << 40) | np.arange(n)
    run = min(RUN, n)
    least, width = key, 1
    while width < run:  # minimum over ``run`` windows by doubling
        d = min(width, run - width)
        least = np.minimum(least[:-d], least[d:])
        width += d
    won = np.bincount(least & ((1 << 40) - 1), minlength=n)
    return np.flatnonzero(won >= min(WINS, won.max()))


def digest(text: str | bytes, ranks: np.ndarray, bins: np.ndarray | None = None) -> np.ndarray:
    """The chain of filters, one row of bytes each. ``bins``: those of the text's windows, if they are known."""
    raw = text.encode() if isinstance(text, str) else text
    b = np.frombuffer(raw, np.uint8)
    if not raw:
        return np.zeros((0, BITS // 8), np.uint8)
    if len(b) < WINDOW:
        h = np.array([int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")], np.uint64)
    else:
        at = select(b, ranks, entropy_bins(b) if bins is None else bins)
        h = np.empty(len(at), np.uint64)
        for i in range(0, len(at), HASHED):
            h[i:i + HASHED] = (b[at[i:i + HASHED, None] + _AHEAD].astype(np.uint64) + np.uint64(1)) @ _MULT
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        _, first = np.unique(h, return_index=True)  # a feature that comes again adds nothing
        h = h[np.sort(first)]
    filters = np.zeros((-(-len(h) // PER_FILTER), BITS), np.uint8)
    chain = np.arange(len(h)) // PER_FILTER
    for k in range(HASHES):
        filters[chain, ((h >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return np.packbits(filters, axis=1)


def as_text(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode()


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Mean over the shorter chain of the best normalised overlap in the longer."""
    if len(x) == 0 or len(y) == 0:
        return float(len(x) == len(y))
    if len(x) > len(y):
        x, y = y, x
    best = np.zeros(len(x))
    bx = np.unpackbits(x, axis=1).astype(np.float32)
    nx = bx.sum(1)
    for i in range(0, len(y), 256):
        by = np.unpackbits(y[i:i + 256], axis=1).astype(np.float32)
        ny = by.sum(1)
        both, least = bx @ by.T, np.minimum.outer(nx, ny)
        chance = np.minimum(np.outer(nx, ny) / BITS + 0.1 * least, least - 1)
        best = np.maximum(best, ((both - chance) / (least - chance)).clip(0, 1).max(1))
    return float(best.mean())


def fingerprint(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """doc_id, fingerprint of each text."""
    def make():
        def f(cols):
            return {"doc_id": cols["doc_id"], "fingerprint": [as_text(digest(t, ranks)) for t in cols["text"]]}

        return f

    return arrow_map(docs.select("doc_id", text_or_empty().alias("text")), "doc_id long, fingerprint string", make)


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """(part, halo, rank, doc_id, text), sorted in each part: the rows of a range of the order, then the row after it."""
    spark = docs.sparkSession
    d = docs.select("doc_id", text_or_empty().alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("rank"))
    chars = d.agg(F.sum(F.length("text")), F.count("*")).first()
    n = max(1, min(int(chars[0] or 0) // range_chars, int(chars[1])))
    n = max(n, min(int(chars[1]), spark.sparkContext.defaultParallelism))
    d = d.withColumn("hash", F.xxhash64("text"))
    cuts = d.agg(F.percentile_approx("rank", [i / n for i in range(1, n)], 10_000).alias("c")).first()["c"] if n > 1 else []
    times = Counter(cuts or [])
    # a rank that several cuts fall on is cut by the hash, which is even; its last cut is after all of it
    cuts = sorted((c, (k << 64) // m - (1 << 63) if k < m else (1 << 63) - 1) for c, m in times.items() for k in range(1, m + 1))
    part = F.lit(len(cuts))
    if cuts:  # ranges hold (cut, next cut]; part 0 has the largest ids. A lookup in a sorted literal, bounded by the number of ranges
        if max(times.values()) == 1:
            below = F.aggregate(F.array(*[F.lit(c) for c, _ in cuts]), F.lit(0), lambda a, c: a + (c < F.col("rank")).cast("int"))
        else:
            points = F.array(*[F.struct(F.lit(c).cast("long").alias("rank"), F.lit(h).cast("long").alias("hash")) for c, h in cuts])
            below = F.aggregate(points, F.lit(0), lambda a, c: a + ((c["rank"] < F.col("rank")) | ((c["rank"] == F.col("rank")) & (c["hash"] < F.col("hash")))).cast("int"))
        part = F.lit(len(cuts)) - below
    d = d.withColumn("part", part)
    firsts = sorted((r["part"], r["first"]["rank"], r["first"]["hash"]) for r in d.groupBy("part").agg(F.max(F.struct("rank", "hash")).alias("first")).collect())
    if not firsts:
        return d.select("part", F.lit(False).alias("halo"), "rank", "doc_id", "text")
    follows = spark.createDataFrame([(p, *firsts[(i + 1) % len(firsts)][1:]) for i, (p, *_) in enumerate(firsts)], "part int, rank long, hash long")
    halo = (d.drop("part").join(F.broadcast(follows), ["rank", "hash"]).groupBy("part", "rank").agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id"))
            .select("part", F.lit(True).alias("halo"), "rank", "doc_id", "text"))
    own = d.select("part", F.lit(False).alias("halo"), "rank", "doc_id", "text")
    return own.unionByName(halo).repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "halo", F.desc("rank"), F.desc(F.xxhash64("text")), "text")


def compare_edits(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Fingerprints of every text and its edited text, with their likeness and that of the next document."""
    out_type = T.StructType.fromDDL(OUT)

    def run(batches):
        arrow = to_arrow_schema(out_type)
        held = None  # the row before: its part, id, text, digest and bins

        def compared(group):
            """The rows of a group that have the next one by now, the row held first."""
            nonlocal held
            raws = [text.encode() for *_, text in group]
            pairs = []
            for (part, halo, doc, text), raw, bins in zip(group, raws, bins_of_all(raws)):
                if halo and (held is None or held[0] != part):
                    continue  # only the first row after the range counts
                now = (part, doc, text, digest(raw, ranks, bins), bins)
                if held is not None and held[0] == part:
                    pairs.append((held, now))
                held = None if halo else now
            halves = [(one[2], len(one[2]) // 2, after[2]) for one, after in pairs]
            stays = [text[:len(text) - half].encode() for text, half, _ in halves]
            edited = [a + after[:half].encode() for a, (_, half, after) in zip(stays, halves)]
            over = bins_of_all([around(raw, len(a)) for raw, a in zip(edited, stays)])
            for ((_, doc, text, own, bins), after), raw, a, mid in zip(pairs, edited, stays, over):
                changed = own if raw == text.encode() else digest(raw, ranks, joined_bins(raw, len(a), bins, after[4], mid))
                yield (doc, len(text), hashlib.sha256(raw).hexdigest(), as_text(own), as_text(changed), likeness(own, changed), likeness(own, after[3]))

        for b in batches:
            rows = [*zip(*(b.column(i).to_pylist() for i in range(4)))]
            for g in groups([len(text) for *_, text in rows]):
                if out := [*compared(rows[g])]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*out), arrow)], schema=arrow)

    spark = docs.sparkSession
    bound_batches(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return with_next(docs).select("part", "halo", "doc_id", "text").mapInArrow(run, OUT)
