"""Near-duplicate documents: a Jaccard join on word 5-grams by MinHash banding.

The n-grams of a text are runs of five of its lower-cased words; a text of one to
four words is one n-gram. Band and row counts follow from the threshold and the
recall asked for (``plan_bands``): the fewest bands of ``rows`` minima with which
a pair at the threshold shares a bucket with that probability. Documents meet by
shuffling on band hashes; candidate components are verified pair by pair on the
full n-gram sets. Equal texts are one member with many copies.

Per document: class_id, the least doc_id among those connected by similarity of
at least the threshold; n_links, how many different texts its text is similar to;
copies, documents with its very text; class_size, documents of its class; kept,
whether it is the class's first row by (doc_id, text hashes, place in the table read), one
row of each class; twin, whether it equals the kept row in doc_id and text. Null texts count as empty; empty texts, and texts
of white space alone, are similar to their copies only. A null doc_id is the
smallest of all. Rows that repeat doc_id and text are members of one class.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, arrow_map, cut, text_or_empty
from .near import bucket_edges, chunked, components, join_per_key, key_filter, may_hold, verify

WORDS, THRESHOLD, RECALL, ROWS = 5, 0.8, 0.995, 6
NULL_ID = -2**63


def plan_bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """The fewest bands with which a pair at the threshold is found with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHash(Remembered):
    """word -> 64-bit hash, remembering a bounded number."""

    def __init__(self):
        super().__init__(lambda word: xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace")))


def ngrams(text: str, hashes: WordHash, words: int = WORDS) -> np.ndarray:
    """The distinct n-gram hashes of a text, sorted."""
    w = text.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w))
    k = min(words, len(h))
    n = len(h) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:n + i]
    return np.unique(mix(out))


def signatures(sets: list[np.ndarray], seeds: np.ndarray) -> np.ndarray:
    """MinHash values, one row a set and one column a seed; sets are not empty."""
    out = np.empty((len(sets), len(seeds)), np.uint64)
    lens = np.array([len(s) for s in sets])
    k = 0
    while k < len(sets):  # a piece at a time, so that it stays in cache
        stop = max(k + 1, int(np.searchsorted(np.cumsum(lens[k:]), 30_000)) + k)
        items = np.concatenate(sets[k:stop])
        at = np.concatenate([[0], np.cumsum(lens[k:stop])[:-1]])
        for j, seed in enumerate(seeds):
            out[k:stop, j] = np.minimum.reduceat((items ^ (seed >> np.uint64(1))) * seed, at)
        k = stop
    return out


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket a band."""
    out = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sig), b + 1, np.uint64)
        for r in range(rows):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * rows + r])
        out[:, b] = h
    return out.view(np.int64)


def seeds(n: int) -> np.ndarray:
    return np.random.default_rng(7).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id (null: the smallest), text (null: empty) and its 128-bit key."""
    return (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), text_or_empty().alias("text"))
            .withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64(F.lit(1), "text")))


def classes(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, copies, class_size, kept, twin, and its text's key k1, k2."""
    bands = plan_bands(threshold, recall, rows)
    seed = seeds(bands * rows)
    d = keyed(docs)

    def sign():
        hashes = WordHash()

        def f(cols):
            sets = [ngrams(t, hashes, words) for t in cols["text"]]
            some = [i for i, s in enumerate(sets) if len(s)]
            got = [[] for _ in sets]
            if some:
                for i, b in zip(some, band_hashes(signatures([sets[i] for i in some], seed), bands, rows)):
                    got[i] = b
            return {"doc_id": cols["doc_id"], "k1": cols["k1"], "k2": cols["k2"], "n": [len(s) for s in sets], "bands": got}

        return f

    # the row number is written once, so it stays the same whoever reads it
    signed = cut(arrow_map(d, "doc_id long, k1 long, k2 long, n int, bands array<long>", sign).withColumn("row", F.monotonically_increasing_id()), "signed")
    total = signed.count()
    texts = cut(signed.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "row")).alias("lead"), F.count("*").alias("copies"), F.first("n").alias("n"))
                .select("k1", "k2", F.col("lead.doc_id").alias("first"), F.col("lead.row").alias("row"), "copies", "n", F.monotonically_increasing_id().alias("id")), "texts")
    # the candidate graph goes by k1 alone: two texts that share it by chance are merely candidates
    candidates = components(bucket_edges(signed.select(F.col("k1").alias("id"), "bands"), total * bands))
    block = cut(candidates.select(F.col("id").alias("k1"), F.col("root").alias("block")), "blocks")
    near_texts = cut(chunked(texts.join(block, "k1").select("id", "k1", "k2", "first", "n", "block")), "members")
    words_of_filter = key_filter(near_texts, "k1", near_texts.count())

    def thin():
        def f(cols):
            keep = np.flatnonzero(may_hold(words_of_filter, cols["k1"]))
            return {c: [cols[c][i] for i in keep] for c in ("doc_id", "k1", "k2", "text")}

        return f

    thinned = arrow_map(d, "doc_id long, k1 long, k2 long, text string", thin)
    fetched = thinned.join(near_texts.withColumnRenamed("first", "doc_id"), ["doc_id", "k1", "k2"])

    def items():
        hashes = WordHash()

        def f(cols):
            return {"id": cols["id"], "block": cols["block"], "chunks": cols["chunks"],
                    "items": [ngrams(t, hashes, words).view(np.int64) for t in cols["text"]]}

        return f

    sets = arrow_map(fetched.select("id", "block", "chunks", "text"), "id long, block long, chunks int, items array<long>", items)
    verified = cut(verify(sets, threshold).where("links > 0"), "verified")
    links = verified.groupBy("id").agg(F.sum("links").alias("n_links"))
    joined = components(verified.select(F.col("id").alias("a"), F.col("root").alias("b")))
    member = cut(texts.join(links, "id", "left").join(joined, "id", "left")
                 .select("k1", "k2", "first", "row", "copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         F.coalesce("root", "id").alias("root")), "member")
    per_class = cut(member.groupBy("root").agg(F.min(F.struct("first", "k1", "k2", "row")).alias("lead"), F.sum("copies").alias("class_size"), F.count("*").alias("texts")), "classes")
    at = F.col("lead")
    member = cut(join_per_key(member, per_class, ["root"], "texts", total)
                 .select("k1", "k2", "copies", "n_links", "class_size", at["first"].alias("class_id"), at["row"].alias("kept_row"),
                         ((at["k1"] == F.col("k1")) & (at["k2"] == F.col("k2"))).alias("kept_text"), F.col("copies").alias("many")), "member")
    out = join_per_key(signed.select("doc_id", "k1", "k2", "row"), member, ["k1", "k2"], "many", total)
    return out.select(F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), F.when(F.col("class_id") != NULL_ID, F.col("class_id")).alias("class_id"),
                      "n_links", "copies", "class_size", (F.col("row") == F.col("kept_row")).alias("kept"),
                      (F.col("kept_text") & (F.col("doc_id") == F.col("class_id")) & (F.col("row") != F.col("kept_row"))).alias("twin"), "k1", "k2")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of docs, all columns, for each class: the first, and any one of rows that equal it in doc_id and text."""
    gone = cut(classes(docs, **options).where("not kept").select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"),
                                                                  F.col("twin").alias("_twin")).distinct(), "gone")
    words = key_filter(gone, "_k1", gone.count())
    maybe = F.pandas_udf(lambda k: pd.Series(may_hold(words, k.to_numpy())), "boolean")
    text = text_or_empty()
    at = docs.withColumn("_gone", maybe(F.xxhash64(text)))  # only rows the small filter holds move to meet the list
    met = at.where("_gone").join(gone.hint("merge"), (F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)) == F.col("_id")) & (F.xxhash64(text) == F.col("_k1"))
                                 & (F.xxhash64(F.lit(1), text) == F.col("_k2")), "left")
    out = at.where("not _gone").select(*docs.columns).unionByName(met.where("_id is null").select(*docs.columns))
    if gone.where("_twin").isEmpty():
        return out
    return out.unionByName(met.where("_twin").dropDuplicates(["_id", "_k1", "_k2"]).select(*docs.columns))
