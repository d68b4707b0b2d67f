"""Packing token sequences into windows: best-fit decreasing over a segment tree of capacities.

Documents longer than a window are first cut into full windows, which are
sequences of their own. The remainders are dealt evenly into groups of a
bounded number of pieces; in each group the longest piece comes first and goes
to the tightest open window that has room. The tree's leaves are the remaining
capacities 0..window; a node knows whether any open window below it exists, so
the tightest fit is one walk up and one down.

Null texts count as empty and still hold the closing id. Repeated rows are
packed once each; ties in length go by doc_id and start. An empty table packs
to no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import Remembered, arrow_map, cut, text_or_empty

WINDOW = 4096
#: Pieces packed together in one task. More pieces leave less padding; a group's last windows stay open.
GROUP_PIECES = 40_000
#: What a worker remembers of encoded words, from one task to the next.
CACHE_BYTES = 32 << 20


class BestFit:
    """Open windows by remaining capacity."""

    def __init__(self, window: int = WINDOW):
        self.window, self.size = window, 1 << window.bit_length()
        self.open = [0] * (2 * self.size)  # open windows below each node
        self.at = [[] for _ in range(window + 1)]  # their ids by capacity
        self.made = 0

    def _change(self, capacity: int, by: int) -> None:
        i = self.size + capacity
        while i:
            self.open[i] += by
            i >>= 1

    def tightest(self, need: int) -> int:
        """The least capacity >= need of an open window, or -1."""
        i = self.size + need
        if self.open[i]:
            return need
        while i > 1 and not (i % 2 == 0 and self.open[i + 1]):
            i >>= 1
        if i <= 1:
            return -1
        i += 1
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size

    def place(self, length: int) -> tuple[int, int]:
        """(window id, offset in it) for a piece of that length."""
        c = self.tightest(length)
        if c < 0:
            c, w = self.window, self.made
            self.made += 1
        else:
            w = self.at[c].pop()
            self._change(c, -1)
        if left := c - length:
            self.at[left].append(w)
            self._change(left, 1)
        return w, self.window - c


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


# The normalizer and pre-tokenizer of a vocabulary of lower-case words with ends, as its file says them.
WORDS_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORDS_CUT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Letters below this code point (Latin) stay as they are under NFC, and are lower-cased one by one.
LATIN = 0x250


def _of_letters(path: str) -> Callable[[str], list[int] | None]:
    """chunk -> its ids if it is Latin letters with a mark at most behind them, else None. With the rules above such a chunk is
    one piece and perhaps a second, so the merges alone decide, and the library's other steps are spared."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["normalizer"] != WORDS_NORMALIZER or spec["pre_tokenizer"] != WORDS_CUT:
        return lambda chunk: None
    tok, alphabet = _tokenizer(path), byte_alphabet()
    merged = tok.model.tokenize
    marks = {c: tok.encode(c, add_special_tokens=False).ids for c in ".,!?;:"}

    def ids(chunk: str) -> list[int] | None:
        mark = marks.get(chunk[-1])
        letters = chunk[:-1] if mark else chunk
        if not letters.isalpha():
            return None
        if letters.isascii():
            low = letters.lower()
        elif max(letters) < chr(LATIN) and (low := "".join(map(str.lower, letters))).isalpha():
            low = "".join(map(alphabet.__getitem__, low.encode()))
        else:
            return None
        return [t.id for t in merged(low)] + (mark or [])

    return ids


@lru_cache(maxsize=2)
def word_ids(path: str, remember: int = CACHE_BYTES) -> Remembered:
    """space-separated chunk -> its ids as little-endian bytes. The vocabulary's pre-tokenizer drops
    white space and never joins across it, so a text's ids are those of its chunks in order."""
    tok, quick = _tokenizer(path), _of_letters(path)

    def ids(chunk: str) -> bytes:
        got = quick(chunk) if chunk else []
        return np.array(tok.encode(chunk, add_special_tokens=False).ids if got is None else got, "<u4").tobytes()

    return Remembered(ids, remember)


def pieces(docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, remember: int = CACHE_BYTES) -> DataFrame:
    """Every document's pieces: full windows and the remainder, with CRC-32 of the ids."""
    def make():
        ids, end = word_ids(path, remember), end_id.to_bytes(4, "little")

        def f(cols):
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc, text in zip(cols["doc_id"], cols["text"]):
                buf = b"".join(map(ids.__getitem__, text.replace("\n", " ").split(" "))) + end
                n = len(buf) // 4
                for start in range(0, n, window):
                    part = buf[4 * start:4 * (start + window)]
                    for k, v in (("doc_id", doc), ("start", start), ("length", len(part) // 4), ("ids_crc32", zlib.crc32(part)), ("doc_tokens", n)):
                        out[k].append(v)
            return out

        return f

    return arrow_map(docs.select("doc_id", text_or_empty().alias("text")),
                     "doc_id long, start long, length long, ids_crc32 long, doc_tokens long", make)


def pack(docs: DataFrame, path: str, window: int = WINDOW, group_pieces: int = GROUP_PIECES, remember: int = CACHE_BYTES) -> DataFrame:
    """``remember``: bytes of encoded words that a worker keeps. pieces() with sequence_id and offset. Ids are unique over the table: even ones are full
    windows, odd ones hold the group and the window in it."""
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    made = cut(pieces(docs, path, window=window, remember=remember).withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = made.where(F.col("length") == window).select(*cols, (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = made.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group_pieces))

    def best_fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "row"], ascending=[False, True, True, True], kind="stable")
        fit = BestFit(window)
        put = [fit.place(n) for n in pdf["length"].tolist()]
        pdf["sequence_id"] = [(int(pdf["g"].iloc[0]) << 33) + 2 * w + 1 for w, _ in put]
        pdf["offset"] = [o for _, o in put]
        return pdf[[*cols, "sequence_id", "offset"]]

    dealt = rest.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return full.unionByName(dealt.groupBy("g").applyInPandas(best_fit, full.schema))
