"""Token counts that follow edits: a segment tree over each document's pre-token chunks.

The leaves are the chunks (see ``bpe.CHUNK``); every node sums the characters
and tokens below it. An edit descends by character offset to the leaves it
touches, widens them on both sides until an unchanged non-space character lies
between the edit and the border, encodes only that stretch again and updates
the sums above it. Chunk borders are decided by the characters next to them,
so beyond such a character the cut is the same as before. Special strings of the vocabulary are leaves of one token, as in encoding. As an
edit can make or break one, the character must lie further from the edit than such a string is long.

Offsets count code points of the text as it stands after the edits before it;
offsets past the end are clipped, null replacements delete. Null texts count as
empty; no or null edits leave the count as it is. Every row is independent: repeated rows give repeated rows, an empty table gives
none, and extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ByteBPE, load_bpe
from .common import arrow_map, text_or_empty

EDITS = "array<struct<start:bigint,length:bigint,replacement:string>>"


class CountTree:
    """Characters and tokens of one text, by segment tree."""

    def __init__(self, bpe: ByteBPE, text: str):
        self.bpe, self.reencoded = bpe, 0
        self.reach = max(map(len, bpe.special), default=1) - 1
        self.leaf = self.cut(text)
        self.size = 1 << (max(1, len(self.leaf)) - 1).bit_length()
        leaves = np.zeros((2, self.size), np.int64)
        leaves[0, :len(self.leaf)] = list(map(len, self.leaf))
        leaves[1, :len(self.leaf)] = list(map(bpe.counts.__getitem__, self.leaf))
        self.chars, self.tokens = self._levels(leaves)

    def cut(self, text: str) -> list[str]:
        chunks, out, at = self.bpe._chunk.findall, [], 0
        for m in self.bpe.find_special.finditer(text):
            out += chunks(text[at:m.start()])
            out.append(m[0])
            at = m.end()
        return out + chunks(text[at:] if at else text)

    def _levels(self, leaves: np.ndarray) -> list[list[int]]:
        out = np.zeros((2, 2 * self.size), np.int64)
        out[:, self.size:] = leaves
        at = self.size
        while at > 1:
            np.add(out[:, at:2 * at:2], out[:, at + 1:2 * at:2], out=out[:, at // 2:at])
            at //= 2
        return out.tolist()

    def leaf_at(self, offset: int) -> tuple[int, int]:
        """The leaf that holds the character at ``offset``, and where that leaf begins."""
        i, begin = 1, 0
        while i < self.size:
            i *= 2
            if offset - begin >= self.chars[i]:
                begin += self.chars[i]
                i += 1
        return i - self.size, begin

    def set(self, k: int, text: str) -> None:
        parts = self.cut(text)
        self.reencoded += len(parts)
        self._put(k, text, sum(map(self.bpe.counts.__getitem__, parts)))

    def _put(self, k: int, text: str, tokens: int) -> None:
        self.leaf[k] = text
        i = self.size + k
        dc, dt = len(text) - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += dc
            self.tokens[i] += dt
            i >>= 1

    def edit(self, start: int, length: int, replacement: str) -> None:
        total = self.chars[1]
        start = min(max(start, 0), total)
        end = min(start + max(length, 0), total)
        if not self.leaf:
            self.leaf = [""]
        if total:
            a, begin = self.leaf_at(min(start, total - 1))
            b, last = self.leaf_at(min(max(end - 1, start), total - 1))
            stop = last + self.chars[self.size + b]
        else:
            a = b = begin = stop = 0
        touched = "".join(self.leaf[a:b + 1])
        left = before = touched[:start - begin]
        tail = touched[len(touched) - (stop - end):] if stop > end else ""
        while a and not left[:max(0, len(left) - self.reach)].strip():
            a -= 1
            begin -= self.chars[self.size + a]
            left = self.leaf[a] + left
        right = ""
        while b + 1 < len(self.leaf) and not (tail + right)[self.reach:].strip():
            b += 1
            right += self.leaf[b]
        stretch = left[:len(left) - len(before)] + touched + right
        at = start - begin
        self.set(a, stretch[:at] + replacement + stretch[at + end - start:])
        for k in range(a + 1, b + 1):
            if self.leaf[k]:
                self._put(k, "", 0)

    def text(self) -> str:
        return "".join(self.leaf)


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """docs with column ``edits``: the rows of ``edits`` (doc_id, seq, start, length, replacement) in order of seq."""
    per_doc = edits.groupBy("doc_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("seq", "start", "length", "replacement"))),
        lambda e: F.struct(e["start"].cast("long").alias("start"), e["length"].cast("long").alias("length"), e["replacement"].alias("replacement"))).alias("edits"))
    return docs.select("doc_id", "text").join(per_doc, "doc_id", "left")


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens before, edited_tokens and edited_chars after the row's ``edits``, and how
    many chunks were encoded again for them."""
    def make():
        bpe = load_bpe(path)

        def f(cols):
            out = {k: [] for k in ("n_tokens", "edited_tokens", "edited_chars", "n_edits", "chunks", "reencoded")}
            for text, edits in zip(cols["text"], cols["edits"]):
                tree = CountTree(bpe, text)
                out["n_tokens"].append(tree.tokens[1])
                out["chunks"].append(len(tree.leaf))
                for e in edits or ():
                    tree.edit(e["start"] or 0, e["length"] or 0, e["replacement"] or "")
                out["n_edits"].append(len(edits or ()))
                out["edited_tokens"].append(tree.tokens[1])
                out["edited_chars"].append(tree.chars[1])
                out["reencoded"].append(tree.reencoded)
            return out | {"doc_id": cols["doc_id"]}

        return f

    return arrow_map(docs.select("doc_id", text_or_empty().alias("text"), F.col("edits").cast(EDITS).alias("edits")),
                     "doc_id long, n_tokens long, edited_tokens long, edited_chars long, n_edits int, chunks long, reencoded long", make)
