"""Byte-level BPE: encoding by a priority queue of merge ranks, decoding by vocabulary strings.

A pre-token becomes a doubly linked list of symbols. All adjacent pairs that
merge enter a heap as (rank, position, pair); popping the lowest rank joins
two symbols and pushes the two new pairs. An entry is stale when the symbols
at its position are no longer the pair it was pushed for; it is skipped.

Nulls encode as the empty text (no ids). Each row is independent, so repeated
rows and clashing extra columns change nothing, and an empty table gives none.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame

from .common import Remembered, arrow_map, text_or_empty

# The pre-token pattern of the vocabulary's byte-level pre-tokenizer.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Unicode White_Space, which is what \s means to that pre-tokenizer.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Runs of non-space with at most one space before them; white space as PRE_TOKEN cuts it.
#: Every pre-token lies in one chunk, so chunks can be encoded one by one and remembered.
CHUNK = f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


#: Bits of a heap entry that hold a position; the merge's rank is above them.
PLACE = 40
AT = (1 << PLACE) - 1
#: What a worker remembers of encoded chunks.
CACHE_BYTES = 96 << 20
#: What it remembers of counts alone, where no ids are held.
COUNT_BYTES = 192 << 20


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else the next of U+0100, U+0101, ..."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Chunks(Remembered):
    """What is known of a chunk, joined from what is known of its pre-tokens. A chunk of several is remembered
    when its pre-tokens were already: a rare word is remembered once, whatever stands next to it."""

    def __init__(self, pieces: Callable, of_piece: Callable, join: Callable, most_bytes: int):
        super().__init__(of_piece, most_bytes)
        self.pieces, self.join = pieces, join

    def __missing__(self, chunk: str):
        pieces = self.pieces(chunk)
        if len(pieces) == 1:
            return super().__missing__(chunk)
        known = all(map(self.__contains__, pieces))
        out = self.join(map(self.__getitem__, pieces))
        return self.remember(chunk, out) if known else out


class ByteBPE:
    """A vocabulary file of byte-level BPE; ``chunks`` maps a chunk of text to its ids, ``counts`` to how many they are."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        self.of_byte = [vocab[c] for c in alphabet]
        self.merge, self.made = {}, []
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            self.merge.setdefault((vocab[a], vocab[b]), rank << PLACE)
            self.made.append((vocab[a], vocab[b], vocab[a + b]))
        byte = {c: b for b, c in enumerate(alphabet)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.strings = [b""] * size
        for s, i in vocab.items():
            self.strings[i] = bytes(byte[c] for c in s) if all(c in byte for c in s) else s.encode()
        for s, i in self.special.items():
            self.strings[i] = s.encode()
        self.numerals = [str(i) for i in range(size)]
        self.find_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self._chunk, pieces = re.compile(CHUNK), regex.compile(PRE_TOKEN).findall
        self.chunks = Chunks(pieces, lambda p: tuple(self.merged(p.encode("utf-8", "replace"))), lambda ids: tuple(chain.from_iterable(ids)), CACHE_BYTES)
        self.counts = Chunks(pieces, lambda p: len(self.merged(p.encode("utf-8", "replace"))), sum, COUNT_BYTES)

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        sym = list(map(self.of_byte.__getitem__, piece))
        n, rank_of, made = len(sym), self.merge.get, self.made
        # an entry is the pair's rank, which tells the pair, then its position, in one number
        heap = [r + i for i, r in enumerate(map(rank_of, zip(sym, sym[1:]))) if r is not None]
        if not heap:
            return sym
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            e = pop(heap)
            i = e & AT
            a, b, whole = made[e >> PLACE]
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue  # stale: one of the two has been merged since
            sym[i], sym[j] = whole, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of((whole, sym[k]))) is not None:
                    push(heap, r + i)
            if (h := before[i]) >= 0 and (r := rank_of((sym[h], whole))) is not None:
                push(heap, r + h)
        return [s for s in sym if s >= 0]

    def encode(self, text: str) -> list[int]:
        out, at = [], 0
        for m in self.find_special.finditer(text):
            out += chain.from_iterable(map(self.chunks.__getitem__, self._chunk.findall(text[at:m.start()])))
            out.append(self.special[m[0]])
            at = m.end()
        out += chain.from_iterable(map(self.chunks.__getitem__, self._chunk.findall(text[at:] if at else text)))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load_bpe(path: str) -> ByteBPE:
    """The vocabulary. It stays in a worker with the chunks that it remembers, from one task to the next."""
    bpe = ByteBPE(path)
    bpe.chunks.update((s, (i,)) for s, i in bpe.special.items())  # as a piece of its own; no other chunk is such a string
    bpe.counts.update((s, 1) for s in bpe.special)
    return bpe


def encode_documents(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """doc_id, ids (array, left out if ``ids`` is false), n_tokens, ids_sha256, decoded_sha256 of each text."""
    schema = "doc_id long, " + "ids array<int>, " * ids + "n_tokens long, ids_sha256 string, decoded_sha256 string"

    def make():
        bpe = load_bpe(path)

        def f(cols):
            out = {k: [] for k in ("ids", "n_tokens", "ids_sha256", "decoded_sha256")}
            for text in cols["text"]:
                got = bpe.encode(text)
                out["n_tokens"].append(len(got))
                out["ids_sha256"].append(hashlib.sha256(",".join(map(bpe.numerals.__getitem__, got)).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(got).encode()).hexdigest())
                if ids:
                    out["ids"].append(got)
            return out | {"doc_id": cols["doc_id"]}

        return f

    return arrow_map(docs.select("doc_id", text_or_empty().alias("text")), schema, make)
