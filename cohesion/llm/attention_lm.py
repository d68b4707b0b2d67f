"""Scoring texts with a causal self-attention model of subword ids, trained in numpy on Spark's partitions.

A text is lower-cased (A-Z) and cut at white space into words; its score is the log10 probability of the words' subword ids and
of one end. The ids come from a public byte-level vocabulary, word by word, each with one space before it, so that ids and words
determine each other.

*Model.* Ids fall into ``CLASSES`` classes: the most frequent are classes of their own, the others share ``TAIL_CLASSES`` by
frequency, and p(id | class) follows the corpus counts. Causal self-attention over the last ``STEP`` to ``2 * STEP`` classes (queries, keys,
values and a weight for each distance) gives a context vector; with embeddings of the last three classes it goes through a
hidden layer to ``MIXTURE`` weights, and p(next class) is the mixture, by these weights, of as many tables p(next class | last class).
So every distribution sums to one without a softmax over the vocabulary.

*Windows.* A text is covered by overlapping windows of ``2 * STEP`` ids, one starting every ``STEP``; each window scores the ids
after its second half, so each id is scored once. All windows of a batch are one masked matrix product.

*Training.* All training texts are read once: in ``ROUNDS`` rounds, each over a share of them chosen by a hash of doc_id, every
task goes on from the common model with Adam on the weights and expected counts for the tables; weights are then averaged by
trained ids and counts summed, by a Spark aggregation whose size is that of the model. Id and pair counts cover all training texts.

*Base score.* Words are counted over all training texts. A chunk of texts (``CHUNK_WORDS``) keeps its distinct words once; these
meet their counts in one shuffle by word, in which a word has a row for each chunk, however often it occurs, and go back
by chunk, so neither a frequent word nor a large source makes a hot group.

Null texts count as empty: an end alone. A null doc_id is not held out. Rows that repeat are scored each and count each. Without
training texts all counts are zero and the model is uniform within its classes. An empty table gives no rows. Extra columns
are ignored. Bytes that are not UTF-8 are kept in words and read as U+FFFD by the tokenizer.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, cut, give_back

#: Fixed sizes of the model; nothing in it grows with the corpus.
CLASSES, TAIL_CLASSES, MIXTURE, WIDTH, HIDDEN, STEP = 512, 16, 8, 8, 8, 8
VOCABULARY, END = 50_257, 50_256
#: Of SHARES parts of the training texts, which each round reads: all of them once.
SHARES, ROUNDS = 8, ((0,), (1, 2), (3, 4, 5, 6, 7))
#: Training: windows in a step, learning rate, steps between new tables, what of the last round's counts stays.
BATCH, RATE, REFRESH, KEEP = 512, 0.01, 64, 0.3
#: Pseudo-counts: of the pooled pair table in each mixture table, of the round's first tables, of a class in a row, of an id.
POOLED, FIRST, ROW, ID = 30.0, 50.0, 5.0, 0.05
#: Words in a chunk (a longer text is a chunk by itself), distinct words in it, and bytes of a word encoded at once.
CHUNK_WORDS, CHUNK_DISTINCT, WORD_BYTES = 3_000_000, 500_000, 256
#: A chunk's number is its task's, then MADE bits for which of that task's; a word's place is its chunk's, then WORD bits for which of its
#: words. The chunk itself comes after its words. One long to sort by.
MADE, WORD = 12, 27
LAST = (1 << WORD) - 1
#: Words worked on at once, and distinct words encoded at once.
PART_WORDS, ENCODED = 200_000, 10_000
PAD = CLASSES
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def tokenizer(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def word_ids(encoding, word: bytes) -> list[int]:
    """The ids of a space and the word; a long word is encoded in parts, which bounds its time."""
    if len(word) <= WORD_BYTES:
        return encoding.encode_ordinary(" " + word.decode("utf-8", "replace"))
    text = " " + word.decode("utf-8", "replace")
    return [i for at in range(0, len(text), WORD_BYTES) for i in encoding.encode_ordinary(text[at:at + WORD_BYTES])]


def all_word_ids(encoding, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids of each word, all ids). Words are encoded many at a time: the vocabulary's pattern begins a piece at
    every space, unless other white space stands next to it; then they are encoded one by one."""
    opens = _opening(encoding)
    lens, ids = [], []
    for at in range(0, len(words), ENCODED):
        part = words[at:at + ENCODED]
        text = " " + b" ".join(part).decode("utf-8", "replace")
        got = None
        if max(map(len, part)) <= WORD_BYTES and not _OTHER_SPACE.search(text):
            got = np.array(encoding.encode_ordinary(text), np.uint16)
            begin = np.flatnonzero(opens[got])
            each = np.diff(np.append(begin, len(got)))
        if got is None or len(each) != len(part):
            single = [word_ids(encoding, w) for w in part]
            each, got = np.array([len(x) for x in single]), np.array([i for x in single for i in x], np.uint16)
        lens.append(each)
        ids.append(got)
    return (np.concatenate(lens), np.concatenate(ids)) if words else (np.zeros(0, int), np.zeros(0, np.uint16))


_OTHER_SPACE = re.compile(r"[^\S ]")


def _opening(encoding) -> np.ndarray:
    """Which ids begin with a space."""
    out = np.zeros(VOCABULARY, bool)
    out[[i for i in range(END) if encoding.decode_single_token_bytes(i)[:1] == b" "]] = True
    return out


# ---- chunks of texts

#: What a chunk holds: of each text its doc_id (0 if null), whether it has one, is held out, its words; the places of all words;
#: of each distinct word its count in training texts and its number of ids; those ids.
FIELDS = {"docs": np.int64, "known": np.uint8, "held": np.uint8, "sizes": np.int64, "words": np.int32, "n": np.int32, "lens": np.int32, "ids": np.uint16}


def pack(fields: dict) -> bytes:
    """The arrays of FIELDS as one value: their compressed sizes, then each with its own size."""
    raw = [np.asarray(fields[k]).astype(kind).tobytes() for k, kind in FIELDS.items()]
    parts = [pa.compress(r, "zstd", asbytes=True) for r in raw]
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(x for r, p in zip(raw, parts) for x in (len(r).to_bytes(8, "little"), p))


class Chunk:
    """Texts as places in a list of distinct words, and those words' ids."""

    def __init__(self, packed: bytes):
        at = 8 * len(FIELDS)
        for (k, kind), size in zip(FIELDS.items(), np.frombuffer(packed, np.int64, len(FIELDS)).tolist()):
            length = int.from_bytes(packed[at:at + 8], "little")
            setattr(self, k, np.frombuffer(pa.decompress(packed[at + 8:at + 8 + size], length, "zstd", asbytes=True), kind))
            at += 8 + size
        self.ends = np.cumsum(self.sizes)
        self.starts = np.concatenate([[0], np.cumsum(self.lens, dtype=np.int64)])[:-1]

    def parts(self) -> Iterator[slice]:
        """Runs of texts with about PART_WORDS words, or one longer text: what is worked on at once."""
        place = self.ends // PART_WORDS
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [len(place)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                yield slice(int(a), int(b))

    def stream(self, part: slice, of_id: np.ndarray, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The classes of a part's texts (those ``chosen``), each after STEP pads as END, its ids, END and pads up to
        a multiple of STEP; and where each begins."""
        sizes = self.sizes[part]
        words = self.words[self.ends[part.start] - sizes[0]:self.ends[part.stop - 1]]
        if chosen is not None:
            words, sizes = words[np.repeat(chosen, sizes)], sizes[chosen]
        lens = self.lens[words]
        total = np.concatenate([[0], np.cumsum(lens, dtype=np.int64)])
        bounds = total[np.concatenate([[0], np.cumsum(sizes)])]
        each = np.diff(bounds)  # ids of each text
        begin = np.concatenate([[0], np.cumsum(STEP + -(-(each + 2) // STEP) * STEP)])
        out = np.full(begin[-1], PAD, np.int16)
        source = np.arange(total[-1], dtype=np.int64)
        source += np.repeat(self.starts[words] - total[:-1], lens)
        to = np.arange(total[-1], dtype=np.int64)
        to += np.repeat(begin[:-1] + STEP + 1 - bounds[:-1], each)
        out[to] = of_id[self.ids[source]]
        out[begin[:-1] + STEP] = out[begin[:-1] + STEP + 1 + each] = of_id[END]
        return out, begin


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z in lower case, and how many each text has."""
    low = pc.ascii_lower(texts.view(pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()))  # a slice comes out whole
    lists = pc.ascii_split_whitespace(low.cast(pa.large_string()))
    words, offsets = lists.flatten().view(pa.large_binary()), lists.offsets.to_numpy()
    some = pc.not_equal(pc.binary_length(words), 0)  # there is nothing before white space that begins a text
    upto = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return words.filter(some), np.diff(upto[offsets - offsets[0]])


def windows(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows with something to score, 2 * STEP classes and the next one; and where they begin."""
    if len(stream) < 2 * STEP:
        return np.zeros((0, 2 * STEP + 1), np.int16), np.zeros(0, np.int64)
    padded = np.append(stream, np.int16(PAD))
    view = np.lib.stride_tricks.sliding_window_view(padded, 2 * STEP + 1)[::STEP]
    some = (view[:, STEP] != PAD) & (view[:, STEP + 1] != PAD)
    return view[some], np.flatnonzero(some) * STEP


def chunks(docs: DataFrame, path: str) -> DataFrame:
    """Rows of (place, word, n) for each distinct word of a chunk, n its count in training texts, and a row for each chunk."""
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    schema = pa.schema([("place", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("trained", pa.int64()), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, task, made = tokenizer(path), TaskContext.get().partitionId(), 0

        def close():
            place = ((task << MADE) + made) << WORD
            lens, ids = all_word_ids(encoding, every.to_numpy(zero_copy_only=False).tolist())
            words, sizes, docs, known, held = (np.concatenate(x) for x in zip(*texts))
            n = np.bincount(words[np.repeat(~held, sizes)], minlength=len(every))
            packed = pack({"docs": docs, "known": known, "held": held, "sizes": sizes, "words": words, "n": n, "lens": lens, "ids": ids})
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((place + LAST, None, None, int((~held).sum()), packed), schema)], schema=schema)
            at = 0
            while at < len(every):
                part = every.slice(at, 20_000).cast(pa.binary())
                k = np.arange(at, at + len(part))
                none = pa.nulls(len(part))
                yield pa.RecordBatch.from_arrays([pa.array(place + k), part, pa.array(n[k].astype(np.int64)), none.cast(pa.int64()), none.cast(pa.binary())], schema=schema)
                at += len(part)

        none = pa.array([], pa.large_binary())
        every, texts, size = none, [], 0
        for b in batches:
            words, sizes = split_words(b.column("text"))
            docs, known = b.column("doc_id").fill_null(0).to_numpy(), b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            held, ends, at = b.column("held").to_numpy(zero_copy_only=False), np.cumsum(sizes), 0
            while at < len(sizes):
                begin = ends[at] - sizes[at]
                # words are numbered as they first occur: those of the chunk so far come first
                coded = pa.concat_arrays([every, words.slice(begin)]).dictionary_encode()
                place, own = coded.indices.to_numpy()[len(every):], ends[at:] - begin
                distinct = np.maximum.accumulate(np.concatenate([[len(every)], place + 1]))[own]
                sized = size + own + np.arange(1, len(own) + 1)
                full = np.flatnonzero((sized >= CHUNK_WORDS) | (distinct >= CHUNK_DISTINCT))
                n = int(full[0]) + 1 if len(full) else len(own)
                some = slice(at, at + n)
                texts.append((place[:own[n - 1]].copy(), sizes[some], docs[some], known[some], held[some]))
                every, size, at = coded.dictionary.slice(0, distinct[n - 1]), sized[n - 1], at + n
                if len(full):
                    yield from close()
                    every, texts, size, made = none, [], 0, made + 1
        if texts:
            yield from close()
        every, texts, words, coded, place = none, [], None, None, None
        give_back()

    return rows.mapInArrow(run, "place long, word binary, n long, trained long, packed binary")


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk]]:
    for b in batches:
        for place, packed in zip(b.column("place"), b.column("packed")):
            yield place.as_py() >> WORD, Chunk(packed.as_py())
            give_back()


def _sums(df: DataFrame, run, width: int) -> tuple[np.ndarray, np.ndarray]:
    """What the tasks' (at, v0, v1, ...) sum to by ``at``: a fixed number of rows, whatever the corpus."""
    names = [f"v{i}" for i in range(width)]
    told = df.mapInArrow(run, "at int, " + ", ".join(f"{v} double" for v in names))
    got = told.groupBy("at").agg(*(F.sum(v).alias(v) for v in names)).toArrow()
    return got["at"].to_numpy().astype(np.int64), np.stack([got[v].to_numpy() for v in names], 1)


def _told(at: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(at), 20_000):
        v = values[i:i + 20_000]
        yield pa.RecordBatch.from_arrays([pa.array(at[i:i + 20_000].astype(np.int32)), *(pa.array(v[:, j].astype(np.float64)) for j in range(v.shape[1]))],
                                         names=["at", *(f"v{j}" for j in range(v.shape[1]))])


# ---- the model

_REL = np.arange(STEP, 2 * STEP)[:, None] - np.arange(2 * STEP)[None, :]
_SEEN = _REL >= 0  # the causal mask of a window's second half over all of it
_DISTANCE = np.where(_SEEN, _REL, 0)
_ALL = np.ones((MIXTURE, MIXTURE), np.float32)  # by which a row's sum comes in every column
SHAPES = {"query": (CLASSES + 1, WIDTH), "key": (CLASSES + 1, WIDTH), "value": (CLASSES + 1, WIDTH), "distance": (2 * STEP,), "context": (WIDTH, HIDDEN),
          "last0": (CLASSES + 1, HIDDEN), "last1": (CLASSES + 1, HIDDEN), "last2": (CLASSES + 1, HIDDEN), "out": (HIDDEN, MIXTURE), "own": (CLASSES + 1, MIXTURE)}


def new_weights() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(0)
    w = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in SHAPES.items()}
    w["distance"][:] = 0
    w["own"][:] = 0
    return w


def flatten(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k], at = flat[at:at + n].reshape(s), at + n
    return out


class Pass:
    """A batch of windows through the model, forward and back."""

    def __init__(self, w: dict[str, np.ndarray], tables: np.ndarray, win: np.ndarray):
        win = win.astype(np.intp)
        self.w, self.win = w, win
        self.keys, self.last = np.ascontiguousarray(win[:, :2 * STEP]), [np.ascontiguousarray(win[:, STEP - i:2 * STEP - i]).ravel() for i in range(3)]
        y = np.ascontiguousarray(win[:, STEP + 1:]).ravel()
        self.on = (self.last[0] != PAD) & (y != PAD)
        self.pair = self.last[0] * CLASSES
        self.pair += y
        self.pair *= self.on
        n = len(win)
        with_one = np.concatenate([w["value"], np.ones((CLASSES + 1, 1), np.float32)], 1)
        with_one[PAD] = 0  # pads weigh nothing
        self.q = w["query"].take(self.last[0], axis=0).reshape(n, STEP, WIDTH)
        self.k, self.v = w["key"].take(self.keys, axis=0), with_one.take(self.keys, axis=0)
        self.e = np.matmul(self.q, self.k.transpose(0, 2, 1))
        self.e *= WIDTH**-0.5
        np.clip(self.e, -30, 30, out=self.e)
        np.exp(self.e, out=self.e)
        self.e *= np.where(_SEEN, np.exp(w["distance"][_DISTANCE]), 0).astype(np.float32)
        sums = np.matmul(self.e, self.v).reshape(-1, WIDTH + 1)
        self.total = np.maximum(sums[:, WIDTH:], 1e-20)
        self.ctx = sums[:, :WIDTH] / self.total
        h = self.ctx @ w["context"]
        for x, name in zip(self.last, ("last0", "last1", "last2")):
            h += w[name].take(x, axis=0)
        self.hidden = np.maximum(h, 0, out=h)
        z = self.hidden @ w["out"]
        z += w["own"].take(self.last[0], axis=0)
        np.clip(z, -30, 30, out=z)
        np.exp(z, out=z)
        z /= z @ _ALL
        self.gate = z
        self.share = tables.take(self.pair, axis=0)
        self.share *= z
        self.p = self.share @ _ALL[:, 0]

    def gradients(self) -> dict[str, np.ndarray]:
        """Of the mean of -log p. ``share`` becomes each table's part in its target, or nothing where there is none."""
        w, n = self.w, len(self.win)
        on = self.on.astype(np.float32)[:, None]
        self.share *= on / self.p[:, None]
        dz = self.gate * on
        dz -= self.share
        dz *= np.float32(1 / max(1, self.on.sum()))
        dh = dz @ w["out"].T
        dh *= self.hidden > 0
        dctx = dh @ w["context"].T
        dctx /= self.total
        dsum = np.concatenate([dctx, (dctx * self.ctx) @ np.full((WIDTH, 1), -1, np.float32)], 1).reshape(n, STEP, WIDTH + 1)
        ds = np.matmul(dsum, self.v.transpose(0, 2, 1))
        ds *= self.e
        distance = np.bincount(_DISTANCE[_SEEN], ds.reshape(n, -1).sum(0).reshape(STEP, -1)[_SEEN], 2 * STEP).astype(np.float32)
        ds *= np.float32(WIDTH**-0.5)
        out = {"query": _by_class(self.last[0], np.matmul(ds, self.k).reshape(-1, WIDTH)),
               "key": _by_class(self.keys.ravel(), np.matmul(ds.transpose(0, 2, 1), self.q).reshape(-1, WIDTH)),
               "value": _by_class(self.keys.ravel(), np.matmul(self.e.transpose(0, 2, 1), dctx.reshape(n, STEP, WIDTH)).reshape(-1, WIDTH)),
               "distance": distance, "context": self.ctx.T @ dh,
               "last0": _by_class(self.last[0], dh), "last1": _by_class(self.last[1], dh), "last2": _by_class(self.last[2], dh),
               "out": self.hidden.T @ dz, "own": _by_class(self.last[0], dz)}
        for name in ("query", "key", "value", "last0", "own"):
            out[name][PAD] = 0
        return out


def _by_class(index: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The rows summed by class; two columns are added at once, as one complex number."""
    two = np.complex64 if rows.dtype == np.float32 else np.complex128
    out, rows = np.zeros((rows.shape[1] // 2, CLASSES + 1), two), rows.view(two)
    for column, values in zip(out, rows.T):
        np.add.at(column, index, values)
    return np.ascontiguousarray(out.T).view(np.float32 if two == np.complex64 else np.float64)


class Trainer:
    """Adam on the weights, expected counts for the tables, from a common model on."""

    def __init__(self, weights: dict[str, np.ndarray], tables: np.ndarray):
        self.flat = flatten(weights).copy()
        self.w = unflatten(self.flat)  # views
        self.mean, self.square = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.tables = tables
        self.first = FIRST * np.ascontiguousarray(tables.T).reshape(MIXTURE, CLASSES, CLASSES)
        self.counts = np.zeros((MIXTURE, CLASSES * CLASSES), np.float32)
        self.held, self.steps, self.ids = [], 0, 0

    def learn(self, win: np.ndarray) -> None:
        p = Pass(self.w, self.tables, win)
        self.steps += 1
        rate = RATE * min(1.0, self.steps / 20)
        g = flatten(p.gradients())
        self.mean += 0.1 * (g - self.mean)
        g *= g
        self.square += 0.01 * (g - self.square)
        self.flat -= (rate / (1 - 0.9**self.steps)) * self.mean / (np.sqrt(self.square / (1 - 0.99**self.steps)) + 1e-8)
        self.held.append((p.pair, np.ascontiguousarray(p.share.T)))
        self.ids += int(p.on.sum())
        if self.steps % REFRESH == 0 or self.steps in (4, 8, 16, 32):
            self.refresh()

    def refresh(self) -> None:
        if not self.held:
            return
        pair = np.concatenate([x for x, _ in self.held])
        share = np.concatenate([x for _, x in self.held], 1)
        self.held = []
        for m in range(MIXTURE):
            self.counts[m] += np.bincount(pair, share[m], CLASSES * CLASSES)
        rows = self.first + self.counts.reshape(self.first.shape)  # as mixed_tables, table by table
        rows /= rows.sum(2, keepdims=True)
        self.tables = np.ascontiguousarray(rows.reshape(MIXTURE, -1).T)


def mixed_tables(counts: np.ndarray, prior: np.ndarray, weight: float) -> np.ndarray:
    """p(next | last) of each table from counts and so many pseudo-counts of ``prior`` in each row."""
    rows = counts.reshape(CLASSES, CLASSES, -1)
    total = rows.sum(1, keepdims=True) + weight
    return ((rows + weight * prior.reshape(CLASSES, CLASSES, -1)) / total).reshape(CLASSES * CLASSES, MIXTURE).astype(np.float32)


class Model:
    def __init__(self, of_id: np.ndarray, within: np.ndarray, weights: dict[str, np.ndarray], tables: np.ndarray):
        self.of_id, self.within, self.weights, self.tables = of_id, within, weights, tables

    def score(self, chunk: Chunk) -> np.ndarray:
        """log10 probability of each text of a chunk."""
        out = np.zeros(len(chunk.sizes))
        for part in chunk.parts():
            stream, begin = chunk.stream(part, self.of_id)
            win, at = windows(stream)
            logs = np.zeros(len(win))
            for i in range(0, len(win), 2048):
                p = Pass(self.weights, self.tables, win[i:i + 2048])
                logs[i:i + 2048] = np.where(p.on, np.log10(p.p), 0).astype(np.float64).reshape(-1, STEP) @ np.ones(STEP)
            out[part] = np.bincount(np.searchsorted(begin, at, "right") - 1, logs, part.stop - part.start)
        word = np.bincount(np.repeat(np.arange(len(chunk.lens)), chunk.lens), self.within[chunk.ids], len(chunk.lens))
        return out + _per_text(word[chunk.words], chunk.ends) + self.within[END]


def _per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0.0], np.concatenate([[0.0], np.cumsum(values)])[ends]]))


def classes_of(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each id, log10 p(id | class)) from id counts of the training texts."""
    n = np.zeros(VOCABULARY)
    n[ids] = counts
    order = np.argsort(-n, kind="stable")
    order = np.concatenate([[END], order[order != END]])
    of_id = np.empty(VOCABULARY, np.int16)
    alone = CLASSES - TAIL_CLASSES
    of_id[order[:alone]] = np.arange(alone)
    rank = np.arange(VOCABULARY - alone)
    of_id[order[alone:]] = alone + np.minimum(TAIL_CLASSES - 1, (1.8 * np.log2(1 + rank / 64)).astype(int))
    total = np.bincount(of_id, n + ID, CLASSES)
    return of_id, np.log10((n + ID) / total[of_id])


def _share(docs: np.ndarray) -> np.ndarray:
    """Which of SHARES parts each text belongs to, by its id."""
    h = docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(40)) % np.uint64(SHARES)).astype(np.int64)


def train(stored: DataFrame) -> Model:
    """The model of the training texts in ``chunks`` as stored."""
    def count_ids(batches):
        n = np.zeros(VOCABULARY)
        for _, c in _chunk_rows(batches):
            n += np.bincount(c.ids, np.repeat(c.n, c.lens), VOCABULARY)
            n[END] += (c.held == 0).sum()
        at = np.flatnonzero(n)
        yield from _told(at, n[at][:, None])

    ids, n = _sums(stored, count_ids, 1)
    of_id, within = classes_of(ids, n[:, 0])

    def count_pairs(batches):
        n = np.zeros((CLASSES + 1) * (CLASSES + 1), np.int64)
        for _, c in _chunk_rows(batches):
            for part in c.parts():
                s = c.stream(part, of_id, c.held[part] == 0)[0].astype(np.int32)
                n += np.bincount(s[:-1] * (CLASSES + 1) + s[1:], minlength=len(n))
        n = n.reshape(CLASSES + 1, -1)[:CLASSES, :CLASSES].ravel()
        at = np.flatnonzero(n)
        yield from _told(at, n[at][:, None])

    at, n = _sums(stored, count_pairs, 1)
    pairs = np.zeros(CLASSES * CLASSES)
    pairs[at] = n[:, 0]
    pairs = pairs.reshape(CLASSES, CLASSES)
    single = (pairs.sum(0) + 0.5) / (pairs.sum() + 0.5 * CLASSES)
    pooled = ((pairs + ROW * single) / (pairs.sum(1, keepdims=True) + ROW)).reshape(-1, 1)
    noise = np.random.default_rng(1).gamma(4, 0.25, (1, CLASSES, MIXTURE))
    tables = pooled.reshape(CLASSES, CLASSES, 1) * noise
    tables = (tables / tables.sum(1, keepdims=True)).reshape(-1, MIXTURE).astype(np.float32)
    weights, counts = new_weights(), np.zeros((CLASSES * CLASSES, MIXTURE))
    size = -(-len(flatten(weights)) // MIXTURE) * MIXTURE
    for number, shares in enumerate(ROUNDS):
        def learn(batches, weights=weights, tables=tables, shares=shares, number=number):
            t = Trainer(weights, tables)
            for chunk, c in _chunk_rows(batches):
                chosen, rng = (c.held == 0) & np.isin(_share(c.docs), shares), np.random.default_rng([chunk, number])
                for part in c.parts():
                    win, _ = windows(c.stream(part, of_id, chosen[part])[0])
                    order = rng.permutation(len(win))
                    for i in range(0, len(win), BATCH):
                        t.learn(win[order[i:i + BATCH]])
            t.refresh()
            if t.ids:
                counts = np.rint(t.counts * 64) / 64  # short numbers compress well on the way
                at = np.flatnonzero(counts.any(0))
                yield from _told(at, counts[:, at].T)
                flat = np.resize(t.flat.astype(np.float64), size) * t.ids
                yield from _told(CLASSES * CLASSES + np.arange(size // MIXTURE + 1), np.concatenate([flat.reshape(-1, MIXTURE), np.full((1, MIXTURE), float(t.ids))]))
            del t
            give_back()

        at, v = _sums(stored, learn, MIXTURE)
        got = np.zeros((CLASSES * CLASSES + size // MIXTURE + 1, MIXTURE))
        got[at] = v
        if trained := got[-1, 0]:
            weights = unflatten((got[CLASSES * CLASSES:-1].ravel() / trained).astype(np.float32))
            counts = KEEP * counts + got[:CLASSES * CLASSES]
            tables = mixed_tables(counts, np.repeat(pooled, MIXTURE, 1), POOLED)
    return Model(of_id, within, weights, tables)


# ---- base score and report

RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double, fresh long"


def _scores(batches: Iterator[pa.RecordBatch], model: Model, end_count: int) -> Iterator[pa.RecordBatch]:
    """Of each chunk first its words' counts, then its texts."""
    counts, fresh = [], 0
    for b in batches:
        at = 0
        for i in [*np.flatnonzero(b.column("c").is_null().to_numpy(zero_copy_only=False)), b.num_rows]:
            own = b.slice(at, int(i) - at)
            c = own.column("c").to_numpy()
            counts.append(c >> 1)
            fresh += int((c & 1).sum())
            at = int(i) + 1
            if at > b.num_rows:
                break
            chunk = Chunk(b.column("packed")[int(i)].as_py())
            c = np.concatenate(counts)
            logs, known = np.log10(c + 1.0), (c > 0).astype(np.float64)
            m = len(chunk.sizes)
            yield pa.RecordBatch.from_arrays([
                pa.array(chunk.docs, mask=chunk.known == 0), pa.array(chunk.held == 1), pa.array(chunk.sizes + 1),
                pa.array(np.rint(_per_text(known[chunk.words], chunk.ends)).astype(np.int64) + (end_count > 0)),
                pa.array(_per_text(logs[chunk.words], chunk.ends) + np.log10(end_count + 1.0)), pa.array(model.score(chunk)),
                pa.array(np.concatenate([[fresh], np.zeros(m - 1, np.int64)]).astype(np.int64))], names=[x.split()[0] for x in RESULT.split(", ")])
            counts, fresh, chunk, c = [], 0, None, None
            give_back()


def score_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document. ``path``: a vocabulary of byte ranks."""
    bound_batches(docs.sparkSession)
    stored = cut(chunks(docs, path), "chunks")
    whole = stored.where("word is null").select("place", "packed")
    model = train(whole)
    n_chunks, trained, tasks = stored.where("word is null").agg(F.count("*"), F.coalesce(F.sum("trained"), F.lit(0)), F.coalesce(F.max(F.shiftright("place", MADE + WORD)) + 1, F.lit(1))).first()
    by_word = Window.partitionBy("word")
    n, place = F.sum("n").over(by_word), F.col("place")
    # a word's count, doubled, and one more in the first of the chunks that have it, so that it is counted once as a distinct word
    counted = stored.where("word is not null").select("place", "word", "n").select(
        "place", (n * 2 + F.when((n > 0) & (F.min("place").over(by_word) == place), 1).otherwise(0)).alias("c"))
    meet = counted.withColumn("packed", F.lit(None).cast("binary")).unionByName(whole.withColumn("c", F.lit(None).cast("long")))
    # chunks are dealt evenly: those of a task one after the other
    parts, each = max(1, n_chunks), -(-n_chunks // tasks)
    slot = F.shiftright(place, MADE + WORD) * each + F.shiftright(place, WORD).bitwiseAND(F.lit((1 << MADE) - 1))
    dealt = meet.repartitionById(parts, F.pmod(slot, F.lit(parts)).cast("int")).sortWithinPartitions("place")
    scored = cut(dealt.mapInArrow(lambda batches: _scores(batches, model, trained), RESULT), "scores")
    train_tokens, fresh = scored.agg(F.coalesce(F.sum(F.when(~F.col("held_out"), F.col("n_tokens"))), F.lit(0)), F.coalesce(F.sum("fresh"), F.lit(0))).first()
    distinct = fresh + (trained > 0)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
                         (F.col("log_counts") - F.col("n_tokens") * F.lit(float(np.log10(train_tokens + distinct + 1)))).alias("base_score"), "score")
