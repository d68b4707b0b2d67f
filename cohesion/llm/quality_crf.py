"""Document quality by a linear-chain conditional random field over lines.

Every line is good (1) or bad (0). Its features are shares of kinds of
characters, word statistics and repetition, those of the line before and after
it, and what the document's words repeat. Forward-backward gives each line's
probability of being good; a document's score is their mean, weighted by line
length. The field is trained by gradient ascent on a bounded sample of labelled
documents (``SAMPLE_DOCS`` a class; of each a stretch of at most ``SAMPLE_LINES`` neighbouring lines, from
its middle), every line carrying its document's label. Scoring reads whole texts.

Null texts count as empty: one empty line, scored as such. Without labels of
both classes the field is not trained and every score is the share of good
labels (0.5 if there are none). Labels that repeat a doc_id count as their
maximum, null labels not at all. Repeated documents score alike. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_or_empty

#: Labelled documents of each class, and lines of each of them, that training sees at most.
SAMPLE_DOCS, SAMPLE_LINES = 1500, 48
STEPS, RATE, L2 = 300, 0.5, 1e-3

LETTER_LOW, LETTER_UP, LETTER_OTHER, DIGIT, SPACE, POINT, SYMBOL = range(1, 8)


def char_kinds() -> np.ndarray:
    """The kind of every code point of the basic plane."""
    kinds = np.full(65536, SYMBOL, np.uint8)
    for c in range(65536):
        s = chr(c)
        if s.isspace():
            kinds[c] = SPACE
        elif s.isalpha():
            kinds[c] = LETTER_LOW if s.islower() else LETTER_UP if s.isupper() else LETTER_OTHER
        elif s.isdigit():
            kinds[c] = DIGIT
        elif s in ".,;:?!'\"()-–—’“”«»¿¡":
            kinds[c] = POINT
    return kinds


_KINDS: list[np.ndarray] = []
WIDTH = 11


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line with its neighbours', length of each line)."""
    if not _KINDS:
        _KINDS.append(char_kinds())
    lines = text.split("\n")
    n = len(lines)
    length = np.fromiter(map(len, lines), np.int64, n)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _KINDS[0][np.minimum(codes, 65535)]
    begin = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    base = np.zeros((n, WIDTH))
    safe = np.maximum(length, 1)
    for j, kind in enumerate((LETTER_LOW, LETTER_UP, DIGIT, POINT, SYMBOL)):
        run = np.concatenate([[0], np.cumsum(kinds == kind)])
        base[:, j] = (run[begin + length] - run[begin]) / safe
    seen: dict[str, int] = {}
    for i, line in enumerate(lines):
        words = line.split()
        if words:
            distinct = len(set(words))
            base[i, 5] = distinct / len(words)
            base[i, 6] = min(len(line) / len(words), 40) / 10
            base[i, 7] = sum(w in seen for w in (words[0], words[-1], words[len(words) // 2])) / 3
            base[i, 8] = min(seen.get(line, 0), 3) / 3
            base[i, 9] = 1.0 if line.rstrip()[-1:] in ".!?\"'”»" else 0.0
            seen.update(dict.fromkeys(words, 1))
            seen[line] = seen.get(line, 0) + 1
    base[:, 10] = np.log1p(length) / 8
    words = text.split()
    doc = np.array([len(set(words)) / len(words) if words else 0.0, math.log1p(len(words)) / 10])
    x = np.zeros((n, 3 * WIDTH + 3))
    x[:, :WIDTH] = base
    x[1:, WIDTH:2 * WIDTH] = base[:-1]
    x[:-1, 2 * WIDTH:3 * WIDTH] = base[1:]
    x[:, -3:-1] = doc
    x[:, -1] = 1
    return x, length


class LineField:
    """Emission weights (log-odds of good) and a 2x2 table of transition scores."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, mean: np.ndarray, scale: np.ndarray, prior: float | None = None):
        self.weights, self.moves, self.mean, self.scale, self.prior = weights, moves, mean, scale, prior

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """P(good) of each line by forward-backward, as log-odds of the messages."""
        e = (((x - self.mean) / self.scale) @ self.weights).tolist()
        (t00, t01), (t10, t11) = self.moves.tolist()
        n = len(e)
        fwd, back = [0.0] * n, [0.0] * n
        for i in range(n):
            fwd[i] = e[i] + (_log_ratio(fwd[i - 1], t11, t01, t10, t00) if i else 0.0)
        for i in range(n - 2, -1, -1):
            back[i] = _log_ratio(e[i + 1] + back[i + 1], t11, t10, t01, t00)
        z = np.clip(np.array(fwd) + np.array(back), -500, 500)
        return 1 / (1 + np.exp(-z))

    def score(self, text: str) -> float:
        if self.prior is not None:
            return self.prior
        x, length = line_features(text)
        p = self.marginals(x)
        w = length if length.sum() else np.ones(len(length))
        return float(min(1.0, max(0.0, (p * w).sum() / w.sum())))


def _log_ratio(z: float, a: float, b: float, c: float, d: float) -> float:
    """log((e^(z+a) + e^b) / (e^(z+c) + e^d)): a message through the transition table."""
    m = max(z, 0.0) + 0.0
    u, v = math.exp(z - m), math.exp(-m)
    return math.log((u * math.exp(a) + v * math.exp(b)) / (u * math.exp(c) + v * math.exp(d)))


def fit(lines: list[np.ndarray], labels: list[int], steps: int = STEPS) -> LineField:
    """Gradient ascent on the mean log-likelihood of the label sequences, all documents padded to one array."""
    n, longest, width = len(lines), max(map(len, lines)), lines[0].shape[1]
    everything = np.concatenate(lines)
    mean, scale = everything.mean(0), everything.std(0) + 1e-6
    mean[-1], scale[-1] = 0, 1
    x, on = np.zeros((n, longest, width)), np.zeros((n, longest), bool)
    for i, a in enumerate(lines):
        x[i, :len(a)], on[i, :len(a)] = (a - mean) / scale, True
    y = np.array(labels, float)[:, None] * on
    per_doc = 1.0 / on.sum(1, keepdims=True)
    share = np.array([max(1, (np.array(labels) == k).sum()) for k in (0, 1)])
    per_doc *= (n / (2 * share))[np.array(labels)][:, None]  # both classes weigh the same
    w, t = np.zeros(width), np.zeros((2, 2))
    pair = on[:, 1:]
    lab = np.array(labels)
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = (pair * per_doc)[lab == k].sum()
    for step in range(steps):
        e = np.stack([np.zeros((n, longest)), x @ w], -1)
        a, b = np.zeros_like(e), np.zeros_like(e)
        a[:, 0] = e[:, 0]
        for i in range(1, longest):
            a[:, i] = e[:, i] + np.logaddexp(a[:, i - 1, :1] + t[0], a[:, i - 1, 1:] + t[1])
        for i in range(longest - 2, -1, -1):
            nxt = e[:, i + 1] + b[:, i + 1]
            b[:, i] = np.where(pair[:, i:i + 1], np.logaddexp(t[:, 0] + nxt[:, :1], t[:, 1] + nxt[:, 1:]), 0)
        z = a + b
        p = 1 / (1 + np.exp(np.clip(z[..., 0] - z[..., 1], -500, 500)))
        joint = a[:, :-1, :, None] + t + (e + b)[:, 1:, None, :]
        joint -= joint.max((2, 3), keepdims=True)
        joint = np.exp(joint)
        joint /= joint.sum((2, 3), keepdims=True)
        gw = np.einsum("nl,nlw->w", (y - p) * on * per_doc, x) / n - L2 * w
        gt = (seen - np.einsum("nl,nlij->ij", pair * per_doc, joint)) / n - 0.05 * t
        r = RATE * (1 - step / steps)
        w += r * gw
        t += r * gt
    return LineField(w, t, mean, scale)


def bucket(doc_id):
    """crc32 of the id as text, mod 3; rows of bucket 1 are held out of training."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> LineField:
    """The field fitted to a bounded sample of the labelled documents that are not held out."""
    lab = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (bucket(F.col("doc_id")) != 1))
           .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")))
    sides = [lab.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs) for k in (0, 1)]
    chosen = [r for s in sides for r in s.collect()]  # at most 2 x sample_docs ids
    if len({r["quality"] for r in chosen}) < 2:
        share = sum(r["quality"] for r in chosen) / len(chosen) if chosen else 0.5
        return LineField(np.zeros(1), np.zeros((2, 2)), np.zeros(1), np.ones(1), prior=share)
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["quality"]) for r in chosen], "doc_id long, quality int")
    picked = (docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * sample_docs))

    def make():
        def f(cols):
            out = {"quality": cols["quality"], "x": [], "rows": []}
            for text in cols["text"]:
                x, _ = line_features(text)
                if len(x) > sample_lines:  # a stretch of neighbours from the middle of the whole text
                    s = (len(x) - sample_lines) // 2
                    x = x[s:s + sample_lines]
                out["rows"].append(len(x))
                out["x"].append(x.astype(np.float32).ravel().tolist())
            return out

        return f

    rows = arrow_map(picked.select("quality", "text"), "quality int, rows int, x array<float>", make).collect()
    if len({r["quality"] for r in rows}) < 2:
        share = sum(r["quality"] for r in rows) / len(rows) if rows else 0.5
        return LineField(np.zeros(1), np.zeros((2, 2)), np.zeros(1), np.ones(1), prior=share)
    return fit([np.array(r["x"]).reshape(r["rows"], -1) for r in rows], [r["quality"] for r in rows])


def score(docs: DataFrame, field: LineField) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    def make():
        def f(cols):
            s = [field.score(t) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "score": s, "predicted": [int(v >= 0.5) for v in s]}

        return f

    return arrow_map(docs.select("doc_id", F.coalesce(bucket(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), text_or_empty().alias("text")),
                     "doc_id long, held_out boolean, score double, predicted int", make)


def keep_good(docs: DataFrame, field: LineField) -> DataFrame:
    """The rows of docs, all columns, whose text the field does not reject."""
    good = F.pandas_udf(lambda s: s.map(field.score) >= 0.5, "boolean")
    return docs.where(good(text_or_empty()))
