"""The attention model against finite differences, plain loops and held-out texts; the base score against plain counts."""
import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from cohesion.llm import attention_lm as lm

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def small_model(seed=3):
    rng = np.random.default_rng(seed)
    of_id, within = lm.classes_of(np.arange(2000), rng.integers(1, 500, 2000))
    w = {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float32) for k, v in lm.new_weights().items()}
    tables = rng.random((lm.CLASSES, lm.CLASSES, lm.MIXTURE)) + 0.01
    tables = (tables / tables.sum(1, keepdims=True)).reshape(-1, lm.MIXTURE).astype(np.float32)
    return lm.Model(of_id, within, w, tables)


def plain_probability(m, classes, t):
    """p(every next class) after classes[:t + 1], with the attention of its window alone."""
    w = m.weights
    begin = max(0, t // lm.STEP * lm.STEP - lm.STEP)
    last = classes[t]
    weight, total, ctx = [], 0.0, np.zeros(lm.WIDTH)
    for s in range(begin, t + 1):
        e = math.exp(float(w["query"][last] @ w["key"][classes[s]]) / math.sqrt(lm.WIDTH) + float(w["distance"][t - s]))
        total += e
        ctx += e * w["value"][classes[s]]
    h = ctx / total @ w["context"]
    for i in range(3):
        h = h + w[f"last{i}"][classes[t - i] if t - i >= 0 else lm.PAD]
    z = np.maximum(h, 0) @ w["out"] + w["own"][last]
    g = np.exp(z - z.max())
    return m.tables.reshape(lm.CLASSES, lm.CLASSES, -1)[last] @ (g / g.sum())


def chunk_of(encoding, texts):
    places, lens, ids, words = {}, [], [], []
    for t in texts:
        own = t.translate(lm.LOWER).split()
        for x in own:
            if x not in places:
                got = lm.word_ids(encoding, x)
                places[x] = len(places)
                lens.append(len(got))
                ids += got
        words.append([places[x] for x in own])
    row = {"docs": np.arange(len(texts)), "known": np.ones(len(texts)), "held": np.zeros(len(texts)), "sizes": [len(x) for x in words], "words": sum(words, []), "n": np.ones(len(lens)), "lens": lens, "ids": ids}
    return lm.Chunk(lm.pack(row))


def test_scores_equal_plain_loops(monkeypatch):
    monkeypatch.setattr(lm, "PART_WORDS", 20)
    m, encoding = small_model(), lm.tokenizer(PATH)
    rng = random.Random(4)
    texts = [b"", b"one", b"A b C d e f g", b" ".join(rng.choice((b"the", b"of", b"Word", "é日".encode(), b"\xff\xfe", b"x" * 700)) for _ in range(90)), b"\x1c \xc2\xa0 a\xc2\xa0 b", b"", b"seven more words than that one had"]
    got = m.score(chunk_of(encoding, texts))
    for text, score in zip(texts, got):
        ids = [lm.END] + [i for x in text.translate(lm.LOWER).split() for i in lm.word_ids(encoding, x)] + [lm.END]
        classes = [int(m.of_id[i]) for i in ids]
        want = sum(math.log10(plain_probability(m, classes, t)[classes[t + 1]]) + m.within[ids[t + 1]] for t in range(len(ids) - 1))
        assert score == pytest.approx(want, rel=1e-4)


def test_every_distribution_sums_to_one():
    m = small_model()
    assert np.bincount(m.of_id, 10.0**m.within, lm.CLASSES) == pytest.approx(np.ones(lm.CLASSES))
    rng = np.random.default_rng(0)
    classes = rng.integers(0, lm.CLASSES, 40)
    for t in (0, 7, 8, 39):
        assert plain_probability(m, classes, t).sum() == pytest.approx(1, abs=1e-4)


def test_each_id_is_scored_once_and_sees_no_later_one():
    m = small_model()
    rng = np.random.default_rng(1)
    stream = np.full(64, lm.PAD, np.int16)
    stream[8:50] = rng.integers(0, lm.CLASSES, 42)
    win, at = lm.windows(stream)
    p = lm.Pass(m.weights, m.tables, win)
    assert p.on.sum() == 41
    later = stream.copy()
    later[40:50] = rng.integers(0, lm.CLASSES, 10)
    q = lm.Pass(m.weights, m.tables, lm.windows(later)[0])
    scored = (at[:, None] + np.arange(lm.STEP) + lm.STEP + 1).ravel()
    assert np.array_equal(p.p[p.on & (scored < 40)], q.p[q.on & (scored < 40)])


def test_gradients_equal_differences():
    m = small_model()
    rng = np.random.default_rng(2)
    win = rng.integers(0, 40, (6, 2 * lm.STEP + 1)).astype(np.int16)
    win[0, :9] = lm.PAD
    win[1, 12:] = lm.PAD

    def loss(w):
        p = lm.Pass(w, m.tables.astype(np.float64), win)
        return -np.log(p.p[p.on]).mean()

    exact = {k: v.astype(np.float64) for k, v in m.weights.items()}
    g = lm.Pass(exact, m.tables.astype(np.float64), win).gradients()
    for k, v in exact.items():
        for _ in range(6):
            i = tuple(rng.integers(0, min(n, 40)) for n in v.shape)
            step = 1e-3
            up, down = ({**exact, k: v.copy()} for _ in range(2))
            up[k][i] += step
            down[k][i] -= step
            assert g[k][i] == pytest.approx((loss(up) - loss(down)) / (2 * step), abs=2e-4), k


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    parts = ["ka", "lo", "mi", "tur", "ension", "ther", "ing", "ou"]
    vocab = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(5000)]
    out = [(i, " ".join((w.title() if rng.random() < 0.2 else w) for w in rng.choices(vocab, k=rng.randint(1, 300)))) for i in range(400)]
    return out + [(400, None), (401, ""), (402, " \n\t\x0b\x0c\r "), (403, "a\x1cb c d \x85"), (404, "x" * 30_000), (405, "kalo"), (405, "kalo"), (None, "kalo lo"), (None, None),
                  (406, "İ É ÀB ab"), (407, "long " * 60_000), (408, "only here 日本"), (409, "<|endoftext|> x")]


def test_base_scores_equal_plain_counts(spark, make_docs, rows, monkeypatch):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]  # noqa: E731  None: the end
    counts = collections.Counter(w for i, t in rows if not held(i) for w in words(t))
    total, distinct = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, t in rows:
        own = words(t)
        want[i, held(i), len(own), sum(counts[w] > 0 for w in own), total, round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own), 3)] += 1
    monkeypatch.setattr(lm, "CHUNK_WORDS", 3000)  # many chunks
    got = lm.score_documents(make_docs(rows), PATH).collect()
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    by_text = {}
    texts = dict(rows)
    for r in got:
        if r.doc_id is not None:
            assert by_text.setdefault(tuple(words(texts[r.doc_id])), r.score) == pytest.approx(r.score, rel=1e-6)


def test_learns_from_the_context(spark, make_docs):
    """Four sources whose words follow each other differently: held-out texts score above what the last class alone can tell."""
    rng = random.Random(9)
    common = ["time", "house", "water", "light", "paper", "table", "green", "seven", "music", "river", "stone", "bread"]
    orders = [rng.sample(range(12), 12) for _ in range(4)]

    def text(order):
        at, out = rng.randrange(12), []
        for _ in range(120):
            at = order[at] if rng.random() < 0.9 else rng.randrange(12)
            out.append(common[at])
        return " ".join(out)

    texts = [(i, text(orders[i % 4])) for i in range(12000)]
    got = {r.doc_id: r for r in lm.score_documents(make_docs(texts), PATH).collect()}
    words = [(held(i), t.split()) for i, t in texts]
    pairs = collections.Counter(p for out, w in words if not out for p in zip(w, w[1:]))
    firsts = collections.Counter(x for out, w in words if not out for x in w[:-1])
    of_pairs = sum(math.log10(pairs[p] / firsts[p[0]]) for out, w in words if out for p in zip(w, w[1:]))
    outs = [r for r in got.values() if r.held_out]
    assert len(outs) > 1200
    assert sum(r.score for r in outs) > 0.8 * of_pairs > sum(r.base_score for r in outs)


def test_many_words_encode_as_one_by_one():
    encoding = lm.tokenizer(PATH)
    words = [b"a", b"'s", "é".encode(), b"x" * 999, b"it's", "日本語".encode(), b"12", b"...", b"\xff", b"\xe6", b"q"]
    for some in (words, words[:3], [*words, "\xa0".encode(), "a\xa0".encode(), "\xa0".encode()], [b"\x1c", b"b"], []):
        lens, ids = lm.all_word_ids(encoding, some)
        assert [ids[e - n:e].tolist() for n, e in zip(lens, np.cumsum(lens))] == [lm.word_ids(encoding, w) for w in some]


def test_words_of_many_texts_are_split_at_once():
    texts = [b"", b" ", b"  A b\x1cC\x0b\x0cd\r\n e ", b"\xff\xfe Z\x85 q\xa0r", "İ É ÀB ab".encode(), b"\t", b"x" * 999, b"a\x00b \x1f c"]
    for some in (slice(0, 8), slice(2, 5), slice(0, 2), slice(0, 0)):
        words, sizes = lm.split_words(pa.array(texts, pa.binary())[some])
        want = [t.translate(lm.LOWER).split() for t in texts[some]]
        assert (words.to_pylist(), sizes.tolist()) == ([x for t in want for x in t], [len(t) for t in want])


def test_rows_are_summed_by_class():
    rng = np.random.default_rng(5)
    index = rng.integers(0, 9, 300) * 57
    for kind in (np.float32, np.float64):
        rows = rng.normal(0, 1, (300, 8)).astype(kind)
        got = lm._by_class(index, rows)
        assert got.dtype == kind and got.shape == (lm.CLASSES + 1, 8)
        assert got == pytest.approx(np.stack([rows[index == c].sum(0) for c in range(lm.CLASSES + 1)]), abs=1e-4)


def test_targets_that_are_none_count_nothing():
    m = small_model()
    win = np.full((4, 2 * lm.STEP + 1), lm.PAD, np.int16)
    win[:2] = 3
    p = lm.Pass(m.weights, m.tables, win)
    p.gradients()
    assert p.share.sum() == pytest.approx(p.on.sum()) and not p.share[~p.on].any()


def test_empty_table_and_no_training_texts(spark, make_docs):
    assert lm.score_documents(make_docs([]), PATH).collect() == []
    out = next(i for i in range(100) if held(i))
    (r,) = lm.score_documents(make_docs([(out, "A b")]), PATH).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and r.score < 0
