"""Each operator against a brute-force version, and on nulls, empty and long texts, repeated rows and empty tables."""
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohesion.llm import bpe, fingerprints, fuzzy_lines, html_template, licenses, near, ngram_join, packing, quality_crf, stream_dedup, token_edits

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SYLLABLES = "ka lo mi tu re sa no vi pe da gu fo".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    """Documents with copies, near copies, nulls, empty texts, a very long text, repeated rows and a null id."""
    rng = random.Random(3)
    out = []
    for i in range(0, 60):
        w = words(rng, rng.randint(30, 90))
        out.append((i, " ".join(w[:20]) + "\n" + " ".join(w[20:])))
    for i in range(60, 75):
        w = out[i % 7][1].split(" ")
        w[rng.randrange(len(w))] = "changed"
        out.append((i, " ".join(w)))
    out += [(i, out[3][1].upper() if i % 2 else out[3][1]) for i in range(75, 85)]
    out += [(85, None), (86, ""), (87, " \n\n "), (88, "one"), (89, " ".join(words(rng, 30_000))), (90, "Ünï 日本 <|endoftext|> \x1c 😀"), (90, "other"), (3, out[3][1]), (3, out[3][1]), (None, "no id here at all"), (None, None)]
    return out


def test_bpe_equals_the_library(spark, make_docs, rows):
    tok = Tokenizer.from_file(BYTE)
    got = collections.Counter(tuple(r) for r in bpe.encode_documents(make_docs(rows), BYTE, ids=False).collect())
    want = collections.Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert got == want
    assert bpe.encode_documents(make_docs([]), BYTE).collect() == []


def test_a_rare_word_is_merged_once_whatever_stands_beside_it():
    tok, b, merged = Tokenizer.from_file(BYTE), bpe.ByteBPE(BYTE), []
    plain = b.merged
    b.merged = lambda piece: merged.append(piece) or plain(piece)
    text = "say qwyzxk, qwyzxk. (qwyzxk) qwyzxk! it's qwyzxk's qwyzxk?"
    assert token_edits.CountTree(b, text).tokens[1] == len(tok.encode(text, add_special_tokens=False).ids)
    assert merged.count(b" qwyzxk") == 1 and len(merged) == len(set(merged))
    merged.clear()
    assert b.encode(text) == tok.encode(text, add_special_tokens=False).ids
    assert merged.count(b" qwyzxk") == 1 and len(merged) == len(set(merged))


def test_edits_keep_the_count(rows):
    tok = Tokenizer.from_file(BYTE)
    tok.encode_special_tokens = True
    rng, b = random.Random(1), bpe.load_bpe(BYTE)
    alphabet = [*" \n\t\x1c\x85aAbé'sT12²!.日😀", "  ", "\n\n", "'ll", " the"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        tree = token_edits.CountTree(b, text)
        for _ in range(6):
            at, n, new = rng.randint(0, len(text) + 2), rng.randint(0, 6), "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 5)))
            tree.edit(at, n, new)
            at = min(at, len(text))
            text = text[:at] + new + text[at + n:]
            assert (tree.text(), tree.chars[1], tree.tokens[1]) == (text, len(text), len(tok.encode(text, add_special_tokens=False).ids))


def test_edits_around_special_strings_count_as_encoding_does(rows):
    tok = Tokenizer.from_file(BYTE)
    rng, b = random.Random(8), bpe.load_bpe(BYTE)
    special = "<|endoftext|>"
    alphabet = [special, special, special[:5], special[5:], special[:-1], ">", "<", "|", " ", "  ", "\n", "a", "word", "é"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        tree = token_edits.CountTree(b, text)
        assert tree.tokens[1] == len(tok.encode(text, add_special_tokens=False).ids) == len(b.encode(text))
        for _ in range(6):
            at, n, new = rng.randint(0, len(text) + 2), rng.randint(0, 9), "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 3)))
            tree.edit(at, n, new)
            at = min(at, len(text))
            text = text[:at] + new + text[at + n:]
            assert (tree.text(), tree.tokens[1]) == (text, len(tok.encode(text, add_special_tokens=False).ids))


def test_edit_counts_over_a_table(spark, make_docs, rows):
    edits = spark.createDataFrame([(0, 1, 5, 3, "new words"), (0, 2, 0, 0, "x "), (88, 1, 0, 99, None), (None, 1, 0, 1, "n")], "doc_id long, seq int, start long, length long, replacement string")
    got = {(r.doc_id, r.n_edits): r for r in token_edits.count_tokens(token_edits.with_edits(make_docs(rows), edits), BYTE).collect()}
    text = rows[0][1]
    text = "x " + text[:5] + "new words" + text[8:]
    assert got[(0, 2)].edited_tokens == len(bpe.load_bpe(BYTE).encode(text)) and got[(0, 2)].edited_chars == len(text)
    assert got[(88, 1)].edited_tokens == 0 and got[(85, 0)].n_tokens == 0


def test_words_of_letters_encode_as_the_library_does(tmp_path):
    import json

    tok, quick, rng = Tokenizer.from_file(WORD), packing._of_letters(WORD), random.Random(4)
    latin = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    other = ["Σ", "ς", "日", "ﬁ", "é", "Å", "'", "1", "_"]
    known = 0
    for _ in range(20_000):
        w = "".join(rng.choice(latin if rng.random() < 0.95 else other) for _ in range(rng.randint(1, 9))) + rng.choice(["", "", ".", ",", "!?", "'s"])
        got = quick(w)
        known += got is not None
        assert got is None or got == tok.encode(w, add_special_tokens=False).ids, w
    assert known > 10_000 and quick(".") is None
    spec = json.loads(open(WORD, encoding="utf-8").read())
    spec["normalizer"]["normalizers"].pop()  # other rules: the library alone
    (tmp_path / "other.json").write_text(json.dumps(spec), encoding="utf-8")
    assert packing._of_letters(str(tmp_path / "other.json"))("word") is None


def test_packing_holds_every_id_once(spark, make_docs, rows):
    tok = Tokenizer.from_file(WORD)
    ids = collections.Counter()
    for i, t in rows:
        ids[(i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [2]))] += 1
    got = packing.pack(make_docs(rows), WORD, group_pieces=40).collect()
    by_doc = collections.defaultdict(list)
    for (i, seq), n in ids.items():
        by_doc[i] += [np.array(seq, np.uint32)] * n
    assert sum(r.length for r in got) == sum(len(s) * n for (_, s), n in ids.items())
    for r in got:
        assert any(len(s) == r.doc_tokens and zlib.crc32(s[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for s in by_doc[r.doc_id])
    seqs = collections.defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 4096
    assert packing.pack(make_docs([]), WORD).collect() == []


def test_best_fit_takes_the_tightest_window():
    rng, fit, open_ = random.Random(5), packing.BestFit(100), {}
    for n in sorted((rng.randint(1, 100) for _ in range(500)), reverse=True):
        room = [c for c in open_.values() if c >= n]
        w, at = fit.place(n)
        assert at == (100 - min(room) if room else 0)
        open_[w] = open_.get(w, 100) - n


def test_stream_dedup(spark, make_docs, rows, tmp_path):
    path = str(tmp_path / "documents")
    make_docs(rows).repartition(3).write.parquet(path)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(low)].append(i)
    top = lambda g: max((i for i in g if i is not None), default=None)
    want = collections.Counter((i, top(g), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    got = stream_dedup.dedup_report(spark, path).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    kept = stream_dedup.keep_first(make_docs(rows))
    assert kept.count() == len(groups) and kept.columns == make_docs(rows).columns


def test_stream_state_goes_on_from_its_checkpoint(spark, make_docs, tmp_path):
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "state")
    make_docs([(1, "a"), (2, "b")]).write.parquet(path)
    assert sorted(r.n for r in stream_dedup.stream_state(spark, path, checkpoint).collect()) == [1, 1]
    make_docs([(3, "A")]).write.mode("append").parquet(path)
    assert sorted((r.n, r.keep.id) for r in stream_dedup.stream_state(spark, path, checkpoint).collect()) == [(1, 2), (2, 3)]


def grams(t):
    w = (t or "").lower().split()
    k = min(5, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def roots(sets, threshold):
    """Components and link counts by comparing every pair."""
    root, links = list(range(len(sets))), [0] * len(sets)
    for i, a in enumerate(sets):
        for j in range(i):
            if a and len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return root, links


def test_ngram_join(spark, make_docs, rows):
    texts = sorted({t or "" for _, t in rows})
    root, links = roots([grams(t) for t in texts], 0.8)
    at = {t: k for k, t in enumerate(texts)}
    members = collections.defaultdict(list)
    for i, t in rows:
        members[root[at[t or ""]]].append(-1 if i is None else i)
    want = collections.Counter((i, min(members[root[at[t or ""]]]), links[at[t or ""]], len(members[root[at[t or ""]]])) for i, t in rows)
    got = ngram_join.classes(make_docs(rows)).collect()
    assert collections.Counter((r.doc_id, -1 if r.class_id is None else r.class_id, r.n_links, r.class_size) for r in got) == want
    assert any(n for _, _, n, _ in want)
    kept = ngram_join.keep_one(make_docs([(i, t) for i, t in rows if i not in (None, 3, 90)]))
    left = [(i, t) for i, t in rows if i not in (None, 3, 90)]
    r2, _ = roots([grams(t) for t in texts], 0.8)
    assert kept.count() == len({r2[at[t or ""]] for _, t in left})
    assert ngram_join.classes(make_docs([])).collect() == []


def test_verification_in_chunks_finds_the_same(spark, monkeypatch):
    monkeypatch.setattr(near, "CHUNK", 60)
    rng = random.Random(2)
    base = list(range(40))
    sets = [sorted({*rng.sample(base, 37), 100 + i}) for i in range(12)]
    members = spark.createDataFrame([(i, len(s), 0) for i, s in enumerate(sets)], "id long, n int, block long")
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "id long, items array<long>")
    got = near.verify(near.chunked(members).join(items, "id"), 0.8).groupBy("id").sum("links").collect()
    _, links = roots([frozenset(s) for s in sets], 0.8)
    assert {i: n for i, n in got if n} == {i: n for i, n in enumerate(links) if n} and any(links)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i + 1, i) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(30)]
    got = {r.id: r.root for r in near.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {x: r for x, r in label.items() if any(x in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize("part", (7, 400_000))
def test_bucket_edges_leave_a_batch_as_one_row_a_part(spark, monkeypatch, part):
    monkeypatch.setattr(near, "PART", part)
    rng = random.Random(8)
    hashes = [-2**63, 2**63 - 1, 0, -1, *(rng.randrange(-2**63, 2**63) for _ in range(60))]
    given = [(rng.randrange(-50, 50) * 10**16, [rng.choice(hashes) for _ in range(rng.randint(0, 3))]) for _ in range(80)] + [(-1, []), (5 * 10**17, [0, 0])]
    got = near.bucket_edges(spark.createDataFrame(given, "id long, bands array<long>").repartition(3), 250)
    want, least = collections.defaultdict(set), {}
    for i, bands in given:
        for x in bands:
            least[x] = min(i, least.get(x, i))
    for i, bands in given:
        for x in bands:
            want[i].add(least[x])
    pairs = [(r.a, r.b) for r in got.collect()]
    assert all(a > b for a, b in pairs)
    root = {r.id: r.root for r in near.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    plain = [(i, x) for i, xs in want.items() for x in xs if i != x]
    assert root == {r.id: r.root for r in near.components(spark.createDataFrame(plain, "a long, b long")).collect()}
    assert near.bucket_edges(spark.createDataFrame([(1, [])], "id long, bands array<long>"), 0).collect() == []


def test_fuzzy_lines(spark, make_docs, rows):
    rows = [r for r in rows if r[0] not in (None, 89)]
    occurrences = collections.defaultdict(set)
    key = {t: ngram_join.keyed(make_docs([(0, t)])).first().k1 for t in {t for _, t in rows if _ in (90,)}}
    for i, t in rows:
        for k, s in fuzzy_lines.prepared(t or ""):
            occurrences[s].add((i, key.get(t, 0), k, t))
    lines = sorted(occurrences)
    sets = [frozenset(s[j:j + 8] for j in range(len(s) - 7)) or frozenset([s]) for s in lines]
    root, _ = roots(sets, 0.8)
    groups = collections.defaultdict(list)
    for s, r in zip(lines, root):
        groups[r] += occurrences[s]
    gone = collections.defaultdict(set)
    for g in groups.values():
        for i, _, k, t in sorted(g, key=lambda x: x[:3])[1:]:
            gone[(i, t)].add(k)
    want = collections.Counter((i, "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone[(i, t)])) for i, t in rows)
    assert collections.Counter((r.doc_id, r.text) for r in fuzzy_lines.drop_lines(make_docs(rows)).collect()) == want


def test_lines_of_their_own_are_no_rows(spark, make_docs, monkeypatch):
    rng, tables, plain = random.Random(12), [], fuzzy_lines.cut
    own = [["".join(rng.choice("abcdefghijkl ") for _ in range(40)) + "x" for _ in range(30)] for _ in range(20)]
    docs = [(100 - i, "\n".join([*x[:15], " The common line of all texts ", "", *x[15:], "the common line of all texts"])) for i, x in enumerate(own)]
    docs += [docs[0], docs[19], (None, docs[3][1]), (None, None)]
    monkeypatch.setattr(fuzzy_lines, "cut", lambda df, kind: tables.append(out := plain(df, kind)) or out)
    monkeypatch.setattr(fuzzy_lines, "MEET", 50, raising=False)  # many parts
    got = collections.Counter((r.doc_id, r.n_lines, r.n_kept, r.text) for r in fuzzy_lines.drop_lines(make_docs(docs).repartition(3)).collect())
    bare = lambda x: "\n".join([*x[:15], "", *x[15:]])
    want = collections.Counter({(100 - i, 33, 31, bare(x)): 1 for i, x in enumerate(own)} | {(100, 33, 31, bare(own[0])): 2, (81, 33, 31, bare(own[19])): 2, (None, 1, 1, ""): 1})
    # the null id is the least: its lines stay, but for the second common one; the row with that text loses all
    want[(None, 33, 32, "\n".join(docs[3][1].split("\n")[:-1]))] += 1
    del want[(97, 33, 31, bare(own[3]))]
    want[(97, 33, 1, "")] += 1
    assert got == want
    assert max(t.count() for t in tables) < 120  # 660 lines, of which 72 are copies


def test_first_occurrences_of_lines():
    rng = random.Random(2)
    rows = [(rng.randrange(-9, 9), rng.randrange(2), *(rng.randrange(3) for _ in range(3)), 5) for _ in range(300)]
    first, later = fuzzy_lines.combine(np.array(rows, fuzzy_lines.LINE))
    least = {}
    for r in rows:
        least[r[:2]] = min(r, least.get(r[:2], r))
    assert sorted(first.tolist()) == sorted(least.values())
    assert sorted(later.tolist()) == sorted(r for r in rows if r != least[r[:2]])
    assert [len(x) for x in fuzzy_lines.combine(np.empty(0, fuzzy_lines.LINE))] == [0, 0]


def test_fingerprints(spark, make_docs):
    rng = random.Random(6)
    docs = [(i, " ".join(words(rng, n))) for i, n in ((1, 300), (5, 250), (2, 400), (9, 3), (4, 900))] + [(7, None), (8, "")]
    ranks = fingerprints.rarity_ranks(fingerprints.entropy_counts(make_docs(docs)))
    got = {r.doc_id: r for r in fingerprints.compare_edits(make_docs(docs), ranks).collect()}
    order = sorted(docs, reverse=True)
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest() and got[i].n_chars == len(t)
    assert got[4].near_edited > 0.2 > got[4].near_next and got[7].near_next == 0.0 and got[8].near_next == 1.0
    same = fingerprints.fingerprint(make_docs([(1, docs[0][1]), (2, docs[0][1])]), ranks).collect()
    assert same[0].fingerprint == same[1].fingerprint
    assert fingerprints.compare_edits(make_docs([]), ranks).collect() == []


def test_a_few_sets_are_compared_as_many_are(monkeypatch):
    rng = random.Random(5)
    cases = []
    for _ in range(300):
        base = [rng.randrange(10**9) for _ in range(rng.randint(3, 14))]
        sets = [np.unique([x if rng.random() < 0.93 else rng.randrange(10**9) for x in base]) for _ in range(rng.randint(2, near.FEW))]
        cases.append((np.array(rng.sample(range(1000), len(sets))), np.array([rng.randint(0, 1) for _ in sets]), sets, 0.8, rng.random() < 0.5))
    few = [near.similar(*c) for c in cases]
    assert any(links.any() for links, _ in few)
    monkeypatch.setattr(near, "FEW", 0)
    for c, got in zip(cases, few):
        for x, y in zip(got, near.similar(*c)):
            assert np.array_equal(x, y)


def test_line_keys_are_each_lines_key():
    lines = ["a", "日本 😀", "x" * 300, "one line, and more"]
    assert [*zip(*(k.tolist() for k in fuzzy_lines.line_keys(lines)))] == [fuzzy_lines.line_key(x) for x in lines]
    assert [len(k) for k in fuzzy_lines.line_keys([])] == [0, 0]


def test_window_entropy():
    b = np.frombuffer(bytes(random.Random(8).choices(b"abcdef ", k=300)), np.uint8)
    for i, got in enumerate(fingerprints.entropy_bins(b)):
        want = int(fingerprints._F[np.bincount(b[i:i + 64], minlength=256)].sum()) >> 4
        assert got == want


def test_bins_of_many_texts_are_found_at_once(monkeypatch):
    rng, calls, plain = random.Random(6), [], fingerprints.entropy_bins
    raws = [bytes(rng.choice(b"abcd \xc3") for _ in range(n)) for n in [0, 1, 63, 64, 65, 0, 300, *(rng.randint(0, 400) for _ in range(200)), 70_000]]
    monkeypatch.setattr(fingerprints, "entropy_bins", lambda b: calls.append(len(b)) or plain(b))
    got = fingerprints.bins_of_all(raws)
    assert calls == [sum(map(len, raws))]
    for r, bins in zip(raws, got):
        assert np.array_equal(bins, plain(np.frombuffer(r, np.uint8))) and len(bins) == max(0, len(r) - 63)
    sizes = [*map(len, raws)]
    assert [r for g in fingerprints.groups(sizes) for r in raws[g]] == raws and fingerprints.groups([]) == []
    monkeypatch.setattr(fingerprints, "BLOCK", 7)
    assert all(np.array_equal(bins, plain(np.frombuffer(r, np.uint8))) for r, bins in zip(raws[:50], got))


def test_quality(spark, make_docs):
    rng = random.Random(9)
    good = [(i, "\n".join(" ".join(words(rng, 25)).capitalize() + "." for _ in range(4))) for i in range(120)]
    bad = [(i, "\n".join(" ".join(w.upper() + "!!" for w in words(rng, 25)) for _ in range(4))) for i in range(120, 200)]
    rows = good + bad + [(900, None), (901, ""), (902, "x" * 200_000)]
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(200)] + [(900, None), (None, 1), (5, 1)], "doc_id long, quality int")
    field = quality_crf.train(make_docs(rows), labels)
    got = {r.doc_id: r for r in quality_crf.score(make_docs(rows), field).collect()}
    held = [r for i, r in got.items() if i < 200 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert sum(r.predicted == (r.doc_id < 120) for r in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in got.values())
    assert quality_crf.keep_good(make_docs(rows), field).where("doc_id < 120").count() == 120
    assert {r.score for r in quality_crf.score(make_docs(rows), quality_crf.train(make_docs(rows), labels.where("quality = 1"))).collect()} == {1.0}


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    x, w, moves = rng.normal(size=(5, 3)), rng.normal(size=3), rng.normal(size=(2, 2))
    field = quality_crf.LineField(w, moves, np.zeros(3), np.ones(3))
    total, good = 0.0, np.zeros(5)
    for k in range(32):
        y = [k >> i & 1 for i in range(5)]
        p = np.exp(sum(e * v for e, v in zip(x @ w, y)) + sum(moves[a, b] for a, b in zip(y, y[1:])))
        total += p
        good += p * np.array(y)
    assert np.allclose(field.marginals(x), good / total)


def test_licenses(spark, make_docs):
    rng = random.Random(1)
    filler = lambda n: " ".join(words(rng, n))
    mit = licenses.NOTICES["MIT-text"]
    broken = " ".join(w for k, w in enumerate(mit.split()) if k % 12)
    rows = [(1, f"{filler(50)}\n{licenses.NOTICES['MIT']}\n{filler(3000)}\n{licenses.NOTICES['MIT']}"), (2, filler(100)), (3, f"{filler(9)} {broken} {filler(9)}"), (4, None), (5, ""),
            (6, licenses.NOTICES["Apache-2.0-header"])]
    got = {r.doc_id: r for r in licenses.scan_documents(make_docs(rows)).collect()}
    assert got[1].license == "MIT" and len(got[1].hits) == 2
    assert got[3].license == "MIT-text" and 0.85 < got[3].coverage < 1 and got[6].license == "Apache-2.0-header"
    assert [got[i].license for i in (2, 4, 5)] == [None] * 3


def test_patience_is_a_longest_increasing_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        v = [rng.randrange(12) for _ in range(rng.randint(0, 9))]
        got = licenses.increasing(v)
        best = max((bin(m).count("1") for m in range(1 << len(v)) if all(a < b for a, b in zip(*(lambda s: (s, s[1:]))([x for i, x in enumerate(v) if m >> i & 1])))), default=0)
        assert len(got) == best and [v[i] for i in got] == sorted({v[i] for i in got})


PAGE = """<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li>Home</ul></nav><div class="promo-x">{extra}</div><div id="strip">Same on every page</div>
<article><h1>{title}</h1><p>First&nbsp;&amp; <b>bold</b>
line<p>Second<br>part<div class="newsletter">Join us</div><script>var a="</p>"</script><section class="comments"><p>Nice!</p></section></article><footer>&copy;</footer></body></html>"""


def test_bins_of_joined_texts_equal_their_own():
    rng = random.Random(31)
    for _ in range(200):
        x, y = ("".join(rng.choice("abcdé日 \n") * rng.randint(1, 4) for _ in range(rng.randint(0, 90))) for _ in range(2))
        cut = rng.randint(0, len(x))
        raw = np.frombuffer((x[:cut] + y).encode(), np.uint8)
        if len(raw) >= fingerprints.WINDOW:
            bins = [fingerprints.entropy_bins(np.frombuffer(t.encode(), np.uint8)) for t in (x, y)]
            got = fingerprints.joined_bins(raw, len(x[:cut].encode()), *bins)
            assert np.array_equal(got, fingerprints.entropy_bins(raw))


def test_license_copies_with_foreign_blocks(spark, make_docs):
    """All words in order with a block of others in the middle: the whole alignment counts."""
    rng = random.Random(21)
    rows, want = [], []
    for name in ("MIT-text", "GPL-3.0-header", "Apache-2.0-header", "BSD-3-Clause", "ISC-text"):
        w = licenses.NOTICES[name].split()
        size = len(licenses.words_of(licenses.NOTICES[name]))
        for n in (0, 30, 50, 90, 120):
            if n <= min(licenses.GAP, licenses.GAP_SIZES * size):
                # not inside the identity, whose words must stand together
                at = next(k for k in range(len(w) // 2, len(w)) if not any(licenses.plain(x) in " ".join(licenses.IDENTITY.get(name, ())) for x in licenses.words_of(" ".join(w[k - 1:k + 1]))))
                rows.append((len(rows), " ".join(words(rng, 40) + w[:at] + words(rng, n) + w[at:] + words(rng, 40))))
                want.append(name)
    got = {r.doc_id: r for r in licenses.scan_documents(make_docs(rows)).collect()}
    for (i, _), name in zip(rows, want):
        assert (got[i].license, got[i].coverage) == (name, 1.0), (i, name, got[i])
    far = [(0, " ".join((w := licenses.NOTICES["MIT-text"].split())[:60] + words(rng, 1000) + w[60:]))]
    assert licenses.scan_documents(make_docs(far)).first().license is None
    assert licenses.scan_documents(make_docs(far), gap=None).first().coverage == 1.0
    assert licenses.scan_documents(make_docs([])).collect() == []


def test_html(spark):
    pages = [(i, f"https://a.example/{i}", PAGE.format(title=f"T{i}", extra=f"e{i}")) for i in range(12)]
    bare = [(100 + i, f"https://b.example/{i}", f"<body><div><p>Shared strip</p></div><p>Own text {i}</p></body>") for i in range(8)]
    odd = [(200, None, None), (201, "http://[", "<p>x"), (202, "https://c.example", ""), (0, "https://a.example/0", pages[0][2])]
    df = spark.createDataFrame([(*r, "x") for r in pages + bare + odd], "page_id long, url string, html string, host string")
    got = collections.defaultdict(list)
    for r in html_template.main_text(df).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert got[0] == ["T0\nFirst & bold line\nSecond part"] * 2 and got[5] == ["T5\nFirst & bold line\nSecond part"]
    assert got[103] == ["Own text 3"] and got[200] == [""] and got[201] == ["x"] and got[202] == [""]
    assert html_template.main_text(df.limit(0)).collect() == []


def test_marks_do_not_drop_wrappers_or_text():
    """A word of a class or id alone drops no wrapper of the article and no text in it."""
    get = lambda source: "\n".join(html_template.blocks(html_template.parse(source)))
    inner = '<section id="related-work"><h2 id="search">Search</h2><p class="notice">Real</p></section>'
    for page in ('<body class="single has-sidebar"><article><p>A{}</article>', '<body><div id="page" class="no-banner"><main><p>A{}</main></div>',
                 '<body><article class="post has-comments"><p>A{}</article>', '<form id="f"><article><p>A{}</article></form>',
                 '<body><div class="no-banner"><p>A{}</div>'):
        assert get(page.format(inner)) == "A\nSearch\nReal"
    assert get('<body><div class="menu">Home</div><div id="left-sidebar">Side</div><p>The text of the page</p></body>') == "The text of the page"


def test_host_counts_decide_in_and_outside_the_article(spark):
    """Unmarked furniture, also a notice inside the articles, goes because it recurs; a passage that articles share in other places stays."""
    def page(i):
        own = [f"<p>Own {i} {k}</p>" for k in range(4 + i % 3)]
        own.insert(i % 4, "<p>A proverb</p>")
        return f"<body><div>Strip</div><article><h1>T{i}</h1>{''.join(own)}<p>Subscribe to our letter</p></article><div><p>Outside {i}</p></div></body>"

    bare = lambda i: f"<body><div><span>Top</span></div><h2>Summary</h2><p>Own {i}</p><h3>More</h3><ul><li>Home<li>Away</ul></body>"
    rows = [(i, f"https://a.example/{i}", page(i)) for i in range(8)] + [(20 + i, f"https://b.example/{i}", bare(i)) for i in range(8)] + [(40, "https://c.example/", page(1))]
    got = {r.page_id: r.text.split("\n") for r in html_template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        own = [f"Own {i} {k}" for k in range(4 + i % 3)]
        own.insert(i % 4, "A proverb")
        assert got[i] == [f"T{i}", *own]  # the article: text beside it is none of its own, whatever the host's size
        assert got[20 + i] == ["Summary", f"Own {i}"]
    assert got[40][-1] == "Subscribe to our letter"  # one page of its host: the article as it stands


def test_one_rule_for_hosts_of_any_size(spark):
    """The same pages on hosts of 4 and of 60: equal texts. A sentence that a third of the articles share stays, comments go."""
    def page(i):
        shared = "<p>The common sentence</p>" if i % 3 == 0 else ""
        own = "".join(f"<p>Own {i} {k} of the article</p>" for k in range(3 + i % 4))
        inside = f'<section class="comments"><p>user{i}: I agree {i}</p></section>'
        listed = f'<div id="x"><h3>2 comments</h3><ol><li><b class="author">By {i}</b><p>First {i}</p></li><li><b class="author">By {i + 1}</b><p>Second {i}</p></li></ol></div>'
        return f"<body><nav>Menu</nav><article><h1>T{i}</h1>{own}{shared}{inside if i % 2 else listed}</article><div class=meta>By user {i}</div><div id=reader>Reader {i} wrote</div></body>"

    rows = [(i, f"https://small.example/{i}", page(i)) for i in range(4)] + [(100 + i, f"https://large.example/{i}", page(i)) for i in range(60)]
    got = {r.page_id: r.text.split("\n") for r in html_template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(60):
        want = [f"T{i}", *(f"Own {i} {k} of the article" for k in range(3 + i % 4))] + ["The common sentence"] * (i % 3 == 0)
        assert got[100 + i] == want
        if i < 4:
            assert got[i] == want


def test_comments_are_told_by_mark_or_shape():
    get = lambda inner: "\n".join(html_template.blocks(html_template.parse(f"<body><article><p>The text of it all</p>{inner}</article></body>")))
    for gone in ('<div class="comment-list"><div><time>1</time>Nice</div></div>', '<section id="respond"><p>Say something</p></section>', '<ul class="Comments"><li>One<li>Two</ul>',
                 '<div><h2>3 Responses</h2><div class="c"><span class="user">A</span>x</div><div class="c"><span class="user">B</span>y</div></div>',
                 '<section><h4>Reader comments</h4><div><time>now</time><p>Hm</p></div></section>'):
        assert get(gone) == "The text of it all", gone
    for kept in ('<section class="text"><h2>Comments on the law</h2><p>It is long</p></section>', '<p class="comment">A remark</p>', '<section id="related-work"><p>Earlier work</p></section>',
                 '<div><h2>Authors</h2><div><span class="author">A</span>x</div></div>'):
        assert get(kept) != "The text of it all", kept
    first = '<body><article><div class="comments"><p>A comment before all text</p></div><p>Text</p></article></body>'
    assert "Text" in html_template.blocks(html_template.parse(first))


def test_host_counts_equal_plain_counts(spark):
    """How many pages of a host have a subtree, against counting trees as strings."""
    rng = random.Random(12)
    part = lambda: rng.choice(["<div>Strip</div>", "<div class=x><b>Two</b> words</div>", "<section><div>In</div></section>", "<div>Rare</div>"])
    rows = [(i, f"https://{rng.choice('ab')}.example/{i}", f"<body>{''.join(part() for _ in range(rng.randint(0, 4)))}<article><p>Own {i}</p></article></body>") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen = {(r.host, h) for r in html_template.page_subtrees(pages.selectExpr("cast(page_id as string) key", "parse_url(url, 'HOST') host", "html").selectExpr("cast(key as binary) key", "host", "html")).collect() for h in r.hash}
    got = collections.Counter()
    for _, url, source in rows:
        host = html_template.host_of(url)
        root = html_template.parse(source)
        for h in set(html_template.candidates(root, host).values()):
            assert (host, h) in seen
            got[h] += 1
    want = collections.Counter()
    for _, url, source in rows:
        body = source[6:source.index("<article>")]
        for piece in {p for p in ("<div>Strip</div>", "<div class=x><b>Two</b> words</div>", "<section><div>In</div></section>", "<div>In</div>", "<div>Rare</div>") if p in body}:
            want[html_template.host_of(url), piece] += 1
    assert sorted(n for n in got.values() if n > 1) == sorted(n for n in want.values() if n > 1)


def test_recurrence_spares_copies_and_inline_text(spark):
    """Inline elements never go, a page under many urls is one page, copies keep their text, and large hosts find rare menus."""
    rows = [(i, f"https://a.example/{i}", f"<body><p>It is <b>not</b> number {i}, see <a>here</a></p></body>") for i in range(6)]
    rows += [(10 + i, f"https://b.example/x?s={i}", "<article><div class=body><p>The one text</p><p>In two parts</p></div></article>") for i in range(8)]
    rows += [(20 + i, f"https://c.example/{i}", f"<article><h1>{i}</h1><div class=body><p>The one text</p><p>In two parts</p></div></article>") for i in range(8)]
    rows += [(100 + i, f"https://d.example/{i}", f"<body>{'<div><ul><li>Rare menu</ul></div>' if i < 12 else ''}<p>The own text of {i}</p></body>") for i in range(1000)]
    got = {r.page_id: r.text for r in html_template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == f"It is not number {i}, see here"
    for i in range(8):
        assert got[10 + i] == "The one text\nIn two parts" and got[20 + i] == f"{i}\nThe one text\nIn two parts"
    assert all(got[100 + i] == f"The own text of {i}" for i in range(1000))


def scan(text):
    templates = [licenses.Template(n, t, licenses.IDENTITY.get(n, ())) for n, t in sorted(licenses.NOTICES.items())]
    return licenses.scan_text(text, templates, frozenset().union(*(t.vocabulary for t in templates)))


def test_edited_notices_are_aligned():
    """The check before the alignment drops no notice with enough positions, and a far word spoils no hit."""
    once = lambda ws: {w for w in ws if ws.count(w) == 1}
    for name, changed in (("Apache-2.0-header", 12), ("MIT-text", 11), ("GPL-3.0-header", 7), ("BSD-2-Clause", 7)):
        ws = licenses.words_of(licenses.NOTICES[name])
        drop = [w for w in ws if w in once(ws) and not w[0].isdigit() and w not in ("gnu", "apache", "version")][-changed:]
        text = " ".join("zzz" if w in drop else w for w in ws)
        got = [c for n, c, *_ in scan(text) if n == name]
        assert got and got[0] >= (len(ws) - changed) / len(ws) - 0.03, (name, got)
    mit = licenses.words_of(licenses.NOTICES["MIT-text"])
    far = " ".join(mit[:-1]) + " " + " ".join(["zz " * 20 + "the"] * 9) + " zz software"
    hits = [h for h in scan(far) if h[0] == "MIT-text"]
    assert len(hits) == 1 and hits[0][1] >= (len(mit) - 1) / len(mit) and hits[0][2:] == (0, len(mit) - 2)
    stray = "the of to and or this " * 12 + " ".join(mit) + " " + " ".join(mit)
    assert [h[1] for h in scan(stray) if h[0] == "MIT-text"] == [1.0, 1.0]


def test_licenses_are_told_from_their_likes(spark, make_docs):
    gpl = licenses.NOTICES["GPL-3.0-header"]
    cases = {"Released under the BSD License": "BSD", "Licensed under the Mozilla Public License, Version 2.0": "MPL-2.0",
             "This work is licensed under the GNU General Public License, version 2": "GPL-2.0", "This work is licensed under the GNU Lesser General Public License, version 3": "LGPL-3.0",
             "Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under CC BY 4.0": "CC-BY-4.0", "Licensed under CC BY 3.0": None,
             "Released under the ISC License": "ISC", "under the MIT license": "MIT", "This work is licensed under the GNU General Public License v3.0": "GPL-3.0",
             "Licensed under the Apache License v. 2.0": "Apache-2.0", "Licensed under the Apache Software License, Version 2.0": None,
             gpl.replace("version 3", "version 2"): "GPL-2.0-header", gpl.replace("GNU General", "GNU Affero General"): "AGPL-3.0-header",
             gpl.replace("GNU General", "GNU Lesser General"): "LGPL-3.0-header", **{t: n for n, t in licenses.NOTICES.items()}}
    got = {r.doc_id: r for r in licenses.scan_documents(make_docs([(i, f"Some words. {t} And more.") for i, t in enumerate(cases)])).collect()}
    for i, (text, name) in enumerate(cases.items()):
        assert {h.license for h in got[i].hits} == ({name} if name else set()), (text, got[i])
        assert got[i].license == name and got[i].n_licenses == bool(name)


def test_one_row_of_each_class_is_kept(spark, make_docs, rows):
    """Also where near copies have no id or one id, and of rows equal in id and text."""
    near_copies = [t for i, t in rows if i is not None and 60 <= i < 75]
    odd = [(None, t) for t in near_copies] + [(7, t) for t in near_copies[:3]] + rows + rows[:5]
    got = ngram_join.classes(make_docs(odd)).collect()
    texts = sorted({t or "" for _, t in odd})
    root, _ = roots([grams(t) for t in texts], 0.8)
    at = {t: k for k, t in enumerate(texts)}
    n_classes = len({root[at[t or ""]] for _, t in odd})
    kept = [r for r in got if r.kept]
    assert len(got) == len(odd) and len(kept) == n_classes and all(r.doc_id == r.class_id for r in kept)
    left = ngram_join.keep_one(make_docs(odd)).collect()
    assert len({root[at[r.text or ""]] for r in left}) == len(left) == n_classes


def test_rows_of_one_id_go_to_many_ranges(spark, make_docs):
    rng = random.Random(12)
    docs = [(i, " ".join(words(rng, 20))) for i in range(40)] + [(k, " ".join(words(rng, 20))) for k in [None] * 60 + [7] * 30]
    parts = collections.Counter(r.part for r in fingerprints.with_next(make_docs(docs), 800).where("not halo").collect())
    assert sum(parts.values()) == len(docs) and max(parts.values()) <= len(docs) // 5
    halos = fingerprints.with_next(make_docs(docs), 800).where("halo").count()
    assert halos == len(parts)
    ranks = fingerprints.rarity_ranks(fingerprints.entropy_counts(make_docs(docs)))
    got = collections.Counter(r.edited_sha256 for r in fingerprints.compare_edits(make_docs(docs), ranks).collect())
    hashed = {r.text: r.h for r in make_docs(docs).selectExpr("text", "xxhash64(text) h").collect()}
    order = sorted(docs, key=lambda r: (-1 if r[0] is None else r[0], hashed[r[1]]), reverse=True)
    want = collections.Counter()
    for k, (_, t) in enumerate(order):
        half = len(t) // 2
        want[hashlib.sha256((t[:len(t) - half] + order[(k + 1) % len(order)][1][:half]).encode()).hexdigest()] += 1
    assert got == want
