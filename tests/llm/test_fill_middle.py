"""Fill-in-the-middle against a plain version, and its exact round trip."""
import hashlib
import random
import re

import pytest

from cohesion.llm import fill_middle


def plainly(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, d = len(units), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    odd = ["<", ">", "<P", "S>", "<M", "é", "日本", "😀", "\x00", "\x7f", "\n", " ", "\t", " ", "İ", "²", "word", "Ab", "a", "."]
    out = [(i, "".join(rng.choice(odd) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    out += [(300, None), (301, ""), (302, "a <P> b"), (303, "<S>"), (304, "x<M>"), (305, "é"), (306, "one"), (306, "one"), (306, "another"), (None, "no id <here"), (None, None),
            (307, "word é, " * 120_000), (-5, "minus five"), (2**62, "large id")]
    return out


def test_equals_plain_version(spark, make_docs, rows):
    got = sorted(map(repr, (tuple(r) for r in fill_middle.transform(make_docs(rows)).collect())))
    assert got == sorted(repr(plainly(*r)) for r in rows)
    assert {eval(r)[2] for r in got} == {"plain", "psm", "spm"}


def test_restores_every_text(spark, make_docs, rows):
    back = fill_middle.restore(fill_middle.transform(make_docs(rows))).select("doc_id", "restored").collect()
    assert sorted(map(repr, map(tuple, back))) == sorted(repr((i, t or "")) for i, t in rows)
    sums = fill_middle.report(make_docs(rows)).select("doc_id", "restored_sha256").collect()
    assert sorted(map(repr, map(tuple, sums))) == sorted(repr((i, hashlib.sha256((t or "").encode()).hexdigest())) for i, t in rows)


def test_slices_do_not_change_rows(spark, make_docs, rows, monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([t or "" for _, t in rows])], names=["text"])
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 100)
    parts = list(fill_middle._slices(batch, 0))
    assert len(parts) > 20 and pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()


def test_empty_table_and_other_rates(spark, make_docs, rows):
    assert fill_middle.report(make_docs([])).collect() == []
    forms = {r.form for r in fill_middle.transform(make_docs(rows), rate=0).collect()}
    assert forms == {"plain"}
    forms = {r.form for r in fill_middle.transform(make_docs(rows), seed=7, rate=100, suffix_first=100).where("n > 0 and form != 'plain'").collect()}
    assert forms == {"spm"}
