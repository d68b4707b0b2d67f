"""The stages of the pipeline, each against a plain version on what the stage before kept."""
import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cohesion.llm import quality_crf
from cohesion.llm.common import cut, table

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _ngrams(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _kept_of_near(rows):
    sets = [_ngrams(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                a, b = find(i), find(j)
                if a != b:  # the smaller id leads
                    small, large = (a, b) if rows[a][0] < rows[b][0] else (b, a)
                    root[large] = small
    return {rows[find(i)][0] for i in range(len(rows))}


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows of doc_id and text, DataFrame) after each stage, the table first."""
    docs = table(spark, SF, "documents")
    out = [("documents", [(r.doc_id, r.text) for r in docs.collect()], docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF), name)
        out.append((name, [(r.doc_id, r.text) for r in docs.collect()] if "text" in docs.columns else docs.collect(), docs))
    return out


def test_stages_follow_the_contract(stages):
    assert [n for n, *_ in stages[1:]] == ["quality", "exact_dedup", "near_dedup", "packing"]
    for _, _, df in stages[1:-1]:
        assert df.columns == stages[0][2].columns


def test_quality_drops_what_the_field_rejects(spark, stages):
    field = quality_crf.train(stages[0][2], table(spark, SF, "labels"))
    want = [(i, t) for i, t in stages[0][1] if field.score(t or "") >= 0.5]
    assert sorted(stages[1][1]) == sorted(want) and len(want) < len(stages[0][1])


def test_exact_copies_go(stages):
    best = {}
    for i, t in stages[1][1]:
        key = (t or "").translate(UPPER)
        best[key] = max(best.get(key, -1), i)
    assert sorted(i for i, _ in stages[2][1]) == sorted(best.values())


def test_one_of_each_near_class_stays(stages):
    assert {i for i, _ in stages[3][1]} == _kept_of_near(stages[2][1])


def test_packing_holds_every_id_once(spark, stages):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = collections.defaultdict(list)
    for r in stages[4][1]:
        pieces[r.doc_id].append(r)
    assert set(pieces) == {i for i, _ in stages[3][1]}
    for i, t in stages[3][1]:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    by_sequence = collections.defaultdict(list)
    for r in stages[4][1]:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    key = lambda rows: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(corpus_pipeline.run(spark, SF).collect()) == key(stages[4][1])


def test_empty_table_nulls_and_repeated_rows(spark, tmp_path):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    for name, df in (("empty", docs.limit(0)), ("odd", spark.createDataFrame([(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "one", None, None, None), (3, "one", None, None, None), (None, "no id", "en", "s", 5)], docs.schema))):
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.limit(0).write.parquet(str(tmp_path / name / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).collect() == []
    got = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    # without labels nothing is rejected; null and empty texts are copies, as are the repeated rows
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in got) == [-1, 2, 3]
