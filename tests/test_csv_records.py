"""Records over line ends and blocks, headers with clashing names, rows of a wrong length: against pandas' reader and by hand."""
import csv
import io
import random

import pandas as pd
import pytest

from cohesion import map_entity
from cohesion.sources import readers as RD
from cohesion.sources import records as RC


def _file(tmp_path, text, name="x.csv", encoding="utf-8"):
    p = tmp_path / name
    p.write_bytes(text.encode(encoding))
    return str(p)


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(df):
    return [tuple(r) for r in df.orderBy(RD.ORD).drop(RD.ORD).collect()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_records_equal_pandas_over_many_blocks(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    pieces = ["a", "word", " ", ",", "\n", "\r\n", '"', "é", "1", "'", ";"]
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerow(["id", "note", "tail"])
    for i in range(1500):
        long = rng.random() < 0.004
        w.writerow([f"r{i}", "x" + "".join(rng.choice(pieces) for _ in range(3000 if long else rng.randint(0, 12))), rng.choice(["", "plain", 'q"uo"te', "two\nlines"])])
    text = out.getvalue().replace('"q""uo""te"', 'q"uo"te')  # quotes inside a field without quotes around it
    path = _file(tmp_path, text)
    want = pd.read_csv(io.StringIO(text, newline=""), dtype=str)
    df = RD.read_file(spark, path)
    assert df.rdd.getNumPartitions() > 5
    assert _rows(df) == [tuple(None if isinstance(v, float) else v for v in r) for r in want.itertuples(index=False)]


def test_a_field_over_several_blocks_and_plain_quotes(spark, tmp_path, small_blocks):
    long = "\n".join(f'line {i} with ""quotes"", and commas' for i in range(400))
    text = f'id,note\n1,"{long}"\n2,5" pipe\n3,"end"\n' + "".join(f'{i},"a\nb"\n' for i in range(4, 300)) + '300,"last\n"'
    got = _rows(RD.read_file(spark, _file(tmp_path, text)))
    assert got[0] == (1, long.replace('""', '"')) and got[1] == (2, '5" pipe') and got[2] == (3, "end") and got[-1] == (300, "last\n")
    assert len(got) == 300 and set(got[3:-1]) == {(i, "a\nb") for i in range(4, 300)}


def test_shuffled_states_give_the_same(spark, tmp_path, small_blocks, monkeypatch):
    text = "id,note\n" + "".join(f'{i},"a\n{i}"\n' for i in range(1000))
    monkeypatch.setattr(RC, "BROADCAST_BLOCKS", 0)
    assert _rows(RD.read_file(spark, _file(tmp_path, text))) == [(i, f"a\n{i}") for i in range(1000)]


def test_stray_quotes_leave_a_file_plain(spark, tmp_path):
    assert RD.text_facts(spark, _file(tmp_path, 'id,note\n1,5" pipe\n2,a"b\n')) == ("UTF-8", False)
    assert RD.text_facts(spark, _file(tmp_path, 'id\tnote\n1\t"a,\n"\n', "t.tsv"), "\t") == ("UTF-8", True)


def test_several_files_tabs_bom_and_latin(spark, tmp_path):
    d = tmp_path / "parts.csv"
    d.mkdir()
    for i in range(3):
        _file(d, f'﻿id,"no\nte"\n{i},"a\n{i}"\n\n', f"part-{i}.csv")
    df = RD.read_file(spark, str(d))
    assert df.columns[:2] == ["id", "no\nte"] and _rows(df) == [(i, f"a\n{i}") for i in range(3)]
    assert _rows(RD.read_file(spark, _file(tmp_path, 'id\tn\n1\t"é\nß"\n', "l.tsv", "latin-1"))) == [(1, "é\nß")]
    assert _rows(RD.read_file(spark, _file(tmp_path, "id,n\r\n1,a\r\n2,b\r\n", "w.csv"))) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("header", ["a,a,b", "a,a.1,a", "a,a,a.1,a", ",x,", "Age,age,AGE", "x,,x", "Unnamed: 1,,y"])
def test_names_equal_pandas(spark, tmp_path, header):
    n = header.count(",") + 1
    text = header + "\n" + ",".join(str(i + 1) for i in range(n)) + "\n"
    df = RD.read_file(spark, _file(tmp_path, text))
    want = pd.read_csv(io.StringIO(text))
    assert df.columns[:n] == list(want.columns)
    assert [tuple(r)[:n] for r in df.collect()] == [tuple(range(1, n + 1))]


def test_fields_that_differ_by_case_are_mapped_apart(spark, tmp_path):
    df = RD.read_file(spark, _file(tmp_path, "pid,Age,age\np1,3,4\np2,5,\n"))
    out = map_entity(df, {"entity": {"name": "x", "fields": {"base": ["old", "young"]}}, "filters": {"participant_id_field": "pid", "participant": {"filter": [{"field": "Age", "op": "greater_than", "value": 3}]}},
                          "mappings": [{"source_field": "Age", "target_field": "old"}, {"source_field": "age", "target_field": "young"}]}).df
    assert [tuple(r) for r in out.collect()] == [(5, None)]
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


BAD = 'id,a,b\n1,x,y\n2,x,y,z\n3,x\n4,"x,1",y,\n5,x,y\n'


@pytest.mark.parametrize("text", [BAD, BAD.replace("5,x,y", '5,"x\n",y')])
def test_rows_of_a_wrong_length(spark, tmp_path, text):
    path = _file(tmp_path, text)
    with pytest.raises(RD.BadRows, match="2 rows"):
        RD.read_file(spark, path)
    assert [r[0] for r in _rows(RD.read_file(spark, path, bad_rows="skip"))] == [1, 3, 5]
    assert RD.read_file(spark, path, bad_rows="skip").count() == 3 and RD.read_file(spark, path, bad_rows="skip", schema={"id": "bigint"}).count() == 3
    kept = _rows(RD.read_file(spark, path, bad_rows="keep"))
    assert kept[1] == (2, "x", "y") and kept[2] == (3, "x", None) and kept[3] == (4, "x,1", "y")
    bad = [(r.fields, r.expected, r.record) for r in RD.malformed_rows(spark, path).orderBy("p").collect()]
    assert bad == [(4, 3, "2,x,y,z"), (4, 3, '4,"x,1",y,')]
    typed = {"id": "bigint"}
    assert len(_rows(RD.read_file(spark, path, schema=typed))) == 5
    assert len(_rows(RD.read_file(spark, path, schema=typed, bad_rows="skip"))) == 3
    with pytest.raises(Exception, match="more fields"):
        RD.read_file(spark, path, schema=typed, bad_rows="error").collect()


def test_empty_and_header_only(spark, tmp_path):
    assert RD.read_file(spark, _file(tmp_path, "")).collect() == []
    df = RD.read_file(spark, _file(tmp_path, "a,b\n", "h.csv"))
    assert df.collect() == [] and df.columns[:2] == ["a", "b"]


@pytest.mark.parametrize("name", ["id,note", 'id,"no\nte"'])
def test_the_header_is_of_the_first_file_with_lines(spark, tmp_path, name):
    d = tmp_path / "parts.csv"
    d.mkdir()
    for i, text in enumerate(["", "\n\r\n", f"{name}\n1,a\n2,b,c\n", "", f"{name}\n3,d\n"]):
        _file(d, text, f"part-{i}.csv")
    kept = RD.read_file(spark, str(d), bad_rows="keep")
    assert kept.columns[:2] == ["id", name[3:].strip('"')] and _rows(kept) == [(1, "a"), (2, "b"), (3, "d")]
    assert _rows(RD.read_file(spark, str(d), bad_rows="skip")) == [(1, "a"), (3, "d")]
    assert [(r.fields, r.expected, r.record) for r in RD.malformed_rows(spark, str(d)).collect()] == [(3, 2, "2,b,c")]
    blank = tmp_path / "blank.csv"
    blank.mkdir()
    _file(blank, "", "part-0.csv"), _file(blank, "\n", "part-1.csv")
    assert RD.read_file(spark, str(blank)).collect() == []
