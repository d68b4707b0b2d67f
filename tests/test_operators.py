"""Unit tables for row selection, enrichment, expansion, union by name and specs."""
import pytest

from cohesion import map_entity
from cohesion.functions.predicates import SpecError
from cohesion.sources.multifile import union_by_name
from cohesion.spec import load_spec

SCHEMA = "pid string, ord long, a string, b double, c string"
ROWS = [("P1", 1, None, 1.0, "x"), ("P1", 2, "a2", None, "y"), ("P1", 3, "a3", 3.0, None),
        ("P2", 4, "b1", 5.0, "z"), ("P2", 4, "b1", 5.0, "z"),  # exact duplicate of the row above
        (None, 6, "n", 9.0, "w")]


def _spec(select, fields=("pid", "a", "b", "c"), **filters):
    return {"entity": {"name": "T", "fields": {"base": list(fields)}},
            "filters": {"participant_id_field": "pid", "rows": [{"name": "r", "filter": [
                {"field": "pid", "op": "is_not_null"}], "select": select}], **filters},
            "mappings": [{"source_field": f, "target_field": f} for f in fields]}


def _rows(spark, spec, rows=ROWS, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).drop()
    return sorted((tuple(r) for r in map_entity(df, spec, order_by="ord").df.collect()), key=repr)


def test_select_first_is_composite(spark):
    assert _rows(spark, _spec("first")) == sorted([("P1", "a2", 1.0, "x"), ("P2", "b1", 5.0, "z")], key=repr)


def test_select_last_is_composite(spark):
    assert _rows(spark, _spec("last")) == sorted([("P1", "a3", 3.0, "y"), ("P2", "b1", 5.0, "z")], key=repr)


def test_select_all_dedups_whole_rows(spark):
    got = _rows(spark, _spec("all"))
    assert got.count(("P2", "b1", 5.0, "z")) == 1 and len(got) == 4


def test_enrichment_fills_nulls_from_first_source_row(spark):
    spec = _spec("all", enrich=[{"name": "e", "source": [{"field": "c", "op": "is_not_null"}],
                                 "fields": ["a", "b"], "select": "first"}])
    got = _rows(spark, spec)
    # P1's first row with c not null is ord 1 (a null, b 1.0): a fills from the next non-null (ord 2)
    assert ("P1", "a2", 1.0, "x") in got and ("P1", "a2", 3.0, None) not in got
    assert ("P1", "a3", 3.0, None) in got


def test_eligibility_keeps_all_rows_of_participant(spark):
    spec = _spec("all", participant={"filter": [{"field": "c", "op": "equals", "value": "y"}]})
    assert {r[0] for r in _rows(spark, spec)} == {"P1"}
    assert len(_rows(spark, spec)) == 3


EXP_SCHEMA = "pid string, ord long, f1 long, f2 double, f3 string, g1 long, g2 long"
EXP_ROWS = [("P1", 1, 1, 0.0, "A", 1, 1), ("P2", 2, 0, None, "0", 0, 0), ("P3", 3, -1, 2.0, "AB", 0, 1),
            (None, 4, 1, 1.0, "A", 1, 1)]


def _xspec(configs, skip=None, mappings=None):
    e = {"name": "Item", "fields": {"base": ["pid", "item_code", "sub"]}, "pattern": "expansion"}
    if skip is not None:
        e["params"] = {"skip_values": skip}
    return {"entity": e, "filters": {"participant_id_field": "pid"},
            "mappings": mappings or [{"source_field": "pid", "target_field": "pid"}], "configs": configs}


def test_expansion_flags_and_text(spark):
    configs = [{"source_field": c, "code": c.upper()} for c in ("f1", "f2", "f3")]
    got = _rows(spark, _xspec(configs, skip=[0, "A"]), EXP_ROWS, EXP_SCHEMA)
    # f1: 1 and -1 kept; f2: 2.0 kept (0.0 skipped, null skipped); f3: "0" int-casts to 0 -> skipped, "A" skipped
    assert got == sorted([("P1", "F1", None), ("P3", "F1", None), ("P3", "F2", None), ("P3", "F3", None)], key=repr)


def test_expansion_create_records(spark):
    configs = [{"source_field": "f1", "code": "F1", "enrichments": [
        {"target_field": "sub", "source_type": "checkbox", "create_records": True,
         "value_mappings": {"g1": "G1", "g2": "G2"}}]}]
    got = _rows(spark, _xspec(configs), EXP_ROWS, EXP_SCHEMA)
    assert got == sorted([("P1", "F1", "G1"), ("P1", "F1", "G2"), ("P3", "F1", "G2")], key=repr)


def test_union_by_name_widens_types(spark):
    a = spark.createDataFrame([("S1", "blood", 1, -80)], "specimen_id string, type string, volume long, storage_temp long")
    b = spark.createDataFrame([("S2", "saliva", 2.5, "site A")],
                              "specimen_id string, type string, volume double, collection_site string")
    u = union_by_name([a, b])
    assert dict(u.dtypes)["volume"] == "double"
    assert sorted(u.collect(), key=lambda r: r.specimen_id)[1].storage_temp is None
    assert set(u.columns) == {"specimen_id", "type", "volume", "storage_temp", "collection_site"}


def test_spec_rules():
    s = load_spec({"entity": {"name": "X", "fields": {"extension": ["e"], "base": ["b"], "other": ["o"], "skip": None}},
                   "configs": [{"type": "range", "start": 1, "end": 2,
                                "template": {"source_field": "q{n}", "code": "C{n:02d}", "{n}": "k"}}],
                   "bogus": 1})
    assert s.fields == ["b", "e", "o"]
    assert [c["source_field"] for c in s.configs] == ["q1", "q2"] and s.configs[1]["code"] == "C02"
    assert "{n}" in s.configs[0]  # keys are not templated
    assert s.warnings
    with pytest.raises(SpecError):
        load_spec({"entity": {"source_files": {"secondary": []}}})
    with pytest.raises(SpecError):
        load_spec({"entity": {"source_files": {"primary": "a.csv", "secondary": [{"file": "b.csv",
                                                                                  "join_type": "cross"}]}}})


def test_odd_column_names(spark, tmp_path):
    from cohesion.sources.readers import read_file

    p = tmp_path / "odd.csv"
    p.write_text("participant id,lab.value,visit\nP1,1.5,1\nP1,,2\nP2,3,1\n")
    df = read_file(spark, str(p))
    spec = {"entity": {"name": "T", "fields": {"base": ["pid", "lab"]}},
            "filters": {"participant_id_field": "participant id",
                        "rows": [{"name": "f", "filter": [{"field": "visit", "op": "greater_than", "value": 0}],
                                  "select": "last"}]},
            "mappings": [{"source_field": "participant id", "target_field": "pid"},
                         {"source_field": "lab.value", "target_field": "lab"}]}
    got = sorted(tuple(r) for r in map_entity(df, spec).df.collect())
    assert got == [("P1", 1.5), ("P2", 3.0)]


def test_multiline_and_nulls_match_options(spark, tmp_path):
    from cohesion import map_study

    d = tmp_path / "src"
    d.mkdir()
    (d / "main.csv").write_text('pid,note\nP1,"two\nlines"\n,orphan\n')
    (d / "extra.csv").write_text("pid,x\nP1,1\n,2\n")
    spec = {"entity": {"name": "M", "fields": {"base": ["pid", "note", "x"]},
                       "source_files": {"primary": "main.csv", "multi_line": True, "secondary": [
                           {"file": "extra.csv", "join_on": "pid", "nulls_match": False}]}},
            "mappings": [{"source_field": c, "target_field": c} for c in ("pid", "note", "x")]}
    got = sorted((tuple(r) for r in map_study(None, {"m": spec}, source_dir=str(d))["m"].df.collect()), key=repr)
    assert got == sorted([("P1", "two\nlines", 1.0), (None, "orphan", None)], key=repr)


def test_duplicate_yaml_sections_warn(tmp_path):
    p = tmp_path / "x.yaml"
    p.write_text("entity:\n  name: X\nfilters:\n  a: 1\nfilters:\n  b: 2\n")
    s = load_spec(p)
    assert s.filters == {"b": 2} and any("duplicate" in w for w in s.warnings)


def test_many_configs_plan_fast_and_exact(spark):
    import time

    from pyspark.sql import functions as F

    k = 100
    df = spark.range(500).select(F.col("id").alias("pid"),
                                 *[((F.col("id") + n) % 4).alias(f"q{n}") for n in range(1, k + 1)])
    spec = {"entity": {"name": "Q", "fields": {"base": ["pid", "q_code", "detail"]}, "pattern": "expansion"},
            "filters": {"participant_id_field": "pid"},
            "mappings": [{"source_field": "pid", "target_field": "pid"}],
            "configs": [{"type": "range", "start": 1, "end": k, "template": {
                "source_field": "q{n}", "code": "Q:{n:03d}",
                "enrichments": [{"target_field": "detail", "source_type": "radio",
                                 "value_mappings": {1: "one", 2: "two", 3: "three"}}]}}]}
    t = time.time()
    out = map_entity(df, spec).df
    assert time.time() - t < 30  # one SQL expression per loop, not thousands of Column calls
    assert out.count() == sum(1 for i in range(500) for n in range(1, k + 1) if (i + n) % 4 != 0)
    row = out.where("pid = 0 AND q_code = 'Q:001'").collect()[0]
    assert row.detail == "one"
