"""Incremental export stream, sinks, auto numeric detection."""
import os
import shutil

from cohesion import load_study
from cohesion.operators.clean import auto_numeric_columns
from cohesion.sources.readers import read_file
from cohesion.streaming import map_exports_stream

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def test_export_stream_maps_each_file(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    shutil.copy(os.path.join(FIXTURES, "registry", "visits.csv"), src / "export1.csv")
    specs = load_study(os.path.join(FIXTURES, "registry", "specs"))
    specs = {k: specs[k] for k in ("person", "condition")}
    out = tmp_path / "out"
    map_exports_stream(spark, str(src), specs, str(out), checkpoint_dir=str(tmp_path / "ckpt"))
    assert read_file(spark, str(out / "batch=0" / "person.csv")).count() == 3
    assert read_file(spark, str(out / "batch=0" / "condition.csv")).count() == 5


def test_export_stream_reads_files_as_any_source_and_goes_on_after_a_restart(spark, tmp_path):
    import pytest

    src = tmp_path / "incoming"
    src.mkdir()
    spec = {"note": {"entity": {"name": "Note", "fields": {"base": ["id", "text"]}}, "mappings": [{"source_field": c, "target_field": c} for c in ("id", "text")]}}
    run = lambda: map_exports_stream(spark, str(src), spec, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    (src / "a.csv").write_bytes('id,text\n1,"two\nlines"\n2,é\n'.encode("latin-1"))
    run()
    (src / "b.tsv").write_text("id\ttext\n3\ta,b\n")
    run()
    run()  # nothing new
    rows = lambda i: sorted(tuple(r) for r in read_file(spark, str(tmp_path / "out" / f"batch={i}" / "note.csv")).select("id", "text").collect())
    assert rows(0) == [(1, "two\nlines"), (2, "é")] and rows(1) == [(3, "a,b")]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["batch=0", "batch=1"]
    with pytest.raises(ValueError, match="checkpoint_dir"):
        map_exports_stream(spark, str(src), spec, str(tmp_path / "o2"), "")


def test_auto_numeric_any_value_of_the_whole_column(spark):
    rows = [(i, "1,000.5" if i == 150 else "abc", "x" if i == 50 else "7", "n/a", None) for i in range(200)]
    df = spark.createDataFrame(rows, "o long, a string, b string, c string, d string")
    # one numeric value anywhere is enough; none, or no value at all, is not
    assert auto_numeric_columns(df, "o") == ["a", "b"]


def test_write_study_skips_empty_and_isolates_failures(spark, tmp_path):
    import pytest as _pytest  # noqa: F401

    from cohesion import map_entity
    from cohesion.sources.sinks import write_reports, write_study

    df = spark.createDataFrame([("P1", 1), ("P2", 2)], "pid string, v long")
    ok = map_entity(df, {"entity": {"name": "Ok", "fields": {"base": ["pid"]}},
                         "mappings": [{"source_field": "pid", "target_field": "pid"}],
                         "validations": [{"type": "unique", "field": "pid"}]}, name="ok")
    empty = map_entity(df, {"entity": {"name": "Empty", "fields": {"base": ["pid"]}},
                            "filters": {"participant_id_field": "pid",
                                        "participant": {"filter": [{"field": "v", "op": "equals", "value": 9}]}},
                            "mappings": [{"source_field": "pid", "target_field": "pid"}]}, name="empty")
    # fails only when executed: ANSI cast error raised by the job, not at plan time
    bad = map_entity(df, {"entity": {"name": "Bad", "fields": {"base": ["x"]}}, "mappings": []}, name="bad",
                     after=lambda d: d.selectExpr("CAST('not a number' AS INT) AS x"))
    paths = write_study({"ok": ok, "empty": empty, "bad": bad}, str(tmp_path))
    assert paths["ok"] and os.path.isdir(paths["ok"])
    assert paths["empty"] is None and not os.path.exists(tmp_path / "empty.csv")
    assert paths["bad"] is None and bad.error
    rep = read_file(spark, write_reports({"ok": ok}, str(tmp_path)))
    assert rep.count() == 1


def test_join_key_type_clash_is_a_plan_error(spark):
    import pytest

    from cohesion.functions.predicates import SpecError
    from cohesion.sources.multifile import join_sources

    a = spark.createDataFrame([("1", "x")], "k string, a string")
    b = spark.createDataFrame([(1, "y")], "k long, b string")
    with pytest.raises(SpecError):
        join_sources(a, b, ["k"])


def test_study_runner_cli(spark, tmp_path):
    from cohesion.__main__ import main

    out = tmp_path / "mapped"
    rc = main(["--study", os.path.join(FIXTURES, "linked", "specs"), "--input-dir",
               os.path.join(FIXTURES, "linked", "source"), "--output", str(out)])
    assert rc == 0
    assert read_file(spark, str(out / "person.csv")).count() == 4
    assert read_file(spark, str(out / "finding.csv")).count() == 3
    assert (out / "validation_report.csv").exists()
