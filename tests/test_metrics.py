"""Metrics from the run that writes, rules in one pass, and output that is whole or unchanged."""
import json
import os

import pytest

from cohesion import map_entity, map_study
from cohesion.operators import quality
from cohesion.plans.metrics import study_metrics, summary_text
from cohesion.sources.sinks import write_entity, write_metrics, write_reports, write_study

ROWS = [("P1", "Deceased", 10, 1.5), ("P2", "Alive", 20, 1.5), ("P2", "Alive", None, None), (None, "Deceased", 30, None), ("bad id", None, 40, float("nan")), ("P3", "Deceased", None, -0.0), ("P3", "Deceased", 70000, 0.0)]
SPEC = {"entity": {"name": "Person", "fields": {"base": ["submitter_participant_id", "vital_status", "age_at_death", "v"]}},
        "filters": {"participant_id_field": "pid", "participant": {"filter": [{"field": "status", "op": "is_not_null"}]}},
        "mappings": [{"source_field": "pid", "target_field": "submitter_participant_id"}, {"source_field": "status", "target_field": "vital_status"},
                     {"source_field": "age", "target_field": "age_at_death"}, {"source_field": "v", "target_field": "v"}],
        "validations": [{"type": "unique", "field": "submitter_participant_id"}, {"type": "unique", "field": "v"}, {"type": "participant_id", "field": "submitter_participant_id"}, {"type": "age_range", "field": "age_at_death"}],
        "post_processing": [{"type": "odd"}]}


def source(spark):
    return spark.createDataFrame(ROWS, "pid string, status string, age long, v double")


def as_dict(metrics):
    return {(r.entity, r.metric, r.detail): r.value for r in metrics.collect()}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_all_metrics_from_one_run(spark, tmp_path, fmt):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    results = map_study(source(spark), {"participant": SPEC})
    results["participant"] = map_entity(source(spark), SPEC, name="participant", after=lambda d: d.mapInArrow(count, d.schema))
    paths = write_study(results, str(tmp_path), fmt)
    write_reports(results, str(tmp_path), fmt, paths)
    got = as_dict(write_metrics(results, paths, str(tmp_path), fmt, "s"))
    assert runs.value == 6  # rows of the output, mapped once
    p = "participant"
    assert got[p, "input_rows", ""] == 7 and got[p, "output_rows", ""] == 6 and got[p, "participants", ""] == 3
    assert (got[p, "participants_before", ""], got[p, "participants_after", ""], got[p, "eligibility_retention_pct", ""]) == (4, 3, 75)
    assert got[p, "bad_rows", "unique: submitter_participant_id"] == 2
    assert got[p, "bad_rows", "unique: v"] == 3  # 1.5 twice, null twice, 0.0 is -0.0
    assert got[p, "bad_rows", "age_range: age_at_death"] == 1 and got[p, "rules_failed", ""] == 4
    assert (got[p, "values_before_rule", "age_at_death"], got[p, "values_after_rule", "age_at_death"]) == (4, 3)
    assert [v for (e, m, d), v in got.items() if m == "warning"] == [1]
    assert got["", "participant_retention_pct", ""] == round(600 / 7, 4) and got["", "entities_failed", ""] == 0
    text = (tmp_path / "mapping_summary.txt").read_text()
    assert "entity participant" in text and "output rows: 6" in text
    report = {(r["rule"], r["field"]): int(r["bad_rows"]) for r in (spark.read.parquet if fmt == "parquet" else spark.read.option("header", True).csv)(str(tmp_path / f"validation_report.{fmt}")).collect()}
    assert report == {(k.split(": ")[0], k.split(": ")[1]): v for (e, m, k), v in got.items() if m == "bad_rows"}
    assert report == {(r.rule, r.field): r.bad_rows for r in results["participant"].report().collect()}


def test_rules_are_one_pass_without_copies_of_rows(spark):
    df = spark.range(5000).selectExpr("id", *(f"id % {k} AS c{k}" for k in range(1, 30)), "IF(id % 3 = 0, NULL, id) AS n")
    rules = [{"type": "unique", "field": c} for c in df.columns] + [{"type": "required", "field": "n"}]
    report = quality.validation_report(df, rules, "e")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Range (0, 5000") == 1
    got = {(r.rule, r.field): r.bad_rows for r in report.collect()}
    assert got["unique", "id"] == 0 and got["required", "n"] == 1667 and got["unique", "n"] == 1666
    assert all(got["unique", f"c{k}"] == 5000 - k for k in range(1, 30))
    assert quality.validation_report(df.limit(0), rules, "e").where("bad_rows > 0").count() == 0


def test_counting_keeps_filters_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "in")
    source(spark).write.parquet(path)
    spec = SPEC | {"filters": {"participant_id_field": "pid", "rows": [{"name": "x", "filter": [{"field": "age", "op": "greater_than", "value": 15}]}]}}
    r = map_entity(spark.read.parquet(path), spec, order_by="age")
    for df in (r.df, r.measured()[0]):
        assert "GreaterThan(age,15)" in df._jdf.queryExecution().executedPlan().toString().replace(" ", "")
    assert "__had" not in r.df._jdf.queryExecution().executedPlan().toString()


def test_a_failing_entity_leaves_its_former_output(spark, tmp_path):
    good = {"person": map_entity(source(spark), SPEC, name="person"), "other": map_entity(source(spark), SPEC, name="other")}
    good["other"].name = "Other"
    paths = write_study(good, str(tmp_path))
    before = sorted(os.listdir(paths["person"]))
    broken = {"person": map_entity(source(spark), SPEC, name="person", after=lambda d: d.selectExpr("*", "CAST(vital_status AS INT) AS x")),
              "other": map_entity(source(spark).where("pid = 'P1'"), SPEC, name="other")}
    broken["other"].name = "Other"
    again = write_study(broken, str(tmp_path))
    assert again["person"] is None and broken["person"].error.startswith("write failed")
    assert sorted(os.listdir(paths["person"])) == before
    assert spark.read.option("header", True).csv(again["other"]).count() == 1
    told = json.loads((tmp_path / "_manifest.json").read_text())["entities"]
    assert told["person"]["error"] and told["other"]["rows"] == 1
    assert not [f for f in os.listdir(tmp_path) if f.startswith("_staging")]
    metrics = as_dict(study_metrics(spark, broken, again))
    assert metrics["", "entities_failed", ""] == 1


def test_an_empty_result_removes_the_former_output(spark, tmp_path):
    r = map_entity(source(spark), SPEC, name="person")
    path = write_entity(r, str(tmp_path))
    empty = map_entity(source(spark).limit(0), SPEC, name="person")
    assert os.path.isdir(path) and write_entity(empty, str(tmp_path)) is None and not os.path.exists(path)
    got = as_dict(study_metrics(spark, {"person": empty}, {"person": None}))
    assert got["person", "output_rows", ""] == 0 and got["person", "eligibility_retention_pct", ""] == 0 and got["person", "participants", ""] == 0


def test_texts_come_back_from_csv_as_they_were(spark, tmp_path):
    rows = [(" a ", 'say "x"'), ("two\nlines", "back\\slash"), ("\ttab", "a,b")]
    df = spark.createDataFrame(rows, "a string, b string")
    path = write_entity(df, str(tmp_path))
    from cohesion.sources.readers import read_file

    assert sorted(tuple(r) for r in read_file(spark, path).select("a", "b").collect()) == sorted(rows)


def test_the_runner_reads_on_past_bad_rows_if_told(spark, tmp_path):
    from cohesion.__main__ import main

    (tmp_path / "specs").mkdir()
    (tmp_path / "specs" / "person.yaml").write_text("entity: {name: Person, fields: {base: [pid, x]}}\nmappings:\n- {source_field: pid, target_field: pid}\n- {source_field: x, target_field: x}\n")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "person.csv").write_text("pid,x\n1,a\n2,b,c\n3,d\n")
    run = lambda *more: main(["--study", str(tmp_path / "specs"), "--input-dir", str(tmp_path / "in"), "--output", str(tmp_path / "out"), *more])
    assert run() == 1 and "2 rows" not in (tmp_path / "out" / "mapping_summary.txt").read_text()
    assert "1 rows have more fields" in (tmp_path / "out" / "mapping_summary.txt").read_text()
    assert run("--bad-rows", "skip") == 0 and spark.read.option("header", True).csv(str(tmp_path / "out" / "person.csv")).count() == 2
    assert run("--bad-rows", "keep") == 0 and spark.read.option("header", True).csv(str(tmp_path / "out" / "person.csv")).count() == 3


def test_no_results(spark, tmp_path):
    assert write_study({}, str(tmp_path)) == {} and write_reports({}, str(tmp_path)) is None
    failed = map_study(source(spark), {"x": {"entity": {"name": "X"}, "mappings": "?"}})
    paths = write_study(failed, str(tmp_path))
    assert paths == {"x": None} and write_reports(failed, str(tmp_path), paths=paths)
    assert "entities failed: 1" in summary_text("s", study_metrics(spark, failed, paths))
