"""End to end: two small studies against outputs worked out by hand from the rules."""
import os

import pytest

from cohesion import load_study, map_entity, map_study
from cohesion.plans.engine import release
from cohesion.sources.readers import read_file

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
REGISTRY, LINKED = os.path.join(FIXTURES, "registry"), os.path.join(FIXTURES, "linked")

# A3 did not agree. Ages are days from birth to the visit; reviews take the birth date of the baseline row,
# and their number comes out as 1.0 because the column also has nulls.
LITRES, MILLILITRES = ("U:1", "litres a minute"), ("U:2", "millilitres a second")
EXPECTED = {
    "person": [("A1", "Female", 10958), ("A2", "Male", 5494), ("A4", "Male", None)],
    "condition": [("A1", "C:1", "Eczema", "Present", "A1_condition_eczema"), ("A1", "C:2", "Hay fever", "Present", "A1_condition_hayfever"),
                  ("A2", "C:1", "Eczema", "Present", "A2_condition_eczema"),
                  ("A4", "C:1", "Eczema", "Present", "A4_condition_eczema"), ("A4", "C:2", "Hay fever", "Present", "A4_condition_hayfever")],
    "flow": [("A1", 10958, "F:9", 410.5, *LITRES, "A1_flow_flow_done", "Peak flow"),
             ("A1", 11142, "F:9", 432.0, *LITRES, "A1_flow_flow_done_1.0", "Peak flow"),
             ("A2", 5494, "F:9", 520.0, *LITRES, "A2_flow_flow_done", "Peak flow"),
             ("A2", 5524, "F:9", 505.0, *LITRES, "A2_flow_flow_done_1.0", "Peak flow"),
             ("A2", 5706, "F:9", 498.0, *MILLILITRES, "A2_flow_flow_done_2.0", "Peak flow")],
}


@pytest.fixture(scope="module")
def registry(spark):
    return read_file(spark, os.path.join(REGISTRY, "visits.csv")), load_study(os.path.join(REGISTRY, "specs"))


def rows(result):
    return sorted((tuple(r) for r in result.df.collect()), key=repr)


@pytest.mark.parametrize("entity", sorted(EXPECTED))
def test_entity_matches_the_rules(registry, entity):
    src, specs = registry
    got = map_entity(src, specs[entity])
    assert got.df.columns == specs[entity].fields
    assert rows(got) == sorted(EXPECTED[entity], key=repr)


def test_shared_selections_give_the_same(registry):
    src, specs = registry
    res = map_study(src, specs, share="persist")
    try:
        for entity, want in EXPECTED.items():
            assert rows(res[entity]) == sorted(want, key=repr)
    finally:
        release(res)


def test_source_inference(registry):
    types = dict(registry[0].dtypes)
    assert types["agree"] == types["seq"] == "double"  # whole numbers with nulls
    assert types["flow_done"] == "bigint"              # whole numbers, no nulls
    assert types["peak_flow"] == "double" and types["person"] == "string"


def test_counts_and_release(registry):
    src, specs = registry
    r = map_entity(src, specs["flow"], metrics="all")
    r.df.write.format("noop").mode("overwrite").save()
    assert r.counts() == {"input": 7, "selected": 6, "output": 5}

    res = map_study(src, {k: specs[k] for k in ("person", "condition")}, share="persist")
    shared = res["person"].shared
    assert shared is not None and shared is res["condition"].shared  # one selection for equal filters
    res["person"].df.count()
    assert shared.storageLevel.useDisk or shared.storageLevel.useMemory
    release(res)
    assert not shared.storageLevel.useMemory and not shared.storageLevel.useDisk


def test_linked_files(spark):
    res = map_study(None, load_study(os.path.join(LINKED, "specs")), source_dir=os.path.join(LINKED, "source"))
    res["person"].df.write.format("noop").mode("overwrite").save()
    assert res["person"].counts()["output"] == 4
    assert rows(res["person"]) == [("REG", p) for p in ("B1", "B2", "B4", "B5")]
    # 10957.5 and 12418.5 are rounded half to even
    assert rows(res["finding"]) == [("B1", "B1_finding", "J45", "Asthma", 10958), ("B2", "B2_finding", "L20", "Eczema", 14975),
                                    ("B5", "B5_finding", "J45", "Asthma", 12418)]
    report = res["person"].report().collect()
    assert {r.rule for r in report} == {"required", "unique"} and not any(r.bad_rows for r in report)


def test_parquet_rows_keep_their_place_in_the_file(spark, tmp_path):
    path = str(tmp_path / "visits.parquet")
    spark.range(1000).selectExpr("id % 7 AS pid", "id AS v").coalesce(1).write.parquet(path)
    df = read_file(spark, path)
    spec = {"entity": {"name": "Last", "fields": {"base": ["pid", "v"]}},
            "filters": {"participant_id_field": "pid", "rows": [{"name": "all", "filter": [{"field": "v", "op": "is_not_null"}], "select": "last"}]},
            "mappings": [{"source_field": c, "target_field": c} for c in ("pid", "v")]}
    want = sorted((p, max(range(p, 1000, 7))) for p in range(7))
    assert rows(map_entity(df, spec)) == rows(map_entity(df.repartition(5), spec)) == sorted(want, key=repr)
