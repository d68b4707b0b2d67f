"""Large code lists and many configs: equal results by table and by expression, and plans that don't grow with the spec."""
import pytest

import __spark_entry__ as E
from cohesion import map_entity
from cohesion.operators import expand, mapping
from cohesion.plans import catalog
from test_oracles import _rows, con  # noqa: F401

SF = "/root/testdata/sf0.001"
NAMES = [n for n in catalog.QUERIES if n.startswith(("map_values", "map_multi", "map_radio", "map_note", "map_integer", "map_default", "expand_", "entity_"))]


@pytest.mark.parametrize("name", NAMES)
def test_by_table_at_every_size(spark, con, name, monkeypatch):  # noqa: F811
    monkeypatch.setattr(mapping, "LIST_KEYS", 0)
    monkeypatch.setattr(expand, "CONFIG_ROWS", 0)
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), [d[0] for d in res.description])


def _listed(spark, n, **kw):
    df = spark.createDataFrame([(i, str(i), i / 2) for i in range(50)], "k long, t string, f double")
    ms = [{"source_field": "k", "target_field": "a", "value_mappings": {i: f"v{i}" for i in range(n)}},
          {"source_field": "t", "target_field": ["b", "c"], "value_mappings": {str(i): [i, f"w{i}"] for i in range(n)}},
          {"source_field": "f", "target_field": "d", "target_type": "integer", "value_mappings": {i: i * 10 for i in range(n)}, "default_value": 7}]
    return map_entity(df, {"entity": {"name": "x", "fields": {"base": list("abcd")}}, "mappings": ms}).df


def test_long_lists_are_joined_and_plans_stay_small(spark):
    plans = {n: _listed(spark, n)._jdf.queryExecution().optimizedPlan().toString() for n in (200, 10_000)}
    assert abs(len(plans[200]) - len(plans[10_000])) < 200 and plans[200].count("Join LeftOuter") == 3
    got = sorted((tuple(r) for r in _listed(spark, 10_000).collect()), key=repr)
    assert got == sorted(((f"v{i}", i or None, f"w{i}", (i // 2) * 10) for i in range(50)), key=repr)


def test_a_list_beyond_the_broadcast_size_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(mapping, "BROADCAST_BYTES", 10)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = _listed(spark, 500)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        monkeypatch.setattr(mapping, "LIST_KEYS", 1000)
        assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted((tuple(r) for r in _listed(spark, 500).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_list_on_one_key_is_joined_once(spark):
    df = spark.createDataFrame([(1,)], "k long")
    vm = {i: f"v{i}" for i in range(300)}
    out = map_entity(df, {"entity": {"name": "x", "fields": {"base": ["a", "b"]}}, "mappings": [{"source_field": "k", "target_field": t, "value_mappings": vm} for t in ("a", "b")]}).df
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1 and [tuple(r) for r in out.collect()] == [("v1", "v1")]


def test_many_configs_keep_rows_narrow_and_code_generated(spark):
    df = spark.range(3).selectExpr("id AS pid", *(f"IF(id = 1 AND {i} % 500 = 0, {i} + 1, 0) AS q{i}" for i in range(1500))).repartition(1).cache()
    configs = [{"source_field": f"q{i}", "code": f"C{i}", "enrichments": [{"target_field": "label", "default_value": f"L{i}"}] + ([{"target_field": "x", "value_mappings": {501: "five"}}] if i % 2 == 0 else [])} for i in range(1500)]
    out = map_entity(df, {"entity": {"name": "Item", "fields": {"base": ["item_code", "label", "x"]}, "pattern": "expansion", "params": {"skip_values": [0]}},
                          "filters": {"participant_id_field": "pid"}, "mappings": [], "configs": configs}).df
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([("C0", "L0", None), ("C500", "L500", "five"), ("C1000", "L1000", None)], key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    text = out._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "posexplode" in text
    below = plan[plan.index("BroadcastHashJoin"):].splitlines()[1]
    assert "q1#" not in below  # the wide columns end at the explode
    assert "*(" in plan[:plan.index("BroadcastHashJoin") + 20]  # the join and what follows is generated code
    df.unpersist()


def test_the_numbering_of_many_values_is_generated_code(spark):
    df = spark.range(2).selectExpr("id AS pid", *(f"IF(id = 1 AND {i} = 7, 5, 0) AS q{i}" for i in range(300))).repartition(1).cache()
    out = map_entity(df, {"entity": {"name": "Item", "fields": {"base": ["item_code"]}, "pattern": "expansion", "params": {"skip_values": [0]}}, "filters": {"participant_id_field": "pid"},
                          "mappings": [], "configs": [{"source_field": f"q{i}", "code": f"C{i}"} for i in range(300)]}).df
    assert [tuple(r) for r in out.collect()] == [("C7",)]
    step = next(x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate posexplode" in x)
    assert "*(" in step
    df.unpersist()


def test_the_wide_table_is_made_by_several_tasks(spark, monkeypatch):
    made = []
    monkeypatch.setattr(catalog, "_WIDE_ROWS", 40)
    monkeypatch.setattr(catalog, "stored", lambda df, kind: made.append(df.rdd.getNumPartitions()) or df)
    catalog.QUERIES["expand_many_configs"](spark, SF)
    assert made == [4]
