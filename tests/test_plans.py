"""Plan shape: the properties that matter at scale, read from the physical plan."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_window_operators_in_any_registered_query(spark):
    for name, fn in E.queries().items():
        if name.startswith(("src_", "sink_", "join_chain", "clean_numeric_auto")):
            continue  # these write files or run small jobs while building
        plan = _plan(fn(spark, SF))
        assert "Window" not in plan, name


def test_per_participant_steps_are_partial_aggregations(spark):
    for name in ("rows_select_first", "enrich_first", "enrich_baseline_fields", "dedup_first_per_key"):
        plan = _plan(E.queries()[name](spark, SF))
        assert "partial_min_by" in plan or "partial_max_by" in plan, name


def test_baseline_filter_prunes_repeat_rows(spark):
    # the baseline row filter reaches the union: the orders scan disappears
    plan = _plan(E.queries()["filter_equals"](spark, SF))
    assert "customer.parquet" in plan
    plan = _plan(E.queries()["entity_direct"](spark, SF))
    assert "orders.parquet" not in plan


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["participant_eligibility"](spark, SF))
    assert "c_name" not in plan  # never read


def test_spec_conditions_reach_the_parquet_scan(spark):
    plan = _plan(E.queries()["map_values_lineitem"](spark, SF))
    assert "GreaterThan(l_discount,0.05)" in plan.replace(" ", "")
    plan = _plan(E.queries()["filter_in"](spark, SF))
    assert "In(o_orderstatus" in plan.replace(" ", "")


def test_entity_result_explain(spark):
    from cohesion import map_entity
    from cohesion.plans.catalog import ENTITY_DIRECT
    from cohesion.plans.wide import ORDER_COL, wide

    text = map_entity(wide(spark, SF), ENTITY_DIRECT, order_by=ORDER_COL).explain()
    assert "Physical Plan" in text and "Window" not in text
