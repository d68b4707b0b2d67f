"""All entities from one scan: the same rows as with a scan for each."""
from cohesion import map_study
from cohesion.plans import catalog
from cohesion.plans.wide import ORDER_COL, wide

SF = "/root/testdata/sf0.001"
BASE = [{"name": "b", "filter": [{"field": "kind", "op": "equals", "value": "b"}]}]


def _spec(filters, **kw):
    fields = ["pid", "kind", "v", "w"]
    return {"entity": {"name": "X", "fields": {"base": fields}}, "filters": {"participant_id_field": "pid", **filters}, "mappings": [{"source_field": c, "target_field": c} for c in fields], **kw}


SPECS = {
    "base": _spec({"rows": BASE}),
    "eligible": _spec({"rows": BASE, "participant": {"filter": [{"field": "v", "op": "greater_than", "value": 5}]}}),
    "again": _spec({"rows": BASE, "participant": {"filter": [{"field": "v", "op": "greater_than", "value": 5}]}}),
    "cleaned": _spec({"rows": [{"name": "x", "filter": [{"field": "v", "op": "less_than", "value": 8}]}], "field_filters": [{"field": "w", "op": "is_not_null"}]}, preprocessing=[{"type": "uppercase", "fields": ["w"]}]),
    "two": _spec({"rows": BASE + [{"name": "y", "filter": [{"field": "v", "op": "equals", "value": 2}]}]}),
    "first": _spec({"rows": [{"name": "f", "select": "first", "filter": [{"field": "v", "op": "is_not_null"}]}]}),
    "filled": _spec({"rows": BASE, "enrich": [{"name": "e", "source": [{"field": "v", "op": "is_not_null"}], "fields": ["w"]}]}),
    "none": _spec({"rows": [{"name": "n", "filter": [{"field": "kind", "op": "equals", "value": "zzz"}]}]}),
    "broken": _spec({"rows": [{"name": "n", "filter": [{"field": "kind", "op": "greater_than", "value": 5}]}]}),
    "all": _spec({}),
}


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_equal_to_a_scan_for_each(spark, tmp_path):
    data = [(p, k, v, w, o) for o, (p, k, v, w) in enumerate(
        [(p, k, v, w) for p in ("P1", "P2", None) for k in ("b", "r") for v in (1, 2, 7, None) for w in ("x", None)] * 2)]
    path = str(tmp_path / "source")
    spark.createDataFrame(data, "pid string, kind string, v long, w string, o long").write.parquet(path)
    source = spark.read.parquet(path)
    one, each = (map_study(source, SPECS, order_by="o", share=s) for s in ("one_scan", "none"))
    for name in SPECS:
        assert one[name].error == each[name].error, name
        assert _rows(one[name].df) == _rows(each[name].df), name
    for name in ("base", "eligible", "again", "cleaned", "two", "none"):
        assert "/source" not in one[name].df._jdf.queryExecution().executedPlan().toString(), name  # read from its own folder


def test_eight_entities_read_the_source_once(spark):
    w = wide(spark, SF)
    res = map_study(w, catalog._SCAN_SPECS, order_by=ORDER_COL, share="one_scan")
    for r in res.values():
        assert "customer.parquet" not in r.df._jdf.queryExecution().executedPlan().toString()
