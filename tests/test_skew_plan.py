"""Eligibility, enrichments and baseline merge: one aggregation, one join, hot ids dealt into parts."""
import pandas as pd
from pyspark.sql import functions as F

from cohesion import map_entity
from cohesion.operators import rows

KIND = lambda *v: [{"field": "kind", "op": "in", "value": list(v)}]


def _data(spark, n=30000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 101 == 1, F.lit(None)).otherwise(F.col("id") % 997).alias("pid"),
        F.col("id").alias("ord"),
        F.when(F.col("id") % 5 != 1, F.lit(None)).otherwise((F.col("id") % 7).cast("string")).alias("v"),
        F.when(F.col("id") % 3 == 2, F.lit(None)).otherwise(F.col("id") % 11).alias("w"),
        (F.abs(F.xxhash64("id")) % 4).alias("kind"))


def _spec(steps):
    return {"entity": {"name": "S", "fields": {"base": ["pid", "v", "w", "kind"]}},
            "filters": {"participant_id_field": "pid", "participant": {"filter": KIND(3)}, "enrich": steps,
                        "rows": [{"name": "baseline", "filter": KIND(0)}, {"name": "f", "filter": KIND(0, 1, 2)}]},
            "mappings": [{"source_field": c, "target_field": c} for c in ("pid", "v", "w", "kind")]}


STEPS = [{"name": "a", "source": KIND(1), "fields": ["v"], "select": "last"}, {"merge_baseline_fields": ["v", "w"]},
         {"name": "b", "source": KIND(2), "fields": ["w", "v"]}, {"name": "c", "source": KIND(0, 1, 2, 3), "fields": ["w"], "select": "last"}]


def _brute(pdf, steps):
    """The steps one after the other, each on what the one before left."""
    p = pdf.sort_values("ord").reset_index(drop=True)
    key = p.pid.map(lambda x: "null" if pd.isna(x) else int(x))
    p = p[key.isin(set(key[p.kind == 3]))].copy()
    key = key[p.index]
    for s in steps:
        base = "merge_baseline_fields" in s
        for c in s.get("merge_baseline_fields") or s["fields"]:
            at = p.kind.isin([0] if base else s["source"][0]["value"])
            values = {}
            for k, v in zip(key[at], p[c][at]):
                if base:
                    values.setdefault(k, v)
                elif not pd.isna(v) and k != "null" and (s.get("select") == "last" or k not in values):
                    values[k] = v
            p[c] = [values.get(k) if pd.isna(v) else v for k, v in zip(key, p[c])]
    p = p[p.kind.isin([0, 1, 2])]
    return {tuple(None if pd.isna(x) else str(int(float(x))) for x in r) for r in p[["pid", "v", "w", "kind"]].itertuples(index=False)}


def test_all_steps_equal_one_after_the_other(spark, monkeypatch):
    df = _data(spark)
    for part_rows in (rows.PART_ROWS, 500):
        monkeypatch.setattr(rows, "PART_ROWS", part_rows)
        got = map_entity(df, _spec(STEPS), order_by="ord").df.collect()
        assert {tuple(None if x is None else str(int(float(x))) for x in r) for r in got} == _brute(df.toPandas(), STEPS)


def test_joins_and_shuffles_do_not_grow_with_the_steps(spark):
    def shape(k):
        plan = map_entity(_data(spark), _spec(STEPS[:k]), order_by="ord").df._jdf.queryExecution().executedPlan().toString()
        return plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin"), plan.count("Exchange hashpartitioning")

    assert shape(1) == shape(2) == shape(4)


def test_hot_id_is_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(rows, "PART_ROWS", 500)
    df = _data(spark).withColumn(rows.ORD, F.col("ord"))
    hot = rows.hot_ids(rows.sized(df.groupBy(F.col("pid").alias("__pid")).agg(F.count("*").alias("__n"))))
    n = df.where("pid = 0").count()
    assert n > 10000 - 200
    assert [tuple(r) for r in hot.collect()] == [(0, -(-n // 500))]
    most = rows.salted(df, "pid", hot).groupBy("pid", "__salt").count().agg(F.max("count")).first()[0]
    assert most < 650


def test_condition_on_a_filled_field_comes_after_the_fill(spark):
    df = spark.createDataFrame([(1, 1, "x", None, 0), (1, 2, None, "t", 1), (1, 3, None, None, 3)],
                               "pid int, ord int, v string, w string, kind int")
    steps = [{"name": "a", "source": KIND(0), "fields": ["v"]},
             {"name": "b", "source": [{"field": "v", "op": "equals", "value": "x"}, *KIND(1)], "fields": ["w"]}]
    got = map_entity(df, _spec(steps), order_by="ord").df.collect()
    assert {(r.v, r.w) for r in got} == {("x", "t")}
