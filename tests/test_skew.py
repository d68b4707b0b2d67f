"""A participant holding a third of all rows: results equal a brute-force pandas run."""
import pandas as pd
from pyspark.sql import functions as F

from cohesion import map_entity


def _data(spark, n=30000):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("pid"),  # pid 0 is hot
        F.col("id").alias("ord"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise((F.col("id") % 7).cast("string")).alias("v"),
        (F.col("id") % 4).alias("kind"))
    return df, df.toPandas()


def test_first_composite_and_enrichment_under_skew(spark):
    df, pdf = _data(spark)
    spec = {"entity": {"name": "S", "fields": {"base": ["pid", "v", "kind"]}},
            "filters": {"participant_id_field": "pid",
                        "participant": {"filter": [{"field": "kind", "op": "equals", "value": 3}]},
                        "enrich": [{"name": "e", "source": [{"field": "kind", "op": "equals", "value": 2}],
                                    "fields": ["v"], "select": "last"}],
                        "rows": [{"name": "f", "filter": [{"field": "kind", "op": "in", "value": [0, 1]}],
                                  "select": "first"}]},
            "mappings": [{"source_field": c, "target_field": c} for c in ("pid", "v", "kind")]}
    got = map_entity(df, spec, order_by="ord").df.toPandas().sort_values("pid").reset_index(drop=True)

    # brute force, row by row in pandas
    pdf = pdf.sort_values("ord")
    eligible = set(pdf.loc[pdf.kind == 3, "pid"])
    p = pdf[pdf.pid.isin(eligible)].copy()
    last_v = p[(p.kind == 2) & p.v.notna()].groupby("pid").v.last()
    p["v"] = p.v.fillna(p.pid.map(last_v))
    sel = p[p.kind.isin([0, 1])].groupby("pid", as_index=False).agg(v=("v", "first"), kind=("kind", "first"))
    sel = sel.sort_values("pid").reset_index(drop=True)
    assert got.pid.tolist() == sel.pid.tolist()
    assert got.v.tolist() == sel.v.tolist()
    assert got.kind.tolist() == sel.kind.tolist()
    assert (pdf.pid == 0).mean() > 0.3
