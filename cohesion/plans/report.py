"""Counters and reports as DataFrames (no driver-side loops over data).

Each report is a union of small aggregations over the (lazy) entity plans,
so it runs as a Spark job like any other output and can be written with the
results. ``EntityResult.counts()`` gives the same numbers from
``Observation`` metrics after the results have been written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def eligibility_counts(df: DataFrame, pid: str, cond: Column) -> DataFrame:
    """Participants before / after the eligibility condition (one aggregation)."""
    return df.agg(
        F.count_distinct(F.col(pid)).cast("long").alias("participants_before"),
        F.count_distinct(F.when(cond, F.col(pid))).cast("long").alias("participants_after"),
    )


def entity_summary(results: dict, pid_field: str = "submitter_participant_id") -> DataFrame:
    """Per entity: records, distinct participants, records per participant."""
    parts = []
    for name, r in results.items():
        df = r.df if hasattr(r, "df") else r
        if pid_field in df.columns:
            parts.append(df.agg(
                F.lit(name).alias("entity"),
                F.count(F.lit(1)).cast("long").alias("records"),
                F.count_distinct(F.col(pid_field)).cast("long").alias("participants"),
            ))
        else:
            parts.append(df.agg(F.lit(name).alias("entity"), F.count(F.lit(1)).cast("long").alias("records"),
                                F.lit(None).cast("long").alias("participants")))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn(
        "records_per_participant",
        F.when(F.col("participants") > 0, F.round(F.col("records") / F.col("participants"), 4)),
    )


def study_report(source: DataFrame, results: dict) -> DataFrame:
    """Input rows and, per entity: output rows, output columns, error flag."""
    n_in = source.agg(F.lit(1).alias("__k"), F.count(F.lit(1)).cast("long").alias("input_rows"))
    parts = []
    for name, r in results.items():
        parts.append(r.df.agg(
            F.lit(name).alias("entity"),
            F.count(F.lit(1)).cast("long").alias("output_rows"),
            F.lit(len(r.df.columns)).cast("long").alias("output_columns"),
            F.lit(r.error is not None).alias("failed"),
            F.lit(1).alias("__k"),
        ))
    per = reduce(lambda a, b: a.unionByName(b), parts)
    # the one-row input count joined on a constant key (a broadcast of one row)
    return per.join(F.broadcast(n_in), "__k", "left").select(
        "entity", "input_rows", "output_rows", "output_columns", "failed")
