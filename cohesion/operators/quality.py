"""Data-quality checks on the mapped table (``validations: [...]``).

Report only: rows are never dropped here. All rules of an entity are
evaluated in ONE pass, giving one row per rule:
``(entity, rule, field, bad_rows)``; a rule fails when ``bad_rows > 0``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..functions import types as TY

REPORT_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("bad_rows", T.LongType()),
])


def _c(n: str) -> Column:
    return F.expr("`" + n.replace("`", "``") + "`")


@dataclass
class Rule:
    """A rule that applies to the table: ``bad`` tells of a row by itself, ``value`` is what must not repeat."""

    rule: str
    field: str
    bad: Column | None = None
    value: Column | None = None


def rules_of(df: DataFrame, validations: list) -> list[Rule]:
    fams = {f.name: TY.family(f.dataType) for f in df.schema.fields}
    out = []
    for v in validations or []:
        if not isinstance(v, dict):
            continue
        rule, field = v.get("type"), v.get("field")
        if field not in fams:
            continue  # unknown column: ignored
        c, fam = _c(field), fams[field]
        if rule == "required":
            out.append(Rule(rule, field, bad=TY.is_missing(c, fam)))
        elif rule == "participant_id":
            out.append(Rule(rule, field, bad=~S.valid_participant_id(c, fam)))
        elif rule == "age_range":
            ok = S.valid_age(c, fam, v.get("min_age", S.VALID_AGE_MIN), v.get("max_age", S.VALID_AGE_MAX),
                             allow_none=not v.get("count_null", False))
            out.append(Rule(rule, field, bad=~ok))
        elif rule == "unique":
            out.append(Rule(rule, field, value=c))
    return out


def counts_by_rule(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(i, rows, values) of rule i: rows that are bad, or rows and distinct values (nulls are one value). One pass, whatever the number
    of rules: a row gives (i, null, hash, second hash) for each value and each fault, and equal ones are summed before the shuffle. A
    distinct count for each field instead would copy every row once for each of them. Values are told apart by 128 bits."""
    entries = []
    for i, r in enumerate(rules):
        if r.value is not None:
            entries.append(F.struct(F.lit(i).alias("i"), r.value.isNull().alias("nul"), F.xxhash64(r.value).alias("h"), F.xxhash64(F.lit(7), r.value).alias("g")))
        else:
            zero = F.lit(0).cast("long")
            entries.append(F.when(r.bad, F.struct(F.lit(i).alias("i"), F.lit(False).alias("nul"), zero.alias("h"), zero.alias("g"))))
    each = df.select(F.explode(F.array(*entries)).alias("e")).where("e is not null").select("e.*")
    return (each.groupBy("i", "nul", "h", "g").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("i").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"), F.sum(F.when(~F.col("nul"), 1).otherwise(0)).alias("known")))


def validation_report(df: DataFrame, validations: list, entity: str) -> DataFrame:
    """One pass over the mapped table -> one row per rule. A ``unique`` rule counts the rows beyond the first of each value."""
    rules = rules_of(df, validations)
    spark = df.sparkSession
    if not rules:
        return spark.createDataFrame([], REPORT_SCHEMA)
    if any(r.value is not None for r in rules):
        per = counts_by_rule(df, rules)
    else:
        sums = df.agg(*[F.count_if(r.bad).alias(f"r{i}") for i, r in enumerate(rules)])
        per = sums.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"r{i}").alias("rows"), F.lit(0).cast("long").alias("values")) for i in range(len(rules))])).alias("x")).select("x.*")
    names = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(r.rule).alias("rule"), F.lit(r.field).alias("field"), F.lit(r.value is not None).alias("beyond")) for i, r in enumerate(rules)])
    listed = spark.range(1).select(F.explode(names).alias("x")).select("x.*")  # one row for each rule
    bad = F.col("rows") - F.when(F.col("beyond"), F.col("values")).otherwise(0)
    return F.broadcast(listed).join(per, F.col("k") == F.col("i"), "left").select(
        F.lit(entity).alias("entity"), "rule", "field", F.coalesce(bad, F.lit(0)).cast("long").alias("bad_rows"))


def empty_report(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REPORT_SCHEMA)
