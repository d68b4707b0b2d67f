"""Registered queries: one per operator, each with a DuckDB oracle.

Every query reads the given tables (through ``wide``, the longitudinal table
derived from customer + orders, or the tables themselves) and applies one
spec or operator of the engine. ``ORACLE[name]`` is independent DuckDB SQL for
the same result, written from the rules, not from the engine's code.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import types as TY
from ..operators import rows as R
from ..operators.quality import validation_report
from ..session import stored
from ..sources import multifile as MF
from ..sources import readers as RD
from . import report as RP
from .engine import map_entity, map_study
from .wide import ORDER_COL, WIDE_SQL, wide

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

PID = "participant_id"
OUT_PID = {"source_field": PID, "target_field": "submitter_participant_id"}
OUT_INST = {"source_field": "instance", "target_field": "record_instance"}
IS_BASE = {"field": "repeat_kind", "op": "is_null"}
IS_ORDER = {"field": "repeat_kind", "op": "equals", "value": "order"}
BASELINE = [{"name": "baseline", "filter": [IS_BASE]}]


def q(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_wide(sql)
        return fn

    return deco


def with_wide(sql: str) -> str:
    """Prefix the wide table as a CTE (merged with the query's own WITH, if any)."""
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {WIDE_SQL},\n{body[5:]}"
    return f"WITH {WIDE_SQL}\n{body}"


def spec(fields, mappings, filters=None, **extra) -> dict:
    ent = {"name": extra.pop("name", "Record"), "fields": {"base": fields}, "pattern": extra.pop("pattern", "direct")}
    for k in ("params", "code_term_prefix"):
        if k in extra:
            ent[k] = extra.pop(k)
    out = {"entity": ent, "mappings": mappings, "filters": filters or {}}
    out.update(extra)
    return out


def run(spark: SparkSession, sf: str, sp: dict, **kw) -> DataFrame:
    return map_entity(wide(spark, sf), sp, order_by=ORDER_COL, **kw).df


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    from ..session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohesion-{tag}-{uuid.uuid4().hex[:8]}"


# ------------------------------------------------------------------ SQL helpers (DuckDB)


def sql_parse_date(x: str) -> str:
    s = f"trim({x})"
    return f"""(CASE
  WHEN regexp_matches({s}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') THEN CAST(try_strptime({s}, '%Y-%m-%d') AS DATE)
  WHEN regexp_matches({s}, '^\\d{{4}}/\\d{{1,2}}/\\d{{1,2}}$') THEN CAST(try_strptime({s}, '%Y/%m/%d') AS DATE)
  WHEN regexp_matches({s}, '^\\d{{8}}$') THEN CAST(try_strptime({s}, '%Y%m%d') AS DATE)
  WHEN regexp_matches({s}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN CAST(coalesce(try_strptime({s}, '%m/%d/%Y'), try_strptime({s}, '%d/%m/%Y')) AS DATE)
  WHEN regexp_matches({s}, '^\\d{{4}}[-/]\\d{{1,2}}$') THEN CAST(try_strptime(replace({s}, '/', '-') || '-15', '%Y-%m-%d') AS DATE)
END)"""


def sql_age_units(x: str) -> str:
    s = f"lower(trim({x}))"
    rx = "'^(\\d+\\.?\\d*)\\s*(years?|months?|weeks?|days?)$'"
    num = f"TRY_CAST(regexp_extract({s}, {rx}, 1) AS DOUBLE)"
    unit = f"regexp_extract({s}, {rx}, 2)"
    days = (f"CAST(trunc({num} * CASE WHEN starts_with({unit}, 'year') THEN 365.25 WHEN starts_with({unit}, 'month') "
            f"THEN 30.44 WHEN starts_with({unit}, 'week') THEN 7.0 ELSE 1.0 END) AS BIGINT)")
    plain = f"TRY_CAST({s} AS DOUBLE)"
    return f"""(CASE
  WHEN {plain} >= 0 AND {plain} <= 120 THEN CAST(trunc({plain} * 365.25) AS BIGINT)
  WHEN regexp_matches({s}, {rx}) AND {days} BETWEEN 0 AND 43830 THEN {days}
END)"""


def sql_age(birth: str, event: str, fallback: str | None = None, offset: str | None = None) -> str:
    b, e = sql_parse_date(birth), sql_parse_date(event)
    diff = f"(CAST(date_diff('day', {b}, {e}) AS BIGINT){' + coalesce(' + offset + ', 0)' if offset else ''})"
    fb = sql_age_units(fallback) if fallback else "CAST(NULL AS BIGINT)"
    return (f"(CASE WHEN {birth} IS NOT NULL AND {event} IS NOT NULL AND {b} IS NOT NULL AND {e} IS NOT NULL "
            f"THEN (CASE WHEN {diff} >= 0 THEN {diff} END) ELSE {fb} END)")


def sql_safe_int(x: str) -> str:
    return f"CAST(trunc(TRY_CAST(NULLIF(trim(replace({x}, ',', '')), '') AS DOUBLE)) AS BIGINT)"


BASE_SQL = "FROM wide WHERE repeat_kind IS NULL"
ALL_ROWS = {"rows": [{"name": "all", "filter": [{"field": ORDER_COL, "op": "is_not_null"}]}]}
ALL_SQL = "FROM wide"


# ------------------------------------------------------------------ 2.B predicates


def _filter_query(name: str, cond, where: str, extra_filters=None):
    sp = spec(["submitter_participant_id", "record_instance"], [OUT_PID, OUT_INST],
              {"rows": [{"name": "q", "filter": cond}], **(extra_filters or {})})

    @q(name, f"SELECT participant_id AS submitter_participant_id, instance AS record_instance FROM wide WHERE {where}")
    def _f(spark, sf, _sp=sp):
        return run(spark, sf, _sp)


_filter_query("filter_equals", [{"field": "segment", "op": "equals", "value": "BUILDING"}], "segment = 'BUILDING'")
_filter_query("filter_equals_type_strict", [{"field": "segment", "op": "equals", "value": 1}], "false")
_filter_query("filter_not_equals", [{"field": "segment", "op": "not_equals", "value": "BUILDING"}],
              "segment IS DISTINCT FROM 'BUILDING'")
_filter_query("filter_in", [{"field": "order_status", "op": "in", "value": ["F", "P"]}], "order_status IN ('F', 'P')")
_filter_query("filter_in_with_null", [{"field": "f2", "op": "in", "value": [2, None]}], "f2 = 2 OR f2 IS NULL")
_filter_query("filter_not_in", [{"field": "f2", "operator": "not_in", "value": [0, 1]}],
              "f2 IS NULL OR f2 NOT IN (0, 1)")
_filter_query("filter_is_not_null", [{"field": "f2", "op": "is_not_null"}], "f2 IS NOT NULL")
_filter_query("filter_is_null", [{"field": "f2", "op": "is_null"}], "f2 IS NULL")
_filter_query("filter_greater_than", [{"field": "total_price", "op": "greater_than", "value": 300000}],
              "total_price > 300000")
_filter_query("filter_less_than", [{"field": "acctbal", "op": "less_than", "value": 0}], "acctbal < 0")
_filter_query("filter_greater_equal", [{"field": "nation", "op": "greater_equal", "value": 20}], "nation >= 20")
_filter_query("filter_less_equal", [{"field": "event_date", "op": "less_equal", "value": "1996-01-01"}],
              "event_date <= '1996-01-01'")
_filter_query("filter_regex_match_any", [{"field": "priority", "op": "regex_match_any", "value": ["1-", "2-HI"]}],
              "regexp_matches(priority, '^(?:1-)') OR regexp_matches(priority, '^(?:2-HI)')")
_filter_query("filter_and", [{"field": "consent", "op": "equals", "value": 1},
                             {"field": "segment", "op": "in", "value": ["BUILDING", "AUTOMOBILE"]}],
              "consent = 1 AND segment IN ('BUILDING', 'AUTOMOBILE')")
_filter_query("filter_any", [{"any": [{"field": "f1", "op": "equals", "value": 1},
                                      {"field": "order_status", "op": "equals", "value": "F"}]}],
              "f1 = 1 OR order_status = 'F'")
_filter_query("filter_nested_any_all", [{"any": [
    {"all": [{"field": "f1", "op": "equals", "value": 1}, {"field": "f2", "op": "equals", "value": 2}]},
    {"all": [{"field": "order_status", "op": "equals", "value": "O"},
             {"field": "total_price", "op": "greater_than", "value": 200000}]}]}],
              "(f1 = 1 AND f2 = 2) OR (order_status = 'O' AND total_price > 200000)")
_filter_query("filter_unknown_field_passthrough", [{"field": "no_such_column", "op": "equals", "value": 1},
                                                   {"field": "f1", "op": "equals", "value": 0}], "f1 = 0")


@q("filter_field_filters", "SELECT participant_id AS submitter_participant_id, instance AS record_instance "
                           "FROM wide WHERE nation < 5")
def _ff(spark, sf):
    sp = spec(["submitter_participant_id", "record_instance"], [OUT_PID, OUT_INST],
              {"field_filters": [{"field": "nation", "op": "less_than", "value": 5}]})
    return run(spark, sf, sp)


# ------------------------------------------------------------------ 2.C row sets


@q("participant_eligibility", """SELECT participant_id AS submitter_participant_id, instance AS record_instance
FROM wide WHERE participant_id IN (SELECT participant_id FROM wide WHERE order_status = 'F' AND total_price > 250000)""")
def _elig(spark, sf):
    sp = spec(["submitter_participant_id", "record_instance"], [OUT_PID, OUT_INST],
              {"participant": {"filter": [{"field": "order_status", "op": "equals", "value": "F"},
                                          {"field": "total_price", "op": "greater_than", "value": 250000}]}})
    return run(spark, sf, sp)


@q("eligibility_missing_key", "SELECT participant_id AS submitter_participant_id, instance AS record_instance "
                              "FROM wide WHERE repeat_kind IS NULL")
def _elig_missing(spark, sf):
    sp = spec(["submitter_participant_id", "record_instance"], [OUT_PID, OUT_INST],
              {"participant_id_field": "no_such_id",
               "participant": {"filter": [{"field": "consent", "op": "equals", "value": 1}]},
               "rows": [{"name": "baseline", "filter": [IS_BASE], "select": "first"}]})
    return run(spark, sf, sp)


@q("eligibility_report", """SELECT DISTINCT participant_id FROM wide w
WHERE NOT EXISTS (SELECT 1 FROM wide e WHERE e.participant_id = w.participant_id AND e.consent = 1)""")
def _elig_report(spark, sf):
    w = wide(spark, sf)
    return R.excluded_participants(w, PID, F.coalesce(F.col("consent") == 1, F.lit(False)))


@q("eligibility_counts", """SELECT CAST(count(DISTINCT participant_id) AS BIGINT) AS participants_before,
  CAST(count(DISTINCT CASE WHEN consent = 1 THEN participant_id END) AS BIGINT) AS participants_after FROM wide""")
def _elig_counts(spark, sf):
    return RP.eligibility_counts(wide(spark, sf), PID, F.coalesce(F.col("consent") == 1, F.lit(False)))


@q("rows_union", "SELECT participant_id AS submitter_participant_id, instance AS record_instance "
                 "FROM wide WHERE repeat_kind IS NULL OR total_price > 400000")
def _rows_union(spark, sf):
    sp = spec(["submitter_participant_id", "record_instance"], [OUT_PID, OUT_INST],
              {"rows": BASELINE + [{"name": "big", "filter": [
                  {"field": "total_price", "op": "greater_than", "value": 400000}]}]})
    return run(spark, sf, sp)


@q("rows_dedup", "SELECT DISTINCT participant_id AS submitter_participant_id, order_status AS status "
                 "FROM wide WHERE order_status IN ('F', 'O')")
def _rows_dedup(spark, sf):
    sp = spec(["submitter_participant_id", "status"],
              [OUT_PID, {"source_field": "order_status", "target_field": "status"}],
              {"rows": [{"name": "f", "filter": [{"field": "order_status", "op": "equals", "value": "F"}]},
                        {"name": "fo", "filter": [{"field": "order_status", "op": "in", "value": ["F", "O"]}]}]})
    return run(spark, sf, sp, before=lambda d: d.select(PID, "repeat_kind", "order_status", R.ORD))


def _first_last(name: str, mode: str, agg: str):
    sql = f"""SELECT participant_id AS submitter_participant_id,
  {agg}(instance, row_ord) FILTER (WHERE instance IS NOT NULL) AS record_instance,
  {agg}(event_date, row_ord) FILTER (WHERE event_date IS NOT NULL) AS event_date,
  {agg}(total_price, row_ord) FILTER (WHERE total_price IS NOT NULL) AS total_price,
  CAST(NULL AS VARCHAR) AS segment
FROM wide WHERE repeat_kind = 'order' AND participant_id IS NOT NULL GROUP BY participant_id"""

    @q(name, sql)
    def _fl(spark, sf):
        sp = spec(["submitter_participant_id", "record_instance", "event_date", "total_price", "segment"],
                  [OUT_PID, OUT_INST, {"source_field": "event_date", "target_field": "event_date"},
                   {"source_field": "total_price", "target_field": "total_price"},
                   {"source_field": "segment", "target_field": "segment"}],
                  {"rows": [{"name": "o", "filter": [IS_ORDER], "select": mode}]})
        return run(spark, sf, sp)


_first_last("rows_select_first", "first", "arg_min")
_first_last("rows_select_last", "last", "arg_max")


@q("union_by_name", """SELECT CAST(n_nationkey AS DOUBLE) AS n_nationkey,
  CASE WHEN n_nationkey < 13 THEN n_name END AS n_name,
  CASE WHEN n_nationkey >= 13 THEN CAST(n_regionkey AS BIGINT) END AS n_regionkey FROM nation""")
def _ubn(spark, sf):
    n = spark.read.parquet(f"{sf}/nation.parquet")
    a = n.where("n_nationkey < 13").select("n_nationkey", "n_name")
    b = n.where("n_nationkey >= 13").select(F.col("n_nationkey").cast("double").alias("n_nationkey"),
                                             "n_regionkey")
    return MF.union_by_name([a, b])


@q("distinct_participants", "SELECT DISTINCT participant_id FROM wide")
def _distinct(spark, sf):
    return R.distinct_participants(wide(spark, sf), PID)


@q("dedup_first_per_key", """SELECT order_status, priority, r.i AS instance, r.p AS participant_id FROM (
  SELECT order_status, priority, arg_min({'i': instance, 'p': participant_id}, row_ord) AS r FROM wide GROUP BY 1, 2)""")
def _dedup_first(spark, sf):
    w = wide(spark, sf).withColumn(R.ORD, F.col(ORDER_COL))
    return R.first_row_per_key(w, ["order_status", "priority"], ["instance", PID]).drop(R.ORD)


# ------------------------------------------------------------------ 2.D joins and enrichment


def _orders_cust(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_custkey").alias(PID), F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("price"))
    # doubled keys leave unmatched rows on both sides of the whole tables
    c = spark.read.parquet(f"{sf}/customer.parquet").select(
        (F.col("c_custkey") * 2).alias(PID), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    return RD.with_order(o, 0), RD.with_order(c, 1)


_OC_SQL = """WITH o AS (SELECT o_custkey AS participant_id, o_orderkey AS order_key, o_totalprice AS price FROM orders),
c AS (SELECT c_custkey * 2 AS participant_id, c_name AS name, c_nationkey AS nation FROM customer)
SELECT coalesce(o.participant_id, c.participant_id) AS participant_id, o.order_key, o.price, c.name, c.nation
FROM o {how} JOIN c ON o.participant_id IS NOT DISTINCT FROM c.participant_id"""


def _join_query(name: str, how: str, sql_how: str):
    @q(name, None)
    def _j(spark, sf):
        o, c = _orders_cust(spark, sf)
        return MF.join_sources(o, c, [PID], how).drop(R.ORD)

    ORACLE[name] = with_wide(_OC_SQL.format(how=sql_how))


_join_query("join_left", "left", "LEFT")
_join_query("join_right", "right", "RIGHT")
_join_query("join_inner", "inner", "INNER")
_join_query("join_outer", "full_outer", "FULL OUTER")


@q("join_composite_key", """SELECT o_custkey AS participant_id, o_orderstatus AS status, o_orderkey AS order_key, c_name AS name
FROM orders JOIN customer ON o_custkey = c_custkey
 AND o_orderstatus = CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END""")
def _jck(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_custkey").alias(PID), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("order_key"))
    k = F.col("c_custkey")
    c = spark.read.parquet(f"{sf}/customer.parquet").select(
        k.alias(PID), F.when(k % 3 == 0, "F").when(k % 3 == 1, "O").otherwise("P").alias("status"),
        F.col("c_name").alias("name"))
    return MF.join_sources(o, c, [PID, "status"], "inner")


@q("join_null_keys", """WITH o AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS participant_id, o_orderkey FROM orders),
c AS (SELECT CASE WHEN c_custkey <= 3 THEN NULL ELSE c_custkey END AS participant_id, c_name FROM customer)
SELECT coalesce(o.participant_id, c.participant_id) AS participant_id, o.o_orderkey, c.c_name
FROM o LEFT JOIN c ON o.participant_id IS NOT DISTINCT FROM c.participant_id""")
def _jnull(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias(PID), "o_orderkey")
    c = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.when(F.col("c_custkey") <= 3, F.lit(None)).otherwise(F.col("c_custkey")).alias(PID), "c_name")
    return MF.join_sources(o, c, [PID], "left")


def _null_sides(spark, sf):
    """Customers and suppliers by nation, with a third of the ids missing on both sides."""
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias(PID), F.col("c_custkey").alias("customer"))
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(F.when(F.col("s_suppkey") % 3 != 0, F.col("s_suppkey") * 2).alias(PID), F.col("s_suppkey").alias("supplier"))
    return c, s


_NULL_SIDES_SQL = """c AS (SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS pid, c_custkey AS customer FROM customer),
s AS (SELECT CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey * 2 END AS pid, s_suppkey AS supplier FROM supplier),
j AS (SELECT coalesce(c.pid, s.pid) AS participant_id, customer, supplier FROM c FULL OUTER JOIN s ON c.pid IS NOT DISTINCT FROM s.pid)"""


@q("join_split_keys", f"WITH {_NULL_SIDES_SQL} SELECT participant_id, customer, supplier FROM j")
def _split_keys(spark, sf):
    c, s = _null_sides(spark, sf)
    return MF.join_sources(c, s, [PID], "full_outer", split=200)


@q("join_expected_rows", f"""WITH {_NULL_SIDES_SQL} SELECT (SELECT count(*) FROM c) AS left_rows, (SELECT count(*) FROM s) AS right_rows, count(*) AS out_rows,
(SELECT max(n) FROM (SELECT count(*) AS n FROM j GROUP BY participant_id)) AS largest_key FROM j""")
def _expected(spark, sf):
    return MF.expected_rows(*_null_sides(spark, sf), [PID], "full_outer")


@q("join_suffix", """SELECT c_custkey AS participant_id, c_name AS name, s_name AS name_secondary, n_name AS name_secondary2
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey LEFT JOIN nation ON c_custkey = n_nationkey""")
def _jsuffix(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias(PID), F.col("c_name").alias("name"))
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias(PID), F.col("s_name").alias("name"))
    n = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").cast("bigint").alias(PID),
                                                         F.col("n_name").alias("name"))
    j = MF.join_sources(RD.with_order(c, 0), s, [PID], "left")
    return MF.join_sources(j, n, [PID], "left").drop(R.ORD)


def _write_study_files(spark, sf) -> str:
    """Derived source files of a small study: orders.csv, customer.tsv, nation.txt ('|')."""
    d = scratch(spark, "study")
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_custkey").alias(PID), F.col("o_orderkey").alias("instance"), F.col("o_totalprice").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))
    c = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_custkey").alias(PID), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    n = spark.read.parquet(f"{sf}/nation.parquet").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("nation_name"), F.col("n_regionkey").alias("region"))
    o.write.mode("overwrite").option("header", True).csv(f"{d}/orders.csv")
    c.write.mode("overwrite").option("header", True).option("sep", "\t").csv(f"{d}/customer.tsv")
    n.write.mode("overwrite").option("header", True).option("sep", "|").csv(f"{d}/nation.txt")
    return d


_CHAIN_SPEC = {
    "entity": {"name": "Orders", "fields": {"base": ["submitter_participant_id", "record_instance", "segment",
                                                     "nation_name", "price"]},
               "source_files": {"primary": "orders.csv", "secondary": [
                   {"file": "customer.tsv", "join_on": PID, "join_type": "left"},
                   {"file": "nation.txt", "join_on": "nation", "join_type": "left", "columns": ["nation_name"]}]}},
    "mappings": [OUT_PID, OUT_INST, {"source_field": "segment", "target_field": "segment"},
                 {"source_field": "nation_name", "target_field": "nation_name"},
                 {"source_field": "price", "target_field": "price"}],
}


@q("join_chain", """SELECT o_custkey AS submitter_participant_id, o_orderkey AS record_instance, c_mktsegment AS segment,
  n_name AS nation_name, o_totalprice AS price
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def _jchain(spark, sf):
    d = _write_study_files(spark, sf)
    return map_study(None, {"orders": _CHAIN_SPEC}, source_dir=d)["orders"].df


@q("join_pruned_columns", """SELECT c_custkey AS participant_id, c_nationkey AS nation, n_name AS nation_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def _jpruned(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias(PID),
                                                           F.col("c_nationkey").alias("nation"))
    n = spark.read.parquet(f"{sf}/nation.parquet").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("nation_name"), F.col("n_regionkey").alias("r"),
        F.col("n_name").alias("unused"))
    return MF.join_sources(c, n, ["nation"], "left", columns=["nation_name"]).drop(R.ORD)


def _enrich_query(name: str, mode: str, agg: str):
    @q(name, f"""WITH e AS (SELECT participant_id,
    {agg}(event_date, row_ord) FILTER (WHERE event_date IS NOT NULL) AS ev,
    {agg}(order_status, row_ord) FILTER (WHERE order_status IS NOT NULL) AS st
  FROM wide WHERE repeat_kind = 'order' AND participant_id IS NOT NULL GROUP BY 1)
SELECT w.participant_id AS submitter_participant_id, coalesce(w.event_date, e.ev) AS event_date,
       coalesce(w.order_status, e.st) AS order_status
FROM wide w LEFT JOIN e ON w.participant_id = e.participant_id WHERE w.repeat_kind IS NULL""")
    def _e(spark, sf):
        sp = spec(["submitter_participant_id", "event_date", "order_status"],
                  [OUT_PID, {"source_field": "event_date", "target_field": "event_date"},
                   {"source_field": "order_status", "target_field": "order_status"}],
                  {"enrich": [{"name": "orders", "source": [IS_ORDER], "fields": ["event_date", "order_status"],
                               "select": mode}], "rows": BASELINE})
        return run(spark, sf, sp)


_enrich_query("enrich_first", "first", "arg_min")
_enrich_query("enrich_last", "last", "arg_max")


@q("enrich_all_rows", """WITH f AS (SELECT participant_id, arg_min(segment, row_ord) FILTER (WHERE segment IS NOT NULL) AS seg, arg_min(nation, row_ord) FILTER (WHERE nation IS NOT NULL) AS nat,
    arg_max(event_date, row_ord) FILTER (WHERE event_date IS NOT NULL AND order_status = 'F') AS ev FROM wide WHERE participant_id IS NOT NULL GROUP BY 1)
SELECT w.participant_id AS submitter_participant_id, w.instance AS record_instance, coalesce(w.segment, f.seg) AS segment, coalesce(w.nation, f.nat) AS nation, coalesce(w.event_date, f.ev) AS event_date
FROM wide w LEFT JOIN f ON w.participant_id = f.participant_id""")
def _enrich_all(spark, sf):
    return run(spark, sf, spec(["submitter_participant_id", "record_instance", "segment", "nation", "event_date"], [OUT_PID, OUT_INST, _pick("segment"), _pick("nation"), _pick("event_date")],
                               {"enrich": [{"name": "base", "source": [IS_BASE], "fields": ["segment", "nation"], "select": "first"},
                                           {"name": "last_done", "source": [{"field": "order_status", "op": "equals", "value": "F"}], "fields": ["event_date"], "select": "last"}], **ALL_ROWS}))


def _pick(field: str) -> dict:
    return {"source_field": field, "target_field": field}


@q("enrich_baseline_fields", f"""WITH b AS (SELECT participant_id, arg_min(dob, row_ord) AS dob, arg_min(segment, row_ord) AS segment
  FROM wide WHERE repeat_kind IS NULL GROUP BY 1),
x AS (SELECT w.participant_id, w.instance, coalesce(w.dob, b.dob) AS dob, coalesce(w.segment, b.segment) AS segment,
        coalesce(w.event_date, w.enroll_date) AS ev
      FROM wide w LEFT JOIN b ON w.participant_id IS NOT DISTINCT FROM b.participant_id)
SELECT participant_id AS submitter_participant_id, instance AS record_instance, dob, segment,
  {sql_age('dob', 'ev')} AS age_at_event FROM x""")
def _enrich_base(spark, sf):
    sp = spec(["submitter_participant_id", "record_instance", "dob", "segment", "age_at_event"],
              [OUT_PID, OUT_INST, {"source_field": "dob", "target_field": "dob"},
               {"source_field": "segment", "target_field": "segment"},
               {"target_field": "age_at_event", "target_type": "age",
                "params": {"birth_date_field": "dob", "event_date_field": "ev"}}],
              {"enrich": {"merge_baseline_fields": ["dob", "segment"]},
               "rows": BASELINE + [{"name": "orders", "filter": [IS_ORDER]}]},
              preprocessing=[{"type": "calculate_field", "target": "ev", "formula": "event_date.fillna(enroll_date)"}])
    return run(spark, sf, sp)


# ------------------------------------------------------------------ 2.E cleaning


def _base_query(name: str, fields, mappings, sql_cols: str, pre=None, post=None, filters=None, sql_from=ALL_SQL,
                **kw):
    @q(name, f"SELECT participant_id AS submitter_participant_id, {sql_cols} {sql_from}")
    def _b(spark, sf):
        sp = spec(["submitter_participant_id"] + fields, [OUT_PID] + mappings,
                  filters if filters is not None else ALL_ROWS,
                  preprocessing=pre or [], post_processing=post or [], **kw)
        return run(spark, sf, sp)


def _copy(src, tgt=None):
    return {"source_field": src, "target_field": tgt or src}


_base_query("clean_numeric", ["amount"], [_copy("amount_text", "amount")],
            "TRY_CAST(replace(replace(amount_text, ',', ''), ' ', '') AS DOUBLE) AS amount",
            pre=[{"type": "clean_numeric", "fields": ["amount_text"]}])
_base_query("clean_numeric_wildcard", ["amount", "acctbal"], [_copy("amount_text", "amount"), _copy("acctbal")],
            "TRY_CAST(replace(amount_text, ',', '') AS DOUBLE) AS amount, acctbal",
            pre=[{"type": "clean_numeric", "fields": ["amount_*", "acct?al"]}])
_base_query("clean_numeric_auto", ["y_text", "m_text", "amount_text"],
            [_copy("y_text"), _copy("m_text"), _copy("amount_text")],
            "TRY_CAST(replace(y_text, ',', '') AS DOUBLE) AS y_text, TRY_CAST(m_text AS DOUBLE) AS m_text, "
            "TRY_CAST(replace(replace(amount_text, ',', ''), ' ', '') AS DOUBLE) AS amount_text",
            pre=[{"type": "clean_numeric", "fields": "auto"}])
_base_query("strip_whitespace", ["segment_padded"], [_copy("segment_padded")],
            "trim(segment_padded, ' ' || chr(9)) AS segment_padded",
            pre=[{"type": "strip_whitespace", "fields": ["segment_padded"]}])
_base_query("uppercase", ["kind", "age_text"], [_copy("repeat_kind", "kind"), _copy("age_text")],
            "upper(repeat_kind) AS kind, upper(age_text) AS age_text",
            pre=[{"type": "uppercase", "fields": ["repeat_kind", "age_text"]}],
            filters={"rows": [{"name": "all", "filter": [{"field": PID, "op": "is_not_null"}]}]},
            sql_from="FROM wide")
_base_query("lowercase", ["segment"], [_copy("segment")], "lower(segment) AS segment",
            pre=[{"type": "lowercase", "fields": ["segment"]}])
_base_query("replace_missing_codes", ["f3"], [_copy("f3")],
            "CASE WHEN f3 IN (-1, 0) THEN NULL ELSE CAST(f3 AS DOUBLE) END AS f3",
            pre=[{"type": "replace_missing_codes", "codes": [-1, 0], "fields": ["f3"]}])
_base_query("replace_missing_codes_map", ["f3", "age_text"], [_copy("f3"), _copy("age_text")],
            "CASE WHEN f3 = -1 THEN 99.0 ELSE CAST(f3 AS DOUBLE) END AS f3, "
            "CASE WHEN age_text = 'unknown' THEN 0.0 ELSE TRY_CAST(age_text AS DOUBLE) END AS age_text",
            pre=[{"type": "replace_missing_codes", "codes": {-1: 99, "unknown": 0}, "fields": ["f3", "age_text"]}])
_base_query("convert_to_numeric", ["m_text", "amount_text"], [_copy("m_text"), _copy("amount_text")],
            "TRY_CAST(m_text AS DOUBLE) AS m_text, TRY_CAST(amount_text AS DOUBLE) AS amount_text",
            pre=[{"type": "convert_to_numeric", "fields": ["m_text", "amount_text"]}])
_base_query("calculate_field_arith", ["calc", "ratio"], [_copy("calc"), _copy("ratio")],
            "(acctbal * 2 + CAST(nation // 3 AS DOUBLE)) - CAST(((f3 % 4) + 4) % 4 AS DOUBLE) AS calc, "
            "acctbal / CAST(f3 + 2 AS DOUBLE) AS ratio",
            pre=[{"type": "calculate_field", "target": "calc", "formula": "acctbal * 2 + nation // 3 - f3 % 4"},
                 {"type": "calculate_field", "target": "ratio", "formula": "acctbal / (f3 + 2)"}])
_base_query("calculate_field_bool", ["flag"], [_copy("flag")],
            "coalesce((acctbal > 5000 AND f1 = 1) OR nation < 3, false) AS flag",
            pre=[{"type": "calculate_field", "target": "flag", "formula": "(acctbal > 5000) & (f1 == 1) | (nation < 3)"}])
_base_query("calculate_field_fillna", ["calc"], [_copy("calc")], "coalesce(f2, -1) * 10 AS calc",
            pre=[{"type": "calculate_field", "target": "calc", "formula": "f2.fillna(-1) * 10"}])


def _sql_construct(day: str | None, default_day: int) -> str:
    y, m = sql_safe_int("y_text"), sql_safe_int("m_text")
    d = f"coalesce({sql_safe_int(day)}, NULL)" if day else str(default_day)
    dd = f"(CASE WHEN {day} IS NULL THEN {default_day} ELSE {sql_safe_int(day)} END)" if day else str(default_day)
    return (f"CASE WHEN {y} IS NOT NULL AND {y} <> 0 AND {m} BETWEEN 1 AND 12 AND {dd} BETWEEN 1 AND 31 THEN "
            f"CAST({y} AS VARCHAR) || '-' || lpad(CAST({m} AS VARCHAR), 2, '0') || '-' || "
            f"lpad(CAST({dd} AS VARCHAR), 2, '0') END")


_base_query("construct_date", ["built_date"], [_copy("built_date")],
            _sql_construct("d_text", 15) + " AS built_date",
            pre=[{"type": "construct_date", "target": "built_date",
                  "params": {"year_field": "y_text", "month_field": "m_text", "day_field": "d_text"}}])
_base_query("construct_date_default_day", ["built_date"], [_copy("built_date")],
            _sql_construct(None, 1) + " AS built_date",
            pre=[{"type": "construct_date", "target": "built_date",
                  "params": {"year_field": "y_text", "month_field": "m_text", "default_day": 1}}])


@q("safe_int", f"SELECT participant_id, coalesce({sql_safe_int('amount_text')}, 0) AS amount_int, "
               f"{sql_safe_int('y_text')} AS year_int {ALL_SQL}")
def _safe_int(spark, sf):
    w = wide(spark, sf)
    return w.select(PID, S.safe_int(F.col("amount_text"), TY.STRING, 0).alias("amount_int"),
                    S.safe_int(F.col("y_text")).alias("year_int"))


# ------------------------------------------------------------------ 2.F field mappings

_base_query("map_declared_nulls", ["extra_a", "extra_b"], [],
            "CAST(NULL AS VARCHAR) AS extra_a, CAST(NULL AS VARCHAR) AS extra_b")
_base_query("map_direct", ["flag", "seg"], [_copy("f1", "flag"), _copy("f2", "flag"), _copy("segment", "seg")],
            "coalesce(f2, f1) AS flag, segment AS seg")
_base_query("map_constant", ["study_id", "seg"],
            [{"source_field": None, "target_field": "study_id", "default_value": "STUDY"}, _copy("segment", "seg"),
             {"source_field": "null", "target_field": "seg", "default_value": None}],
            "'STUDY' AS study_id, CAST(NULL AS VARCHAR) AS seg")
_base_query("map_list_constant", ["tags", "t1", "t2"],
            [{"target_field": "tags", "default_value": ["a", "b", "c"]},
             {"target_field": ["t1", "t2"], "default_value": ["x", "y"]}],
            "'a|b|c' AS tags, 'x' AS t1, 'y' AS t2")
_base_query("map_default_on_null", ["f2_or", "other"],
            [{"source_field": "f2", "target_field": "f2_or", "default_value": "missing"},
             {"source_field": "no_such_column", "target_field": "other", "default_value": 5}],
            "coalesce(CAST(f2 AS VARCHAR), 'missing') AS f2_or, CAST(5 AS BIGINT) AS other")
_base_query("map_values_text", ["seg_code"],
            [{"source_field": "segment", "target_field": "seg_code",
              "value_mappings": {"BUILDING": "B", "MACHINERY": "M"}}],
            "CASE segment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' END AS seg_code")
_base_query("map_values_numeric_code", ["f3_code", "f2_code"],
            [{"source_field": "f3", "target_field": "f3_code",
              "value_mappings": {0: "zero", 1: "one", -1: "neg", 2: ""}},
             {"source_field": "f2", "target_field": "f2_code", "value_mappings": {1: "one"}, "default_value": "dflt"}],
            "CASE f3 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' WHEN -1 THEN 'neg' END AS f3_code, "
            "CASE WHEN f2 IS NULL THEN 'dflt' WHEN f2 = 1 THEN 'one' END AS f2_code")
_base_query("map_multi_target", ["seg_code", "seg_text"],
            [{"source_field": "segment", "target_field": ["seg_code", "seg_text"],
              "value_mappings": {"BUILDING": ["B01", "Building"], "HOUSEHOLD": "H01"}}],
            "CASE segment WHEN 'BUILDING' THEN 'B01' WHEN 'HOUSEHOLD' THEN 'H01' END AS seg_code, "
            "CASE segment WHEN 'BUILDING' THEN 'Building' END AS seg_text")
_base_query("map_radio", ["answer"],
            [{"source_field": "f3", "target_field": "answer", "source_type": "radio",
              "value_mappings": {1: "yes", 0: "no"}}],
            "CASE f3 WHEN 1 THEN 'yes' WHEN 0 THEN 'no' END AS answer")
_SEG_A = "CASE segment WHEN 'BUILDING' THEN 'bld' WHEN 'MACHINERY' THEN 'mach' WHEN 'AUTOMOBILE' THEN 'auto' END"
_base_query("map_note_append", ["seg_note"],
            [{"source_field": "segment", "target_field": "seg_note",
              "value_mappings": {"BUILDING": "bld", "MACHINERY": "mach", "AUTOMOBILE": "auto"}},
             {"source_field": "f1", "target_field": "seg_note", "value_mappings": {1: "odd", 0: "even"}},
             {"source_field": "f1", "target_field": "seg_note", "value_mappings": {1: "odd"}},
             {"source_field": "segment", "target_field": "seg_note", "value_mappings": {"BUILDING": "odd"}}],
            f"CASE WHEN segment = 'BUILDING' AND f1 = 0 THEN 'bld|even|odd' "
            f"ELSE NULLIF(concat_ws('|', {_SEG_A}, CASE f1 WHEN 1 THEN 'odd' WHEN 0 THEN 'even' END), '') END AS seg_note")
_base_query("map_checkbox_append", ["flags"],
            [{"target_field": "flags", "source_type": "checkbox",
              "value_mappings": {"f1": "one", "f2": "two", "consent": "consented"}}],
            "NULLIF(concat_ws('|', CASE WHEN f1 = 1 THEN 'one' END, CASE WHEN f2 = 1 THEN 'two' END, "
            "CASE WHEN consent = 1 THEN 'consented' END), '') AS flags")
_base_query("map_checkbox_last", ["flags"],
            [{"target_field": "flags", "source_type": "checkbox", "append": False,
              "value_mappings": {"f1": "one", "f2": "two", "consent": "consented"}}],
            "coalesce(CASE WHEN consent = 1 THEN 'consented' END, CASE WHEN f2 = 1 THEN 'two' END, "
            "CASE WHEN f1 = 1 THEN 'one' END) AS flags")
_base_query("map_checkbox_multi_target", ["code", "term"],
            [{"target_field": ["code", "term"], "source_type": "checkbox",
              "value_mappings": {"f1": ["C1", "T1"], "f2": ["C2", "T2"]}}],
            "NULLIF(concat_ws('|', CASE WHEN f1 = 1 THEN 'C1' END, CASE WHEN f2 = 1 THEN 'C2' END), '') AS code, "
            "NULLIF(concat_ws('|', CASE WHEN f1 = 1 THEN 'T1' END, CASE WHEN f2 = 1 THEN 'T2' END), '') AS term")
_base_query("map_identifier", ["visit_id"],
            [{"target_field": "visit_id", "target_type": "identifier",
              "params": {"prefix_field": PID, "type": "visit", "suffix_fields": ["instance"]}}],
            "CAST(participant_id AS VARCHAR) || '_visit' || coalesce('_' || CAST(instance AS VARCHAR), '') AS visit_id",
            filters=ALL_ROWS, sql_from=ALL_SQL)
_base_query("map_identifier_suffix", ["obs_id", "no_prefix_id", "no_type_id"],
            [{"source_field": PID, "target_field": "obs_id", "target_type": "identifier",
              "params": {"record_prefix_field": PID, "record_type": "obs",
                         "suffix_fields": ["source_field_name", "literal:X", "segment", "no_such_col", "f2"]}},
             {"target_field": "no_prefix_id", "target_type": "identifier",
              "params": {"type": "obs", "suffix_fields": ["literal:A"]}},
             {"target_field": "no_type_id", "target_type": "identifier", "params": {"prefix_field": PID}}],
            "CAST(participant_id AS VARCHAR) || '_obs_' || concat_ws('_', 'participant_id', 'X', segment, "
            "'no_such_col', CAST(f2 AS VARCHAR)) AS obs_id, 'obs_A' AS no_prefix_id, "
            "CAST(NULL AS VARCHAR) AS no_type_id")
_base_query("map_age", ["age_at_enrollment"],
            [{"target_field": "age_at_enrollment", "target_type": "age",
              "params": {"birth_date_field": "dob", "event_date_field": "enroll_date"}}],
            sql_age("dob", "enroll_date") + " AS age_at_enrollment")
_base_query("map_age_offset", ["age_at_enrollment"],
            [{"target_field": "age_at_enrollment", "target_type": "age",
              "params": {"birth_date_field": "dob", "event_date_field": "enroll_date", "event_offset_field": "f3"}}],
            sql_age("dob", "enroll_date", offset="f3") + " AS age_at_enrollment")
_base_query("map_age_fallback", ["age_a", "age_b"],
            [{"target_field": "age_a", "target_type": "age",
              "params": {"birth_date_field": "dob", "event_date_field": "event_date", "age_fallback_field": "age_text"}},
             {"target_field": "age_b", "target_type": "age",
              "params": {"birth_date_field": "dob_mixed", "event_date_field": "enroll_date",
                         "age_fallback_field": "age_text"}}],
            sql_age("dob", "event_date", fallback="age_text") + " AS age_a, "
            + sql_age("dob_mixed", "enroll_date", fallback="age_text") + " AS age_b",
            filters=ALL_ROWS, sql_from=ALL_SQL)
_base_query("map_date", ["dob_iso", "d2"],
            [{"source_field": "dob_mixed", "target_field": "dob_iso", "target_type": "date"},
             _copy("enroll_date", "d2"), {"source_field": "age_text", "target_field": "d2", "target_type": "date"}],
            f"strftime({sql_parse_date('dob_mixed')}, '%Y-%m-%d') AS dob_iso, CAST(NULL AS VARCHAR) AS d2")
_base_query("map_duration", ["duration_days", "negative_duration"],
            [{"target_field": "duration_days", "target_type": "duration",
              "params": {"start_date_field": "dob", "end_date_field": "enroll_date"}},
             {"target_field": "negative_duration", "target_type": "duration",
              "params": {"start_date_field": "enroll_date", "end_date_field": "dob"}}],
            "CAST(date_diff('day', CAST(dob AS DATE), CAST(enroll_date AS DATE)) AS BIGINT) AS duration_days, "
            "CAST(NULL AS BIGINT) AS negative_duration")
_base_query("map_note", ["summary_note"],
            [{"source_field": ["segment", "f3", "nation"], "target_field": "summary_note", "target_type": "note"},
             {"source_field": ["f2"], "target_field": "summary_note", "target_type": "note"}],
            "NULLIF(concat_ws(' | ', NULLIF(concat_ws('; ', 'segment: ' || segment, CASE WHEN f3 <> -1 THEN 'f3: ' || CAST(f3 AS VARCHAR) END, "
            "'nation: ' || CAST(nation AS VARCHAR)), ''), 'f2: ' || CAST(f2 AS VARCHAR)), '') AS summary_note")
_base_query("map_integer", ["balance_int"],
            [{"source_field": "acctbal", "target_field": "balance_int", "target_type": "integer", "default_value": 0}],
            "coalesce(CAST(trunc(acctbal) AS BIGINT), 0) AS balance_int", filters=ALL_ROWS, sql_from=ALL_SQL)
_base_query("map_integer_mapped", ["month_int"],
            [{"source_field": "m_text", "target_field": "month_int", "target_type": "integer",
              "value_mappings": {1: 100, 2: None, "0": 7}, "default_value": -1}],
            "CAST(CASE WHEN m_text IS NULL THEN -1 WHEN TRY_CAST(m_text AS DOUBLE) = 1 THEN 100 "
            "WHEN TRY_CAST(m_text AS DOUBLE) = 2 THEN -1 ELSE trunc(TRY_CAST(m_text AS DOUBLE)) END AS BIGINT) "
            "AS month_int", filters=ALL_ROWS, sql_from=ALL_SQL)

ENTITY_DIRECT = {
    "entity": {"name": "Demographic", "fields": {
        "base": ["submitter_participant_id", "submitter_demographic_id", "age_at_enrollment", "segment_code"],
        "extension": ["vital_status", "enrollment_date"]}, "pattern": "direct"},
    "filters": {"participant_id_field": PID,
                "participant": {"filter": [{"field": "consent", "op": "equals", "value": 1},
                                           {"any": [{"field": "segment", "op": "in", "value": ["BUILDING", "AUTOMOBILE"]},
                                                    {"field": "nation", "op": "less_than", "value": 10}]}]},
                "rows": BASELINE},
    "mappings": [OUT_PID,
                 {"target_field": "submitter_demographic_id", "target_type": "identifier",
                  "params": {"prefix_field": PID, "type": "demographic"}},
                 {"source_field": "age_text", "target_field": "age_at_enrollment", "target_type": "age",
                  "params": {"birth_date_field": "dob", "event_date_field": "enroll_date",
                             "age_fallback_field": "age_text"}},
                 {"source_field": "segment", "target_field": "segment_code",
                  "value_mappings": {"BUILDING": "SEG:01", "AUTOMOBILE": "SEG:02", "MACHINERY": "SEG:03"}},
                 {"target_field": "vital_status", "default_value": "Alive"},
                 {"source_field": "enroll_date", "target_field": "enrollment_date", "target_type": "date"}],
    "post_processing": [{"type": "convert_nullable_int", "columns": "auto"}],
    "validations": [{"type": "required", "field": "submitter_participant_id"}],
}
_ENTITY_DIRECT_SQL = f"""SELECT participant_id AS submitter_participant_id,
  CAST(participant_id AS VARCHAR) || '_demographic' AS submitter_demographic_id,
  {sql_age('dob', 'enroll_date', fallback='age_text')} AS age_at_enrollment,
  CASE segment WHEN 'BUILDING' THEN 'SEG:01' WHEN 'AUTOMOBILE' THEN 'SEG:02' WHEN 'MACHINERY' THEN 'SEG:03' END AS segment_code,
  'Alive' AS vital_status, enroll_date AS enrollment_date
FROM wide WHERE repeat_kind IS NULL AND participant_id IN (SELECT participant_id FROM wide
  WHERE consent = 1 AND (segment IN ('BUILDING', 'AUTOMOBILE') OR nation < 10))"""


@q("entity_direct", _ENTITY_DIRECT_SQL)
def _entity_direct(spark, sf):
    return run(spark, sf, ENTITY_DIRECT)


# ------------------------------------------------------------------ 2.G scalar functions


def _fn_query(name: str, build, sql_cols: str, sql_from: str = ALL_SQL):
    @q(name, f"SELECT participant_id, {sql_cols} {sql_from}")
    def _fq(spark, sf):
        w = wide(spark, sf)
        return w.select(PID, *build(F.col))


_SLASH_MONTH = "replace(substr(enroll_date, 1, 7), '-', '/')"
_fn_query("parse_date", lambda c: [S.parse_date(c("dob_mixed")).alias("dob_date")],
          f"{sql_parse_date('dob_mixed')} AS dob_date")
_fn_query("parse_partial_date", lambda c: [
    S.parse_date(F.substring(c("enroll_date"), 1, 7)).alias("mid_month"),
    S.parse_date(F.regexp_replace(F.substring(c("enroll_date"), 1, 7), "-", "/")).alias("mid_month_slash")],
          f"{sql_parse_date('substr(enroll_date, 1, 7)')} AS mid_month, "
          f"{sql_parse_date(_SLASH_MONTH)} AS mid_month_slash")
_fn_query("age_in_days", lambda c: [S.age_in_days((c("dob"), TY.STRING), (c("enroll_date"), TY.STRING)).alias("age")],
          f"{sql_age('dob', 'enroll_date')} AS age")
_fn_query("age_with_units", lambda c: [S.age_with_units(c("age_text"), TY.STRING).alias("age_days")],
          f"{sql_age_units('age_text')} AS age_days")
_fn_query("duration_in_days", lambda c: [
    S.duration_in_days((c("dob"), TY.STRING), (c("enroll_date"), TY.STRING)).alias("days")],
          "CAST(date_diff('day', CAST(dob AS DATE), CAST(enroll_date AS DATE)) AS BIGINT) AS days")
_fn_query("format_date", lambda c: [S.format_date(c("dob_mixed")).alias("iso")],
          f"strftime({sql_parse_date('dob_mixed')}, '%Y-%m-%d') AS iso")


# ------------------------------------------------------------------ 2.H expansion


def xspec(fields, mappings, configs, filters=None, **kw) -> dict:
    f = {"participant_id_field": PID, **ALL_ROWS}
    f.update(filters or {})
    return spec(["submitter_participant_id"] + fields, [OUT_PID] + mappings, f, pattern="expansion",
                name=kw.pop("name", "Item"), configs=configs, **kw)


def _x_query(name: str, sp: dict, sql: str, **kw):
    @q(name, sql)
    def _xq(spark, sf):
        return run(spark, sf, sp, **kw)


ITEM_ID = {"target_field": "submitter_item_id", "target_type": "identifier",
           "params": {"prefix_field": PID, "type": "item", "suffix_fields": ["source_field_name"]}}
EXPAND_CHECKBOX = xspec(["item_code", "item_term", "item_source_text", "submitter_item_id"], [ITEM_ID], [
    {"source_field": "f1", "code": "C:F1", "term": "Flag one", "source_label": "F1"},
    {"source_field": "f2", "code": "C:F2", "term": "Flag two", "source_label": "F2"}])
_EXPAND_CHECKBOX_SQL = """SELECT participant_id AS submitter_participant_id, 'C:F1' AS item_code, 'Flag one' AS item_term,
  'F1' AS item_source_text, CAST(participant_id AS VARCHAR) || '_item_f1' AS submitter_item_id
FROM wide WHERE f1 IS NOT NULL AND f1 <> 0
UNION ALL
SELECT participant_id, 'C:F2', 'Flag two', 'F2', CAST(participant_id AS VARCHAR) || '_item_f2'
FROM wide WHERE f2 IS NOT NULL AND f2 <> 0"""
_x_query("expand_checkbox", EXPAND_CHECKBOX, _EXPAND_CHECKBOX_SQL)
_x_query("expand_skip_values",
         xspec(["item_code"], [], [{"source_field": "f3", "code": "C:F3"}, {"source_field": "f2", "code": "C:F2"}],
               params={"skip_values": [0, -1]}),
         """SELECT participant_id AS submitter_participant_id, 'C:F3' AS item_code FROM wide
WHERE f3 IS NOT NULL AND f3 NOT IN (0, -1)
UNION ALL SELECT participant_id, 'C:F2' FROM wide WHERE f2 IS NOT NULL AND f2 NOT IN (0, -1)""")
_x_query("expand_text_radio",
         xspec(["record_instance", "item_code", "status_label"],
               [OUT_INST, {"target_field": "status_label", "source_type": "radio",
                           "value_mappings": {"F": "Finished", "O": "Open"}}],
               [{"source_field": "order_status", "code": "C:STATUS"}],
               {"rows": [{"name": "orders", "filter": [IS_ORDER]}]}, params={"skip_values": ["P", 0]}),
         """SELECT participant_id AS submitter_participant_id, instance AS record_instance, 'C:STATUS' AS item_code,
  CASE order_status WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' END AS status_label
FROM wide WHERE repeat_kind = 'order' AND order_status IS NOT NULL AND order_status <> 'P'""")
_x_query("expand_null_key", xspec(["item_code"], [], [{"source_field": "f1", "code": "C:F1"}]),
         """SELECT participant_id AS submitter_participant_id, 'C:F1' AS item_code FROM wide
WHERE participant_id % 4 <> 0 AND f1 = 1""",
         before=lambda d: d.withColumn(PID, F.when(F.col(PID) % 4 == 0, F.lit(None)).otherwise(F.col(PID))))
_x_query("expand_code_term", xspec(["item_code"], [], [{"source_field": "f1", "code": "C:F1", "term": "not declared"}]),
         "SELECT participant_id AS submitter_participant_id, 'C:F1' AS item_code "
         "FROM wide WHERE f1 = 1")
_x_query("expand_code_prefix",
         xspec(["drug_code", "drug_term"], [], [{"source_field": "f1", "code": "RX:1", "term": "one"}],
               code_term_prefix="drug"),
         "SELECT participant_id AS submitter_participant_id, 'RX:1' AS drug_code, 'one' AS drug_term "
         "FROM wide WHERE f1 = 1")
_x_query("expand_default_source",
         xspec(["raw_value", "src_id"],
               [{"target_field": "raw_value"},
                {"target_field": "src_id", "target_type": "identifier",
                 "params": {"type": "x", "suffix_fields": ["source_field_name"]}}],
               [{"source_field": "f3"}, {"source_field": "segment"}]),
         """SELECT participant_id AS submitter_participant_id, CAST(f3 AS VARCHAR) AS raw_value, 'x_f3' AS src_id
FROM wide WHERE f3 IS NOT NULL AND f3 <> 0
UNION ALL SELECT participant_id, segment, 'x_segment' FROM wide WHERE segment IS NOT NULL""")
_x_query("expand_enrichment",
         xspec(["item_code", "detail", "amount", "f2_value"], [], [
             {"source_field": "f1", "code": "C:F1", "enrichments": [{"target_field": "detail", "source_field": "segment"}]},
             {"source_field": "f2", "code": "C:F2", "enrichments": [
                 {"target_field": "detail", "default_value": "f2-set"},
                 {"target_field": "amount", "source_field": "acctbal"},
                 {"target_field": "f2_value"}]}]),
         """SELECT participant_id AS submitter_participant_id, 'C:F1' AS item_code, segment AS detail,
  CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS BIGINT) AS f2_value FROM wide WHERE f1 = 1
UNION ALL SELECT participant_id, 'C:F2', 'f2-set', acctbal, f2 FROM wide
WHERE f2 IS NOT NULL AND f2 <> 0""")
_x_query("expand_create_records",
         xspec(["item_code", "sub_code", "note_x"], [], [
             {"source_field": "consent", "code": "C:CONSENT", "enrichments": [
                 {"target_field": "sub_code", "source_type": "checkbox", "create_records": True,
                  "value_mappings": {"f1": "A", "f2": "B"}},
                 {"target_field": "note_x", "default_value": "after"}]}]),
         """WITH b AS (SELECT * FROM wide WHERE consent IS NOT NULL AND consent <> 0)
SELECT participant_id AS submitter_participant_id, 'C:CONSENT' AS item_code, 'A' AS sub_code, 'after' AS note_x FROM b WHERE f1 = 1
UNION ALL SELECT participant_id, 'C:CONSENT', 'B', 'after' FROM b WHERE f2 = 1
UNION ALL SELECT participant_id, 'C:CONSENT', NULL, 'after' FROM b WHERE f1 IS DISTINCT FROM 1 AND f2 IS DISTINCT FROM 1""")
_x_query("expand_range",
         xspec(["item_code", "item_term"], [], [
             {"type": "range", "start": 1, "end": 3,
              "template": {"source_field": "f{n}", "code": "CODE:{n:02d}", "term": "flag {n}"}}]),
         """SELECT participant_id AS submitter_participant_id, 'CODE:01' AS item_code, 'flag 1' AS item_term
FROM wide WHERE f1 IS NOT NULL AND f1 <> 0
UNION ALL SELECT participant_id, 'CODE:02', 'flag 2' FROM wide WHERE f2 IS NOT NULL AND f2 <> 0
UNION ALL SELECT participant_id, 'CODE:03', 'flag 3' FROM wide WHERE f3 IS NOT NULL AND f3 <> 0""")

# thousands of configs over as many columns: seldom set, with codes, literals and enrichments of their own
_MANY = 3000
#: Rows of such a table that one task makes.
_WIDE_ROWS = 10_000
_MANY_SPEC = xspec(["item_code", "item_term", "level", "score", "parity", "submitter_item_id"], [ITEM_ID], [
    {"type": "range", "start": 0, "end": _MANY - 1, "template": {
        "source_field": "q{n}", "code": "CODE:{n:04d}", "term": "Item {n}", "enrichments": [
            {"target_field": "level", "default_value": "L{n}"}, {"target_field": "score"}]}}]
    + [{"source_field": "q1", "code": "AGAIN", "enrichments": [{"target_field": "parity", "value_mappings": {1: "odd", 2: "even"}}]}])


@q("expand_many_configs", f"""WITH v AS (SELECT c_custkey AS pid, i, CASE WHEN (c_custkey * 31 + i * 17) % 1009 = 0 THEN 1 + (c_custkey + i) % 2 ELSE 0 END AS x
    FROM customer, (SELECT unnest(range({_MANY})) AS i) n)
  SELECT pid AS submitter_participant_id, 'CODE:' || lpad(CAST(i AS VARCHAR), 4, '0') AS item_code, 'Item ' || i AS item_term, 'L' || i AS level, x AS score,
    CAST(NULL AS VARCHAR) AS parity, pid || '_item_q' || i AS submitter_item_id FROM v WHERE x <> 0
  UNION ALL SELECT pid, 'AGAIN', NULL, NULL, NULL, CASE x WHEN 1 THEN 'odd' ELSE 'even' END, pid || '_item_q1' FROM v WHERE i = 1 AND x <> 0""")
def _expand_many(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").selectExpr("c_custkey", "pmod(c_custkey * 31, 1009) AS m")
    # one narrow row becomes thousands of values: the rows are dealt to tasks before that
    c = c.repartition(1 + c.count() // _WIDE_ROWS)
    # 1009 divides c_custkey * 31 + i * 17 where the two remainders make up 1009 or 0
    c = c.selectExpr("c_custkey AS participant_id", "CAST(NULL AS STRING) AS repeat_kind", f"c_custkey AS {ORDER_COL}", *(
        f"IF(m = {-17 * i % 1009}, 1 + (c_custkey + {i}) % 2, 0) AS q{i}" for i in range(_MANY)))
    c = stored(c, "wide")  # a file of thousands of columns, as such sources come
    return map_entity(c, _MANY_SPEC | {"filters": {"participant_id_field": PID}}, order_by=ORDER_COL).df


# code lists of thousands of entries
_base_query("map_values_large_list", ["visit_code", "visit_label", "enroll_code", "visit_number"],
            [{"source_field": "instance", "target_field": ["visit_code", "visit_label"], "value_mappings": {k: [f"V{k}", f"visit {k}"] for k in range(10_000)}, "default_value": "none"},
             {"source_field": "m_text", "target_field": "enroll_code", "value_mappings": {str(k): f"month {k}" for k in range(1, 5_000) if k % 2}},
             {"source_field": "instance", "target_field": "visit_number", "target_type": "integer", "value_mappings": {k: None if k % 3 == 0 else 2 * k for k in range(10_000)}, "default_value": -1}],
            """CASE WHEN instance IS NULL THEN 'none' WHEN instance < 10000 THEN 'V' || instance END AS visit_code, CASE WHEN instance < 10000 THEN 'visit ' || instance END AS visit_label,
            CASE WHEN CAST(m_text AS BIGINT) % 2 = 1 THEN 'month ' || m_text END AS enroll_code,
            CASE WHEN instance IS NULL THEN -1 WHEN instance < 10000 AND instance % 3 = 0 THEN -1 WHEN instance < 10000 THEN 2 * instance ELSE instance END AS visit_number""",
            filters=ALL_ROWS)

ENTITY_EXPANSION = {
    "entity": {"name": "Comorbidity", "fields": {
        "base": ["submitter_participant_id", "comorbidity_code", "comorbidity_term", "comorbidity_status"],
        "extension": ["submitter_comorbidity_id"]}, "pattern": "expansion", "params": {"skip_values": [0]}},
    "filters": {"participant_id_field": PID,
                "participant": {"filter": [{"field": "consent", "op": "equals", "value": 1}]}, "rows": BASELINE},
    "mappings": [OUT_PID,
                 {"target_field": "submitter_comorbidity_id", "target_type": "identifier",
                  "params": {"prefix_field": PID, "type": "comorbidity", "suffix_fields": ["source_field_name"]}},
                 {"target_field": "comorbidity_status", "source_type": "radio",
                  "value_mappings": {1: "Active", 2: "Resolved"}}],
    "configs": [{"source_field": "f1", "code": "MONDO:1", "term": "Condition one"},
                {"source_field": "f2", "code": "MONDO:2", "term": "Condition two"}],
}
_x_query("entity_expansion", ENTITY_EXPANSION,
         """WITH b AS (SELECT * FROM wide WHERE repeat_kind IS NULL AND participant_id IN
  (SELECT participant_id FROM wide WHERE consent = 1))
SELECT participant_id AS submitter_participant_id, 'MONDO:1' AS comorbidity_code, 'Condition one' AS comorbidity_term,
  CASE f1 WHEN 1 THEN 'Active' WHEN 2 THEN 'Resolved' END AS comorbidity_status,
  CAST(participant_id AS VARCHAR) || '_comorbidity_f1' AS submitter_comorbidity_id FROM b WHERE f1 IS NOT NULL AND f1 <> 0
UNION ALL SELECT participant_id, 'MONDO:2', 'Condition two', CASE f2 WHEN 1 THEN 'Active' WHEN 2 THEN 'Resolved' END,
  CAST(participant_id AS VARCHAR) || '_comorbidity_f2' FROM b WHERE f2 IS NOT NULL AND f2 <> 0""")


# ------------------------------------------------------------------ 2.I / 2.J summaries and hooks


@q("entity_summary", f"""WITH d AS ({_ENTITY_DIRECT_SQL}), x AS ({_EXPAND_CHECKBOX_SQL})
SELECT 'direct' AS entity, CAST(count(*) AS BIGINT) AS records, CAST(count(DISTINCT submitter_participant_id) AS BIGINT) AS participants,
  round(count(*) / count(DISTINCT submitter_participant_id), 4) AS records_per_participant FROM d
UNION ALL SELECT 'expansion', count(*), count(DISTINCT submitter_participant_id),
  round(count(*) / count(DISTINCT submitter_participant_id), 4) FROM x""")
def _summary(spark, sf):
    w = wide(spark, sf)
    res = {"direct": map_entity(w, ENTITY_DIRECT, order_by=ORDER_COL),
           "expansion": map_entity(w, EXPAND_CHECKBOX, order_by=ORDER_COL)}
    return RP.entity_summary(res)


@q("hook_transform", """SELECT participant_id AS submitter_participant_id, segment, true AS hooked
FROM wide WHERE nation < 10""")
def _hook(spark, sf):
    sp = spec(["submitter_participant_id", "segment"], [OUT_PID, _copy("segment")], ALL_ROWS)
    return run(spark, sf, sp, before=lambda d: d.where(F.col("nation") < 10),
               after=lambda d: d.withColumn("hooked", F.lit(True)))


# ------------------------------------------------------------------ 2.K validations


def _vspec(validations, post=None):
    return spec(["submitter_participant_id", "code", "age_at_x", "segment"],
                [OUT_PID, {"source_field": "f2", "target_field": "code", "value_mappings": {1: "one", 2: "two"}},
                 {"target_field": "age_at_x", "target_type": "age",
                  "params": {"birth_date_field": "dob", "event_date_field": "enroll_date"}}, _copy("segment")],
                ALL_ROWS, validations=validations, post_processing=post or [])


_V_AGE = sql_age("dob", "enroll_date")


def _v_query(name: str, validations, sql: str):
    @q(name, sql)
    def _vq(spark, sf):
        return map_entity(wide(spark, sf), _vspec(validations), order_by=ORDER_COL).report()


_v_query("validate_required", [{"type": "required", "field": "code"}],
         "SELECT 'Record' AS entity, 'required' AS rule, 'code' AS field, CAST(0 AS BIGINT) AS bad_rows")
_v_query("validate_participant_id", [{"type": "participant_id", "field": "submitter_participant_id"},
                                     {"type": "participant_id", "field": "code"}],
         """SELECT 'Record' AS entity, 'participant_id' AS rule, 'submitter_participant_id' AS field, CAST(0 AS BIGINT) AS bad_rows
UNION ALL SELECT 'Record', 'participant_id', 'code', CAST(count(*) AS BIGINT) FROM wide
WHERE (f2 IS NULL OR f2 NOT IN (1, 2))""")
_v_query("validate_age_range", [{"type": "age_range", "field": "age_at_x", "min_age": 0, "max_age": 15000}],
         f"""SELECT 'Record' AS entity, 'age_range' AS rule, 'age_at_x' AS field,
  CAST(count(*) FILTER (WHERE a IS NOT NULL AND (a < 0 OR a > 15000)) AS BIGINT) AS bad_rows
FROM (SELECT {_V_AGE} AS a FROM wide)""")
_v_query("validate_unique", [{"type": "unique", "field": "segment"}],
         """SELECT 'Record' AS entity, 'unique' AS rule, 'segment' AS field,
  CAST(count(*) - count(DISTINCT segment) - max(CASE WHEN segment IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS bad_rows
FROM wide""")
_v_query("validation_report", [{"type": "participant_id", "field": "submitter_participant_id"},
                               {"type": "age_range", "field": "age_at_x", "max_age": 12000},
                               {"type": "unique", "field": "code"}, {"type": "unique", "field": "no_such"}],
         f"""SELECT 'Record' AS entity, 'participant_id' AS rule, 'submitter_participant_id' AS field, CAST(0 AS BIGINT) AS bad_rows
UNION ALL SELECT 'Record', 'age_range', 'age_at_x',
  CAST(count(*) FILTER (WHERE a IS NOT NULL AND (a < 0 OR a > 12000)) AS BIGINT)
FROM (SELECT {_V_AGE} AS a FROM wide)
UNION ALL SELECT 'Record', 'unique', 'code', CAST(count(*) - count(DISTINCT c) - max(CASE WHEN c IS NULL THEN 1 ELSE 0 END) AS BIGINT)
FROM (SELECT CASE f2 WHEN 1 THEN 'one' WHEN 2 THEN 'two' END AS c FROM wide)""")


_UNIQUE_FIELDS = ["participant_id", "segment", "f1", "f2", "f3", "nation", "instance", "acctbal", "dob", "enroll_date", "order_status", "age_text", "total_price", "event_date"]
_v_many = [{"type": "unique", "field": c} for c in _UNIQUE_FIELDS] + [{"type": "required", "field": "f2"}, {"type": "required", "field": "segment"}]


@q("validate_unique_many", " UNION ALL ".join(
    f"SELECT 'wide' AS entity, 'unique' AS rule, '{c}' AS field, CAST(count(*) - count(DISTINCT {c}) - max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS bad_rows FROM wide"
    for c in _UNIQUE_FIELDS) + "".join(
    f" UNION ALL SELECT 'wide', 'required', '{c}', CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) FROM wide" for c in ("f2", "segment")))
def _unique_many(spark, sf):
    return validation_report(wide(spark, sf), _v_many, "wide")


_M_SPEC = spec(["submitter_participant_id", "vital_status", "age_at_death"],
               [OUT_PID, {"source_field": "segment", "target_field": "vital_status", "value_mappings": {"BUILDING": "Deceased", "MACHINERY": "Alive"}},
                {"target_field": "age_at_death", "target_type": "age", "params": {"birth_date_field": "dob", "event_date_field": "enroll_date"}}],
               {"participant": {"filter": [{"field": "consent", "op": "equals", "value": 1}]}, "rows": BASELINE}, name="Participant",
               validations=[{"type": "participant_id", "field": "submitter_participant_id"}, {"type": "unique", "field": "vital_status"},
                            {"type": "unique", "field": "submitter_participant_id"}, {"type": "age_range", "field": "age_at_death", "max_age": 12000}],
               post_processing=[{"type": "mystery"}])
_M_SQL = f"""o AS (SELECT participant_id AS pid, CASE segment WHEN 'BUILDING' THEN 'Deceased' WHEN 'MACHINERY' THEN 'Alive' END AS vital, {_V_AGE} AS had
    FROM wide WHERE repeat_kind IS NULL AND participant_id IN (SELECT participant_id FROM wide WHERE consent = 1)),
  m AS (SELECT *, CASE WHEN vital = 'Deceased' THEN had END AS age FROM o),
  n AS (SELECT count(*) AS rows, count(DISTINCT pid) AS ids, count(had) AS before, count(age) AS after, count(*) FILTER (WHERE age < 0 OR age > 12000) AS old,
    count(*) - count(DISTINCT vital) - max(CASE WHEN vital IS NULL THEN 1 ELSE 0 END) AS again FROM m),
  s AS (SELECT count(*) AS rows, count(DISTINCT participant_id) AS ids, count(DISTINCT participant_id) FILTER (WHERE consent = 1) AS ok FROM wide)"""


@q("study_metrics", f"""WITH {_M_SQL},
  x AS (SELECT unnest([
    {{'entity': 'participant', 'metric': 'input_rows', 'detail': '', 'value': s.rows}}, {{'entity': 'participant', 'metric': 'output_rows', 'detail': '', 'value': n.rows}},
    {{'entity': 'participant', 'metric': 'output_columns', 'detail': '', 'value': 3}}, {{'entity': 'participant', 'metric': 'failed', 'detail': '', 'value': 0}},
    {{'entity': 'participant', 'metric': 'warning', 'detail': 'unknown post_processing type ''mystery'' skipped', 'value': 1}},
    {{'entity': 'participant', 'metric': 'participants_before', 'detail': '', 'value': s.ids}}, {{'entity': 'participant', 'metric': 'participants_after', 'detail': '', 'value': s.ok}},
    {{'entity': 'participant', 'metric': 'eligibility_retention_pct', 'detail': '', 'value': round(100.0 * s.ok / s.ids, 4)}},
    {{'entity': 'participant', 'metric': 'participants', 'detail': '', 'value': n.ids}},
    {{'entity': 'participant', 'metric': 'bad_rows', 'detail': 'participant_id: submitter_participant_id', 'value': 0}},
    {{'entity': 'participant', 'metric': 'bad_rows', 'detail': 'unique: vital_status', 'value': n.again}},
    {{'entity': 'participant', 'metric': 'bad_rows', 'detail': 'unique: submitter_participant_id', 'value': n.rows - n.ids}},
    {{'entity': 'participant', 'metric': 'bad_rows', 'detail': 'age_range: age_at_death', 'value': n.old}},
    {{'entity': 'participant', 'metric': 'rules_failed', 'detail': '', 'value': CAST(n.again > 0 AS INT) + CAST(n.old > 0 AS INT) + CAST(n.rows > n.ids AS INT)}},
    {{'entity': 'participant', 'metric': 'values_before_rule', 'detail': 'age_at_death', 'value': n.before}},
    {{'entity': 'participant', 'metric': 'values_after_rule', 'detail': 'age_at_death', 'value': n.after}},
    {{'entity': 'broken', 'metric': 'output_rows', 'detail': '', 'value': 0}}, {{'entity': 'broken', 'metric': 'output_columns', 'detail': '', 'value': 0}},
    {{'entity': 'broken', 'metric': 'failed', 'detail': 'SpecError: cannot order-compare column ''segment'' (string) with 5', 'value': 1}},
    {{'entity': '', 'metric': 'input_rows', 'detail': '', 'value': s.rows}}, {{'entity': '', 'metric': 'output_rows', 'detail': '', 'value': n.rows}},
    {{'entity': '', 'metric': 'rules_failed', 'detail': '', 'value': CAST(n.again > 0 AS INT) + CAST(n.old > 0 AS INT) + CAST(n.rows > n.ids AS INT)}},
    {{'entity': '', 'metric': 'entities', 'detail': '', 'value': 2}}, {{'entity': '', 'metric': 'entities_failed', 'detail': '', 'value': 1}},
    {{'entity': '', 'metric': 'participant_retention_pct', 'detail': '', 'value': round(100.0 * n.rows / s.rows, 4)}}]) AS r FROM n, s)
SELECT r.entity, r.metric, r.detail, CAST(r.value AS DOUBLE) AS value FROM x""")
def _study_metrics(spark, sf):
    from ..sources.sinks import write_study
    from .metrics import study_metrics

    results = map_study(wide(spark, sf), {"participant": _M_SPEC, "broken": _BAD_SPEC}, order_by=ORDER_COL)
    return study_metrics(spark, results, write_study(results, scratch(spark, "metrics"), "parquet"), "parquet")


@q("post_null_counts", f"""WITH {_M_SQL} SELECT 'age_at_death' AS field, CAST(before AS BIGINT) AS values_before, CAST(after AS BIGINT) AS values_after FROM n""")
def _null_counts(spark, sf):
    from ..sources.sinks import write_entity

    r = map_entity(wide(spark, sf), _M_SPEC, order_by=ORDER_COL)
    write_entity(r, scratch(spark, "nulls"), "parquet")
    return spark.createDataFrame([("age_at_death", r.written["had_0"], r.written["has_0"])], "field string, values_before long, values_after long")


# ------------------------------------------------------------------ 2.L post-processing


def _post_query(name: str, sp: dict, sql: str):
    @q(name, sql)
    def _pq(spark, sf):
        return run(spark, sf, sp)


_V_COLS = (f"participant_id AS submitter_participant_id, CASE f2 WHEN 1 THEN 'one' WHEN 2 THEN 'two' END AS code, "
           f"{_V_AGE} AS age_at_x, segment")
_post_query("drop_null_required", _vspec([{"type": "required", "field": "code"}]),
            f"SELECT {_V_COLS} FROM wide WHERE f2 IN (1, 2)")
_post_query("post_filter_records", _vspec([], [{"type": "filter_records", "field": "code", "op": "equals",
                                                "value": "one"}]),
            f"SELECT {_V_COLS} FROM wide WHERE f2 = 1")
_base_query("post_clean_numeric", ["amount"], [_copy("amount_text", "amount")],
            "TRY_CAST(replace(amount_text, ',', '') AS DOUBLE) AS amount",
            post=[{"type": "clean_numeric", "fields": ["amount"]}])
_base_query("post_nullable_int", ["half"], [_copy("half")],
            "CAST(round_even(nation / 2.0, 0) AS BIGINT) AS half",
            pre=[{"type": "calculate_field", "target": "half", "formula": "nation / 2"}],
            post=[{"type": "convert_nullable_int", "columns": ["half"]}])
_base_query("post_nullable_int_auto", ["age_at_x", "visit_count", "segment"],
            [_copy("ratio", "age_at_x"), _copy("m_text", "visit_count"), _copy("segment")],
            "CAST(round_even(acctbal / 7, 0) AS BIGINT) AS age_at_x, CAST(m_text AS BIGINT) AS visit_count, segment",
            pre=[{"type": "calculate_field", "target": "ratio", "formula": "acctbal / 7"}],
            post=[{"type": "convert_nullable_int", "columns": "auto"}])
_base_query("post_conditional_null", ["vital_status", "age_at_death"],
            [{"source_field": "segment", "target_field": "vital_status",
              "value_mappings": {"BUILDING": "Deceased", "MACHINERY": "Alive"}},
             {"target_field": "age_at_death", "target_type": "age",
              "params": {"birth_date_field": "dob", "event_date_field": "enroll_date"}}],
            f"CASE segment WHEN 'BUILDING' THEN 'Deceased' WHEN 'MACHINERY' THEN 'Alive' END AS vital_status, "
            f"CASE WHEN segment = 'BUILDING' THEN {_V_AGE} END AS age_at_death")


# ------------------------------------------------------------------ 2.M study jobs

_BAD_SPEC = spec(["submitter_participant_id"], [OUT_PID],
                 {"rows": [{"name": "bad", "filter": [{"field": "segment", "op": "greater_than", "value": 5}]}]})


def _study(spark, sf):
    w = wide(spark, sf)
    return w, map_study(w, {"direct": ENTITY_DIRECT, "expansion": ENTITY_EXPANSION, "broken": _BAD_SPEC},
                        order_by=ORDER_COL)


@q("study_all_entities", f"""WITH d AS ({_ENTITY_DIRECT_SQL})
SELECT 'direct' AS entity, CAST(count(*) AS BIGINT) AS records FROM d
UNION ALL SELECT 'expansion', CAST(count(*) AS BIGINT) FROM wide w, (VALUES (1), (2)) AS k(i)
  WHERE w.repeat_kind IS NULL AND w.participant_id IN (SELECT participant_id FROM wide WHERE consent = 1)
  AND ((k.i = 1 AND w.f1 IS NOT NULL AND w.f1 <> 0) OR (k.i = 2 AND w.f2 IS NOT NULL AND w.f2 <> 0))
UNION ALL SELECT 'broken', CAST(0 AS BIGINT)""")
def _study_all(spark, sf):
    _, res = _study(spark, sf)
    parts = [r.df.agg(F.lit(k).alias("entity"), F.count(F.lit(1)).cast("long").alias("records"))
             for k, r in res.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@q("study_report", f"""WITH d AS ({_ENTITY_DIRECT_SQL}), n AS (SELECT CAST(count(*) AS BIGINT) AS c FROM wide)
SELECT 'direct' AS entity, (SELECT c FROM n) AS input_rows, CAST(count(*) AS BIGINT) AS output_rows,
  CAST(6 AS BIGINT) AS output_columns, false AS failed FROM d
UNION ALL SELECT 'expansion', (SELECT c FROM n), CAST(count(*) AS BIGINT), CAST(5 AS BIGINT), false
FROM wide w, (VALUES (1), (2)) AS k(i)
  WHERE w.repeat_kind IS NULL AND w.participant_id IN (SELECT participant_id FROM wide WHERE consent = 1)
  AND ((k.i = 1 AND w.f1 IS NOT NULL AND w.f1 <> 0) OR (k.i = 2 AND w.f2 IS NOT NULL AND w.f2 <> 0))
UNION ALL SELECT 'broken', (SELECT c FROM n), CAST(0 AS BIGINT), CAST(1 AS BIGINT), true""")
def _study_report(spark, sf):
    w, res = _study(spark, sf)
    return RP.study_report(w, res)


@q("empty_result_schema", """SELECT CAST(NULL AS BIGINT) AS submitter_participant_id, CAST(NULL AS VARCHAR) AS extra
FROM wide WHERE false""")
def _empty(spark, sf):
    sp = spec(["submitter_participant_id", "extra"], [OUT_PID],
              {"participant": {"filter": [{"field": "segment", "op": "equals", "value": "NONE"}]}, "rows": BASELINE})
    return run(spark, sf, sp)


_base_query("convert_to_numeric_downcast", ["month", "year_id", "nation", "ratio", "balance"],
            [_copy("m_text", "month"), {"target_field": "year_id", "target_type": "identifier", "params": {"prefix_field": PID, "type": "y", "suffix_fields": ["year"]}},
             _copy("nation"), _copy("ratio"), _copy("acctbal", "balance")],
            """CAST(m_text AS DOUBLE) AS month, participant_id || '_y_' || (1950 + participant_id % 50) AS year_id, CAST(nation AS DOUBLE) AS nation,
            CAST(CAST(CAST((participant_id % 1000) / 7.0 AS FLOAT) AS VARCHAR) AS DOUBLE) AS ratio, CAST(CAST(CAST(acctbal AS FLOAT) AS VARCHAR) AS DOUBLE) AS balance""",
            pre=[{"type": "calculate_field", "target": "year", "formula": "1950 + participant_id % 50"}, {"type": "calculate_field", "target": "ratio", "formula": "participant_id % 1000 / 7"},
                 {"type": "convert_to_numeric", "fields": ["m_text", "year"], "downcast": "integer"},  # months have nulls: they stay double
                 {"type": "convert_to_numeric", "fields": ["nation", "ratio", "acctbal"], "downcast": "float"}])


@q("convert_to_numeric_raise", """SELECT 'SpecError: convert_to_numeric: non-numeric values in [''amount_text'']' AS error, count(*) FILTER (WHERE amount_text IS NOT NULL AND TRY_CAST(amount_text AS DOUBLE) IS NULL) > 0 AS raised
FROM wide""")
def _numeric_raise(spark, sf):
    sp = spec(["m_text"], [_copy("m_text")], ALL_ROWS, preprocessing=[{"type": "convert_to_numeric", "fields": ["m_text", "amount_text"], "errors": "raise"}])
    r = map_study(wide(spark, sf), {"x": sp}, order_by=ORDER_COL)["x"]
    return spark.createDataFrame([(r.error, r.error is not None)], "error string, raised boolean")


_base_query("clean_unknown_step", ["segment"], [_copy("segment")], "segment", pre=[{"type": "no_such_step", "fields": ["segment"]}, {"type": "lowercase", "fields": ["no_such_field"]}])


@q("join_key_type_clash", """SELECT 'SpecError: join key ''participant_id'': text on one side, number on the other' AS error, count(*) FILTER (WHERE participant_id IS NOT NULL) > 0 AS keys
FROM wide""")
def _key_clash(spark, sf):
    from ..functions.predicates import SpecError

    w = wide(spark, sf)
    try:
        MF.join_sources(w, w.select(F.col(PID).cast("string").alias(PID), F.col("segment").alias("other")), [PID])
        error = None
    except SpecError as e:
        error = f"SpecError: {e}"
    return w.agg(F.lit(error).alias("error"), (F.count(PID) > 0).alias("keys"))


# ------------------------------------------------------------------ 2.A sources and sinks


def _customer_text(spark, sf):
    k = F.col("c_custkey")
    return spark.read.parquet(f"{sf}/customer.parquet").select(
        k.alias("c_custkey"), "c_name",
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("nationkey"),
        "c_acctbal", F.col("c_mktsegment").alias("segment"), (k % 2 == 0).alias("even"))


_CUSTOMER_TEXT_SQL = """SELECT c_custkey, c_name, CAST(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS DOUBLE) AS nationkey,
  c_acctbal, c_mktsegment AS segment, c_custkey % 2 = 0 AS even FROM customer"""


@q("src_csv", _CUSTOMER_TEXT_SQL)
def _src_csv(spark, sf):
    d = scratch(spark, "csv")
    _customer_text(spark, sf).write.option("header", True).csv(f"{d}/customer.csv")
    return RD.read_file(spark, f"{d}/customer.csv").drop(R.ORD)


@q("src_tsv", _CUSTOMER_TEXT_SQL)
def _src_tsv(spark, sf):
    d = scratch(spark, "tsv")
    _customer_text(spark, sf).write.option("header", True).option("sep", "\t").csv(f"{d}/customer.tsv")
    return RD.read_file(spark, f"{d}/customer.tsv").drop(R.ORD)


@q("src_txt_detect", "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey "
                     "FROM nation")
def _src_txt(spark, sf):
    d = scratch(spark, "txt")
    spark.read.parquet(f"{sf}/nation.parquet").write.option("header", True).option("sep", ";").csv(f"{d}/nation.txt")
    return RD.read_file(spark, f"{d}/nation.txt").drop(R.ORD)


@q("src_encoding", "SELECT c_custkey, c_name || 'é' AS c_name FROM customer")
def _src_enc(spark, sf):
    d = scratch(spark, "enc")
    (spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", F.concat("c_name", F.lit("é")).alias("c_name"))
     .write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{d}/customer.csv"))
    return RD.read_file(spark, f"{d}/customer.csv").drop(R.ORD)


@q("src_infer_types", """SELECT c_custkey, CAST(c_custkey % 100 AS BIGINT) AS code,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey % 9 AS DOUBLE) END AS score,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 7 AS VARCHAR) || 'x' END AS label FROM customer""")
def _src_infer(spark, sf):
    d = scratch(spark, "infer")
    k = F.col("c_custkey")
    (spark.read.parquet(f"{sf}/customer.parquet").select(
        k.alias("c_custkey"), F.lpad((k % 100).cast("string"), 3, "0").alias("code"),
        F.when(k % 4 == 0, F.lit("NA")).otherwise((k % 9).cast("string")).alias("score"),
        F.when(k % 3 == 0, F.lit("null")).otherwise(F.concat((k % 7).cast("string"), F.lit("x"))).alias("label"))
     .write.option("header", True).csv(f"{d}/t.csv"))
    return RD.read_file(spark, f"{d}/t.csv").drop(R.ORD)


@q("src_csv_quoted_newline", """SELECT c_custkey, c_name || chr(10) || '"' || c_mktsegment || '", and' || chr(13) || chr(10) || 'more' AS note,
  CASE WHEN c_custkey % 3 = 0 THEN '5" pipe' ELSE c_mktsegment END AS plain FROM customer""")
def _src_newline(spark, sf):
    d = scratch(spark, "newline")
    c = spark.read.parquet(f"{sf}/customer.parquet")
    note = F.concat("c_name", F.lit('\n""'), "c_mktsegment", F.lit('"", and\r\nmore'))
    plain = F.when(F.col("c_custkey") % 3 == 0, '5" pipe').otherwise(F.col("c_mktsegment"))
    _write_lines(c.select(F.concat(F.col("c_custkey").cast("string"), F.lit(',"'), note, F.lit('",'), plain)), "c_custkey,note,plain", f"{d}/c.csv")
    return RD.read_file(spark, f"{d}/c.csv").drop(R.ORD)


def _write_lines(lines, header: str, path: str) -> None:
    """A text file in parts, each with the header line first."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    line = F.col(lines.columns[0])
    lines.select(F.when(first, F.concat(F.lit(header + "\n"), line)).otherwise(line).alias("line")).write.text(path)


def _wide_rows(spark, sf):
    """Customers as text lines of four fields; each seventh has two more, each eleventh one less."""
    k, c = F.col("c_custkey"), spark.read.parquet(f"{sf}/customer.parquet")
    base = F.concat_ws(",", k.cast("string"), "c_name", F.concat(F.lit('"'), "c_mktsegment", F.lit(', x"')))
    return c.select(F.when(k % 7 == 0, F.concat(base, F.lit(",1,extra,"))).when(k % 11 == 0, base).otherwise(F.concat(base, F.lit(",1"))).alias("line"))


@q("src_csv_malformed", """SELECT CAST(6 AS INTEGER) AS fields, CAST(4 AS INTEGER) AS expected,
  c_custkey || ',' || c_name || ',"' || c_mktsegment || ', x",1,extra,' AS record FROM customer WHERE c_custkey % 7 = 0""")
def _src_malformed(spark, sf):
    d = scratch(spark, "malformed")
    _write_lines(_wide_rows(spark, sf), "id,name,segment,flag", f"{d}/c.csv")
    return RD.malformed_rows(spark, f"{d}/c.csv").select("fields", "expected", "record")


def _src_bad_rows(how: str, where: str):
    @q(f"src_csv_bad_rows_{how}", f"""SELECT c_custkey AS id, c_name AS name, c_mktsegment || ', x' AS segment,
  CASE WHEN c_custkey % 11 = 0 AND c_custkey % 7 <> 0 THEN NULL ELSE 1.0 END AS flag FROM customer WHERE {where}""")
    def _f(spark, sf):
        d = scratch(spark, "badrows")
        _write_lines(_wide_rows(spark, sf), "id,name,segment,flag", f"{d}/c.csv")
        return RD.read_file(spark, f"{d}/c.csv", bad_rows=how).drop(R.ORD)


_src_bad_rows("skip", "c_custkey % 7 <> 0")
_src_bad_rows("keep", "true")


@q("src_csv_duplicate_header", """SELECT c_custkey AS id, c_name AS first_a, c_mktsegment AS second_a, c_custkey + 1 AS upper_age, c_custkey + 2 AS lower_age,
  c_custkey + 3 AS unnamed FROM customer""")
def _src_header(spark, sf):
    d = scratch(spark, "header")
    k = F.col("c_custkey")
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.concat_ws(",", k.cast("string"), "c_name", "c_mktsegment", (k + 1).cast("string"), (k + 2).cast("string"), (k + 3).cast("string")))
    _write_lines(c, "id,a,a,Age,age,", f"{d}/c.csv")
    names = {"id": "id", "a": "first_a", "a.1": "second_a", "Age": "upper_age", "age": "lower_age", "Unnamed: 5": "unnamed"}
    return map_entity(RD.read_file(spark, f"{d}/c.csv"), spec(list(names.values()), [{"source_field": a, "target_field": b} for a, b in names.items()],
                                                             {"participant_id_field": "id", "rows": [{"name": "all", "select": "all", "filter": [{"field": "id", "op": "is_not_null"}]}]})).df


_AUTO_SPEC = {"entity": {"name": "Customer", "fields": {"base": ["submitter_participant_id", "segment"]}},
              "mappings": [OUT_PID, _copy("segment")]}


@q("src_autodiscover", "SELECT c_custkey AS submitter_participant_id, c_mktsegment AS segment FROM customer")
def _src_auto(spark, sf):
    d = scratch(spark, "auto")
    (spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias(PID),
                                                        F.col("c_mktsegment").alias("segment"))
     .write.option("header", True).option("sep", "\t").csv(f"{d}/customer.tsv"))
    return map_study(None, {"customer": _AUTO_SPEC}, source_dir=d)["customer"].df


@q("sink_entity_csv", _ENTITY_DIRECT_SQL)
def _sink(spark, sf):
    from ..sources.sinks import write_entity

    d = scratch(spark, "sink")
    res = map_entity(wide(spark, sf), ENTITY_DIRECT, order_by=ORDER_COL)
    path = write_entity(res, d)
    return RD.read_file(spark, path, int_with_nulls="long").drop(R.ORD)


# ------------------------------------------------------------------ larger workloads (lineitem)

LINE_ENTITY = {
    "entity": {"name": "Line", "fields": {"base": ["submitter_line_id", "order_key", "return_code", "status_label",
                                                   "quantity_int", "ship_date"]}, "pattern": "direct"},
    "filters": {"participant_id_field": "l_orderkey",
                "participant": {"filter": [{"field": "l_discount", "op": "greater_than", "value": 0.05}]}},
    "mappings": [{"target_field": "submitter_line_id", "target_type": "identifier",
                  "params": {"prefix_field": "l_orderkey", "type": "line", "suffix_fields": ["l_linenumber"]}},
                 _copy("l_orderkey", "order_key"),
                 {"source_field": "l_returnflag", "target_field": "return_code",
                  "value_mappings": {"A": "RET:A", "N": "RET:N", "R": "RET:R"}},
                 {"source_field": "l_linestatus", "target_field": "status_label", "source_type": "radio",
                  "value_mappings": {"F": "Filled", "O": "Open"}},
                 {"source_field": "l_quantity", "target_field": "quantity_int", "target_type": "integer"},
                 {"source_field": "l_shipdate", "target_field": "ship_date", "target_type": "date"}],
}


@q("map_values_lineitem", """SELECT CAST(l_orderkey AS VARCHAR) || '_line_' || CAST(l_linenumber AS VARCHAR) AS submitter_line_id,
  l_orderkey AS order_key, 'RET:' || l_returnflag AS return_code,
  CASE l_linestatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' END AS status_label,
  CAST(trunc(l_quantity) AS BIGINT) AS quantity_int, strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS ship_date
FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.05)""")
def _line_map(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return map_entity(li, LINE_ENTITY, order_by=["l_orderkey", "l_linenumber"]).df


LINE_EXPANSION = {
    "entity": {"name": "LineFlag", "fields": {"base": ["order_key", "lineflag_code", "lineflag_term", "detail"]},
               "pattern": "expansion", "params": {"skip_values": [0]}},
    "filters": {"participant_id_field": "l_orderkey"},
    "preprocessing": [{"type": "calculate_field", "target": "is_return", "formula": "l_returnflag == 'R'"},
                      {"type": "calculate_field", "target": "big_qty", "formula": "l_quantity > 40"},
                      {"type": "calculate_field", "target": "taxed", "formula": "l_tax > 0.04"}],
    "mappings": [_copy("l_orderkey", "order_key")],
    "configs": [{"source_field": "is_return", "code": "LF:R", "term": "returned",
                 "enrichments": [{"target_field": "detail", "source_field": "l_shipmode"},
                                 {"target_field": "detail", "source_field": "l_returnflag"}]},
                {"source_field": "big_qty", "code": "LF:Q", "term": "large quantity",
                 "enrichments": [{"target_field": "detail", "source_field": "l_quantity"}]},
                {"source_field": "taxed", "code": "LF:T", "term": "taxed"}],
}


@q("expand_lineitem", """SELECT l_orderkey AS order_key, 'LF:R' AS lineflag_code, 'returned' AS lineflag_term, l_returnflag AS detail
FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey, 'LF:Q', 'large quantity',
  CASE WHEN l_quantity = floor(l_quantity) THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.0' ELSE CAST(l_quantity AS VARCHAR) END
FROM lineitem WHERE l_quantity > 40
UNION ALL SELECT l_orderkey, 'LF:T', 'taxed', NULL FROM lineitem WHERE l_tax > 0.04""")
def _line_expand(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return map_entity(li, LINE_EXPANSION, order_by=["l_orderkey", "l_linenumber"]).df


# ------------------------------------------------------------------ more cleaning variants

_base_query("convert_to_numeric_ignore", ["m_text", "amount_text"], [_copy("m_text"), _copy("amount_text")],
            "TRY_CAST(m_text AS DOUBLE) AS m_text, amount_text",
            pre=[{"type": "convert_to_numeric", "fields": ["m_text", "amount_text"], "errors": "ignore"}])
_base_query("calculate_field_ifexp", ["band"], [_copy("band")],
            "CASE WHEN acctbal > 5000 THEN 'high' ELSE 'low' END AS band",
            pre=[{"type": "calculate_field", "target": "band", "formula": "'high' if acctbal > 5000 else 'low'"}])


@q("study_shared_selection", None)
def _study_shared(spark, sf):
    """As ``study_all_entities`` with one persisted selection per filter group
    (the caller runs the result, then ``engine.release`` frees the cache)."""
    w = wide(spark, sf)
    res = map_study(w, {"direct": ENTITY_DIRECT, "expansion": ENTITY_EXPANSION, "broken": _BAD_SPEC},
                    order_by=ORDER_COL, share="persist")
    parts = [r.df.agg(F.lit(k).alias("entity"), F.count(F.lit(1)).cast("long").alias("records"))
             for k, r in res.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


ORACLE["study_shared_selection"] = ORACLE["study_all_entities"]


_SCAN_CONDS = [("repeat_kind IS NULL", [IS_BASE], None, None), ("repeat_kind = 'order'", [IS_ORDER], None, None),
               ("repeat_kind IS NULL", [IS_BASE], "consent = 1", {"field": "consent", "op": "equals", "value": 1}),
               ("order_status = 'F'", [{"field": "order_status", "op": "equals", "value": "F"}], "consent = 1", {"field": "consent", "op": "equals", "value": 1}),
               ("order_status = 'F'", [{"field": "order_status", "op": "equals", "value": "F"}], "segment = 'BUILDING'", {"field": "segment", "op": "equals", "value": "BUILDING"}),
               ("total_price > 200000", [{"field": "total_price", "op": "greater_than", "value": 200000}], "f2 = 1", {"field": "f2", "op": "equals", "value": 1}),
               ("nation < 5", [{"field": "nation", "op": "less_than", "value": 5}], "order_status = 'P'", {"field": "order_status", "op": "equals", "value": "P"}),
               ("f1 = 1", [{"field": "f1", "op": "equals", "value": 1}], None, None)]
_SCAN_SPECS = {f"e{i}": spec(["submitter_participant_id", "record_instance", "segment"], [OUT_PID, OUT_INST, _copy("segment")],
                             {"rows": [{"name": "r", "filter": rows}]} | ({"participant": {"filter": [cond]}} if cond else {}))
               for i, (_, rows, _, cond) in enumerate(_SCAN_CONDS)}


@q("study_one_scan", " UNION ALL ".join(
    f"SELECT 'e{i}' AS entity, participant_id AS submitter_participant_id, instance AS record_instance, segment FROM wide WHERE {where}"
    + (f" AND participant_id IN (SELECT participant_id FROM wide WHERE {ok})" if ok else "") for i, (where, _, ok, _) in enumerate(_SCAN_CONDS)))
def _study_one_scan(spark, sf):
    res = map_study(wide(spark, sf), _SCAN_SPECS, order_by=ORDER_COL, share="one_scan")
    parts = [r.df.select(F.lit(k).alias("entity"), "*") for k, r in res.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ events: flags per user, expanded

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
EVENTS_EXPANSION = {
    "entity": {"name": "Event", "fields": {"base": ["submitter_participant_id", "event_code", "event_term",
                                                    "submitter_event_id"]}, "pattern": "expansion"},
    "filters": {"participant_id_field": "user_id"},
    "mappings": [{"source_field": "user_id", "target_field": "submitter_participant_id"},
                 {"target_field": "submitter_event_id", "target_type": "identifier",
                  "params": {"prefix_field": "user_id", "type": "event", "suffix_fields": ["source_field_name"]}}],
    "configs": [{"source_field": f"has_{t}", "code": f"EV:{t}", "term": t} for t in EVENT_TYPES],
}


@q("expand_events", "\nUNION ALL ".join(
    f"SELECT user_id AS submitter_participant_id, 'EV:{t}' AS event_code, '{t}' AS event_term, "
    f"CAST(user_id AS VARCHAR) || '_event_has_{t}' AS submitter_event_id "
    f"FROM (SELECT user_id, max(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS f FROM events "
    f"WHERE user_id IS NOT NULL GROUP BY user_id) WHERE f = 1" for t in EVENT_TYPES))
def _expand_events(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    # one row per user with a 0/1 flag per event type: a partial aggregation, no pivot scan
    flags = ev.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(*[
        F.max(F.when(F.col("event_type") == t, 1).otherwise(0)).cast("long").alias(f"has_{t}")
        for t in EVENT_TYPES])
    return map_entity(flags, EVENTS_EXPANSION).df
