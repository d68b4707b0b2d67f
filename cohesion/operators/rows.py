"""Row-set operators on the source table, keyed by the participant id.

Everything here is keyed on one column, the participant id. No operator uses a
window partitioned by that id: a single participant may hold a large share of
the rows, and a window would put all of them in one task. Eligibility, the
enrichments and the baseline merge are one partial aggregation (map-side
combine, so a hot id is pre-reduced before the shuffle) producing at most one
row per id, and one equi-join back (``with_participant``). That join is salted:
the rows of a hot id are dealt into parts, each with its copy of the id's row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sqltext as Q
from ..functions import types as TY
from ..functions.predicates import compile_condition, df_resolver

ORD = "__ord"

#: Rows of one id that a task joins. The rows of an id with more are dealt into parts. The list of such ids, which is broadcast, has
#: at most one entry for so many rows: a million at 10^12 rows.
PART_ROWS = 1_000_000


def _fams(df: DataFrame) -> dict[str, str]:
    return {f.name: TY.family(f.dataType) for f in df.schema.fields}


def _c(name: str) -> Column:
    return F.expr("`" + name.replace("`", "``") + "`")


def condition(df: DataFrame, cond, warnings: list[str]) -> Column:
    return compile_condition(cond, df_resolver(df), warnings)


@dataclass
class Fill:
    """Null cells of ``fields`` are filled from the participant's rows where ``cond`` holds: ``first`` or
    ``last`` non-null value, or ``row``: the value, as it is, of the first of these rows."""

    cond: Column
    fields: list[str]
    mode: str = "first"


def sized(per_id: DataFrame) -> DataFrame:
    """per_id, which counts an id's rows in ``__n``, with ``__parts``: into how many parts a join deals them."""
    return per_id.withColumn("__parts", F.when(F.col("__n") > PART_ROWS, F.ceil(F.col("__n") / PART_ROWS)).otherwise(1).cast("int")).drop("__n")


def hot_ids(per_id: DataFrame) -> DataFrame:
    """(__hid, __parts) of the ids of ``sized`` that have more than one part."""
    return per_id.filter("__parts > 1").select(F.col("__pid").alias("__hid"), "__parts")


def salted(df: DataFrame, pid: str, hot: DataFrame) -> DataFrame:
    """df with ``__salt``: which part of its id a row belongs to, 0 for ids that aren't hot."""
    spread = [F.col(ORD)] if ORD in df.columns else [_c(c) for c in df.columns]
    part = F.pmod(F.xxhash64(*spread), F.col("__parts")).cast("int")
    return (df.join(F.broadcast(hot), _c(pid).eqNullSafe(F.col("__hid")), "left")
            .select(*[_c(c) for c in df.columns], F.coalesce(part, F.lit(0)).alias("__salt")))


def with_participant(df: DataFrame, pid: str, eligible: Column | None = None, fills: list[Fill] = (),
                     wanted: Column | None = None) -> DataFrame:
    """Rows of eligible participants (one of their rows passes ``eligible``), null cells filled by ``fills`` in order.

    One aggregation by id and one salted join, however many fills there are. A
    later fill of the same field only acts where the earlier ones found nothing,
    and there the rows are unchanged, so all of them read the source's own values.
    A null id matches a null id in eligibility and in ``row`` fills; other fills leave it alone.
    ``wanted`` reads no filled field: only such rows are joined and returned.
    """
    if eligible is None and not fills:
        return df
    fams = _fams(df)
    key, aggs, conds, found = _c(pid), [], [], {}
    if eligible is not None:
        conds.append(eligible)
        aggs.append(F.max(eligible).alias("__ok"))
    for i, f in enumerate(fills):
        cond = f.cond if f.mode == "row" else f.cond & key.isNotNull()
        conds.append(cond)
        if f.mode == "row":
            row = F.struct(*[_c(c).alias(f"f{j}") for j, c in enumerate(f.fields)])
            aggs.append(F.min_by(F.when(cond, row), F.when(cond, F.col(ORD))).alias(f"__f{i}"))
        for j, c in enumerate(f.fields):
            if f.mode == "row":
                value = F.col(f"__f{i}").getField(f"f{j}")
            else:
                ok = cond & ~TY.is_missing(_c(c), fams[c])
                fn = F.max_by if f.mode == "last" else F.min_by
                aggs.append(fn(F.when(ok, _c(c)), F.when(ok, F.col(ORD))).alias(f"__f{i}_{j}"))
                value = F.col(f"__f{i}_{j}")
            found.setdefault(c, []).append(value)
    any_cond = reduce(lambda x, y: x | y, conds)
    if wanted is None:
        # all rows are joined: they are counted apart, by id alone, so that the conditions reach the scan of the aggregation
        taken, per_id = df, df.filter(any_cond).groupBy(key.alias("__pid")).agg(*aggs)
        counts = sized(df.groupBy(key.alias("__pid")).agg(F.count(F.lit(1)).alias("__n")))
    else:
        # the rows that will be joined are counted by the same aggregation
        taken = df.filter(wanted)
        per_id = counts = sized(df.filter(any_cond | wanted).groupBy(key.alias("__pid")).agg(F.count_if(wanted).alias("__n"), *aggs))
    hot = hot_ids(counts)
    if eligible is not None:
        per_id = per_id.filter("__ok")
    if wanted is None:
        per_id = (per_id.join(F.broadcast(hot), F.col("__pid").eqNullSafe(F.col("__hid")), "left").drop("__hid")
                  .withColumn("__parts", F.coalesce("__parts", F.lit(1))))
    copies = per_id.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    joined = salted(taken, pid, hot).join(copies, key.eqNullSafe(F.col("__pid")) & (F.col("__salt") == F.col("__part")),
                                                      "left" if eligible is None else "inner")
    out = []
    for c in df.columns:
        value = _c(c)
        for f in found.get(c, []):
            value = F.when(TY.is_missing(value, fams[c]), f).otherwise(value)
        out.append(value.alias(c))
    return joined.select(*out)


def excluded_participants(df: DataFrame, pid: str, cond: Column) -> DataFrame:
    """Distinct ids of participants with no qualifying row (left-anti join)."""
    ids = df.filter(cond).select(_c(pid).alias("__eid")).distinct()
    all_ids = df.select(_c(pid)).distinct()
    return all_ids.join(ids, _c(pid).eqNullSafe(F.col("__eid")), "left_anti")


def composite_rows(df: DataFrame, pid: str, last: bool = False) -> DataFrame:
    """One row per participant made of the first (last) non-null value of each
    column, in row order. Rows with a null id drop out. (Aggregates are built
    as SQL text: one call per column however wide the table is.)"""
    fams = _fams(df)
    cols = [c for c in df.columns if c not in (pid, ORD)]
    fn = "max_by" if last else "min_by"
    aggs = []
    for c in cols:
        ok = f"NOT {Q.is_missing(Q.ident(c), fams[c])}"
        aggs.append(F.expr(f"{fn}(CASE WHEN {ok} THEN {Q.ident(c)} END, CASE WHEN {ok} THEN {ORD} END) AS {Q.ident(c)}"))
    aggs.append(F.expr(f"{'max' if last else 'min'}({ORD}) AS {ORD}"))
    out = df.filter(_c(pid).isNotNull()).groupBy(_c(pid)).agg(*aggs)
    return out.select(*[_c(c) for c in df.columns])


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop whole-row duplicates (nulls equal), keeping the earliest row order."""
    cols = [c for c in df.columns if c != ORD]
    if ORD not in df.columns:
        return df.dropDuplicates()
    return df.groupBy(*[_c(c) for c in cols]).agg(F.min(ORD).alias(ORD)).select(*[_c(c) for c in df.columns])


def first_row_per_key(df: DataFrame, keys: list[str], cols: list[str] | None = None) -> DataFrame:
    """One existing row per key, the first in row order (null keys form a group).

    ``min_by`` of a struct is a partial aggregation: a hot key is reduced on
    the map side, so no task ever holds all rows of one key.
    """
    cols = [c for c in (cols if cols is not None else df.columns) if c not in keys and c != ORD]
    packed = F.struct(*[_c(c) for c in cols], F.col(ORD).alias(ORD))
    agg = df.groupBy(*[_c(k) for k in keys]).agg(F.min_by(packed, F.col(ORD)).alias("__r"))
    return agg.select(*[_c(k) for k in keys], *[F.col("__r").getField(c).alias(c) for c in cols + [ORD]])


def select_rows(df: DataFrame, pid: str, selectors: list, warnings: list[str], pid_present: bool = True) -> DataFrame:
    """Union of the row selectors, then whole-row dedup.

    ``select: all`` keeps matching rows; ``first``/``last`` build one composite
    row per participant. When every selector is ``all`` the union is a single
    scan with an OR of the conditions.
    """
    parts: list[tuple[str, Column]] = []
    for sel in selectors:
        if not isinstance(sel, dict) or not sel.get("filter"):
            warnings.append(f"row selector skipped (no filter): {sel!r}")
            continue
        mode = sel.get("select", "all")
        if mode not in ("all", "first", "last"):
            warnings.append(f"row selector {sel.get('name')!r}: unknown select {mode!r}, using all")
            mode = "all"
        if not pid_present:
            mode = "all"
        parts.append((mode, condition(df, sel["filter"], warnings)))
    if not parts:
        return df.limit(0)
    if all(m == "all" for m, _ in parts):
        return dedup_rows(df.filter(reduce(lambda a, b: a | b, [c for _, c in parts])))
    frames = []
    for mode, cond in parts:
        f = df.filter(cond)
        if mode != "all":
            f = composite_rows(f, pid, last=(mode == "last"))
        frames.append(f)
    return dedup_rows(reduce(lambda a, b: a.unionByName(b), frames))


def distinct_participants(df: DataFrame, pid: str) -> DataFrame:
    return df.select(_c(pid)).distinct()
