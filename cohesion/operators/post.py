"""Post-processing of the mapped table (``post_processing: [...]``).

Order: drop rows missing a ``required`` field, then the listed steps in spec
order, then the conditional-null rule. All are narrow projections or
filters; ``convert_nullable_int: auto`` on text columns needs one small
aggregation to learn whether the column is numeric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import types as TY
from ..functions.predicates import compile_condition, df_resolver
from .clean import clean_numeric, resolve_patterns

# Name fragments that mark integer-like output columns for
# ``convert_nullable_int: auto``; and the default conditional-null rule.
NULLABLE_INT_PATTERNS = ("age_at_", "age_", "duration", "_days", "_count", "number_of_")
DEFAULT_NULL_UNLESS = {"field": "age_at_death", "when_field": "vital_status", "equals": "Deceased"}


def _c(n: str) -> Column:
    return F.expr("`" + n.replace("`", "``") + "`")


def _fams(df: DataFrame) -> dict[str, str]:
    return {f.name: TY.family(f.dataType) for f in df.schema.fields}


def drop_null_required(df: DataFrame, validations: list) -> DataFrame:
    req = [v.get("field") for v in validations or [] if isinstance(v, dict) and v.get("type") == "required"]
    fams = _fams(df)
    req = [r for r in req if r in fams]
    if not req:
        return df
    cond = None
    for r in req:
        ok = ~TY.is_missing(_c(r), fams[r])
        cond = ok if cond is None else cond & ok
    return df.filter(cond)


def nullable_int(df: DataFrame, columns) -> DataFrame:
    """Whole numbers with nulls: round half to even, then bigint. Text columns
    convert only when every value is a whole number text."""
    fams = _fams(df)
    if columns == "auto" or columns is None:
        cands = [c for c in df.columns if any(p in c.lower() for p in NULLABLE_INT_PATTERNS)]
        cands = [c for c in cands if fams[c] in (TY.FLOAT, TY.STRING, TY.NULL)]
    else:
        cands = [c for c in (columns if isinstance(columns, list) else [columns]) if c in fams]
    cols = {}
    text = [c for c in cands if fams[c] == TY.STRING]
    ok_text = set()
    if text:
        # one pass: is every non-null value numeric (auto), and whole (cast)?
        row = df.agg(*[
            F.count_if(_c(c).isNotNull() & TY.text_double(_c(c)).isNull()).alias(f"n{i}")
            for i, c in enumerate(text)
        ] + [
            F.count_if(_c(c).isNotNull() & S_strip(_c(c)).try_cast("bigint").isNull()).alias(f"w{i}")
            for i, c in enumerate(text)
        ]).collect()[0]
        for i, c in enumerate(text):
            if row[f"n{i}"] == 0 and row[f"w{i}"] == 0:
                ok_text.add(c)
    for c in cands:
        fam = fams[c]
        if fam == TY.FLOAT:
            cols[c] = F.bround(_c(c), 0).try_cast("long")  # NaN and infinities are null
        elif fam == TY.INT:
            cols[c] = _c(c).cast("long")
        elif fam == TY.BOOL:
            cols[c] = _c(c).cast("long")
        elif fam == TY.STRING and c in ok_text:
            cols[c] = S_strip(_c(c)).try_cast("bigint")
    return df.withColumns(cols) if cols else df


def S_strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def null_unless(df: DataFrame, field: str, when_field: str, equals) -> DataFrame:
    fams = _fams(df)
    if field not in fams or when_field not in fams:
        return df
    keep = F.coalesce(_c(when_field) == TY.lit_of(equals), F.lit(False)) if TY.comparable(
        fams[when_field], TY.value_family(equals)) else F.lit(False)
    return df.withColumn(field, F.when(keep, _c(field)).otherwise(F.lit(None).cast(df.schema[field].dataType)))


def _tracked(df: DataFrame, field: str, when_field: str, equals, track: dict[str, str] | None) -> DataFrame:
    """null_unless; with ``track``, a column of it tells whether the field held a value before, so that both counts can be
    taken at the end of the plan, where they keep no filter from the scan."""
    if track is not None and field in df.columns and when_field in df.columns:
        had = f"__had_{len(track)}"
        track[had] = field
        df = df.withColumn(had, _c(field).isNotNull())
    return null_unless(df, field, when_field, equals)


def postprocess(df: DataFrame, steps: list, validations: list, warnings: list[str], rules: list | None = None,
                track: dict[str, str] | None = None) -> DataFrame:
    """``track`` gets {column: field} for each conditional-null rule: whether the field held a value before it."""
    df = drop_null_required(df, validations)
    for step in steps or []:
        if not isinstance(step, dict):
            continue
        t = step.get("type")
        if t == "filter_records":
            # the step itself is the condition: {type, field, op, value} or {type, any|all}
            df = df.filter(compile_condition(step, df_resolver(df), warnings))
        elif t == "clean_numeric":
            df = clean_numeric(df, resolve_patterns(df, step.get("fields", [])))
        elif t == "convert_nullable_int":
            df = nullable_int(df, step.get("columns", "auto"))
        elif t == "null_unless":
            df = _tracked(df, step["field"], step["when_field"], step.get("equals"), track)
        else:
            warnings.append(f"unknown post_processing type {t!r} skipped")
    for r in rules if rules is not None else [DEFAULT_NULL_UNLESS]:
        df = _tracked(df, r["field"], r["when_field"], r["equals"], track)
    return df
