"""Source-side cleaning and derivation steps (``preprocessing: [...]``).

Each step is a narrow projection (``withColumns``) except the two that need a
fact about a whole column: ``clean_numeric: auto`` (is this text column
numeric?) and ``convert_to_numeric`` with ``errors: raise|ignore``. Those run
one small aggregation job over the column(s) and nothing else.
"""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import types as TY
from ..functions.formula import compile_formula
from ..functions.predicates import SpecError, df_resolver

# Fixed value: a text column is numeric for ``auto`` when any of its values matches
# this pattern. Every value counts, not the first hundred, so row order has no part.
AUTO_NUMERIC_PATTERN = r"^[\d,\s]+\.?\d*$"


def _c(n: str) -> Column:
    return F.expr("`" + n.replace("`", "``") + "`")


def _fams(df: DataFrame) -> dict[str, str]:
    return {f.name: TY.family(f.dataType) for f in df.schema.fields}


def resolve_patterns(df: DataFrame, fields, order_col: str | None = None) -> list[str]:
    """Exact names, ``*``/``?`` wildcards (case-sensitive) or ``auto``."""
    if fields in ("auto", ["auto"]):
        return auto_numeric_columns(df, order_col)
    if isinstance(fields, str):
        fields = [fields]
    out: list[str] = []
    for f in fields or []:
        if any(ch in str(f) for ch in "*?"):
            for c in df.columns:
                if fnmatch.fnmatchcase(c, str(f).replace("[", "[[]")) and c not in out and not c.startswith("__"):
                    out.append(c)
        elif f not in out:
            out.append(f)
    return out


def auto_numeric_columns(df: DataFrame, order_col: str | None = None) -> list[str]:
    """Text columns of which any value looks numeric: one aggregation, one flag per column."""
    fams = _fams(df)
    text_cols = [c for c in df.columns if fams[c] == TY.STRING and not c.startswith("__")]
    if not text_cols:
        return []
    found = df.agg(*[F.max(_c(c).rlike(AUTO_NUMERIC_PATTERN)).alias(f"f{i}") for i, c in enumerate(text_cols)]).collect()[0]
    return [c for i, c in enumerate(text_cols) if found[f"f{i}"]]


def clean_numeric(df: DataFrame, fields) -> DataFrame:
    fams = _fams(df)
    cols = {}
    for f in fields:
        if f not in fams:
            continue
        if fams[f] == TY.INT:
            continue  # whole numbers are clean; through double they would lose digits
        cols[f] = TY.nan_to_null(TY.text_double(F.regexp_replace(TY.py_str(_c(f), fams[f]), "[, ]", "")))
    return df.withColumns(cols) if cols else df


def text_step(df: DataFrame, fields, fn) -> DataFrame:
    fams = _fams(df)
    cols = {f: fn(TY.py_str(_c(f), fams[f])) for f in (fields or []) if f in fams}
    return df.withColumns(cols) if cols else df


def replace_missing_codes(df: DataFrame, codes, fields) -> DataFrame:
    """Codes -> null (list) or -> value (dict), type-strict; then numeric."""
    fams = _fams(df)
    mapping = {c: None for c in codes} if isinstance(codes, list) else dict(codes or {})
    targets = fields if fields else [c for c in df.columns if not c.startswith("__")]
    cols = {}
    for f in targets:
        if f not in fams:
            continue
        fam = fams[f]
        c = _c(f)
        expr = None
        for k, v in mapping.items():
            if not TY.comparable(fam, TY.value_family(k)) or k is None:
                continue
            if TY.value_family(v) == TY.STRING:
                v_num = None
                try:
                    v_num = float(v)
                except ValueError:
                    v_num = None
                val = F.lit(v_num).cast("double")
            else:
                val = F.lit(None if v is None else float(v)).cast("double")
            cond = c == TY.lit_of(k)
            expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        if fam in (TY.INT, TY.FLOAT, TY.BOOL):
            base = c.cast("double")
        else:
            base = TY.text_double(TY.py_str(c, fam))
        base = TY.nan_to_null(base)
        cols[f] = base if expr is None else expr.otherwise(base)
    return df.withColumns(cols) if cols else df


# Fixed value: how far a number may move when it becomes single precision.
FLOAT_TOLERANCE = 5e-4


def _single(c: Column) -> Column:
    """A number as single precision shows it, as a double."""
    return c.cast("float").cast("string").cast("double")


def convert_to_numeric(df: DataFrame, fields, errors: str = "coerce", downcast: str | None = None) -> DataFrame:
    """Text columns become double. ``errors``: coerce (null), raise, or ignore (such a column stays text). ``downcast``: integer, signed or
    unsigned turn a column of whole numbers without nulls into bigint (unsigned: if none is negative), so that ids show ``1`` and not
    ``1.0``; float turns numbers into what single precision holds if none moves by more than FLOAT_TOLERANCE. What the
    columns hold is learned in one aggregation, and only if errors or downcast ask for it."""
    if downcast not in (None, "integer", "signed", "unsigned", "float"):
        raise SpecError(f"convert_to_numeric: unknown downcast {downcast!r}")
    fams = _fams(df)
    fields = list(dict.fromkeys(f for f in (fields or []) if f in fams))
    conv = {f: TY.nan_to_null(TY.text_double(TY.py_str(_c(f), fams[f]))) for f in fields if fams[f] not in (TY.INT, TY.FLOAT, TY.BOOL) or fams[f] == TY.BOOL and not downcast}
    narrow = [f for f in fields if downcast and fams[f] != TY.BOOL and not (downcast != "float" and fams[f] == TY.INT)]
    strict = errors in ("raise", "ignore")
    value = {f: conv.get(f, TY.nan_to_null(_c(f).cast("double"))) for f in [*conv, *narrow]}
    aggs = [F.count_if(_c(f).isNotNull() & e.isNull()).alias(f"bad_{i}") for i, (f, e) in enumerate(conv.items())] if strict else []
    for i, f in enumerate(narrow):
        v = value[f]
        if downcast == "float":
            aggs.append((F.coalesce(F.max(F.abs(_single(v) - v)), F.lit(0.0)) <= FLOAT_TOLERANCE).alias(f"fits_{i}"))
        else:
            least = F.lit(0.0 if downcast == "unsigned" else -2.0**63)
            whole = v.isNotNull() & (v == F.floor(v)) & (v >= least) & (v < 2.0**63)
            aggs.append((F.count_if(~F.coalesce(whole, F.lit(False))) == 0).alias(f"fits_{i}"))
    told = df.agg(*aggs).first() if aggs else None
    if strict:
        failing = [f for i, f in enumerate(conv) if told[f"bad_{i}"]]
        if failing and errors == "raise":
            raise SpecError(f"convert_to_numeric: non-numeric values in {failing}")
        conv = {f: e for f, e in conv.items() if f not in failing}
        narrow = [f if f not in failing else None for f in narrow]
    for i, f in enumerate(narrow):
        if f and told[f"fits_{i}"]:
            conv[f] = _single(value[f]) if downcast == "float" else value[f].cast("long")
    return df.withColumns(conv) if conv else df


def calculate_field(df: DataFrame, target: str, formula: str) -> DataFrame:
    col, _ = compile_formula(formula, df_resolver(df))
    return df.withColumn(target, col)


def construct_date(df: DataFrame, target: str, params: dict) -> DataFrame:
    yf, mf, dfld = params.get("year_field"), params.get("month_field"), params.get("day_field")
    default_day = params.get("default_day", S.PARTIAL_DATE_DAY)
    fams = _fams(df)

    def get(n):
        return (_c(n), fams[n]) if n and n in fams else None

    y, m = get(yf), get(mf)
    nul = F.lit(None).cast("string")
    if y is None or m is None:
        return df.withColumn(target, nul)
    return df.withColumn(target, S.construct_date(y, m, get(dfld), default_day))


def apply_steps(df: DataFrame, steps: list, warnings: list[str], order_col: str | None = None) -> DataFrame:
    for step in steps or []:
        if not isinstance(step, dict):
            continue
        t = step.get("type")
        fields = step.get("fields", [])
        if t == "clean_numeric":
            df = clean_numeric(df, resolve_patterns(df, fields, order_col))
        elif t == "strip_whitespace":
            df = text_step(df, fields, S.strip)
        elif t == "uppercase":
            df = text_step(df, fields, F.upper)
        elif t == "lowercase":
            df = text_step(df, fields, F.lower)
        elif t == "replace_missing_codes":
            df = replace_missing_codes(df, step.get("codes", {}), fields)
        elif t == "convert_to_numeric":
            df = convert_to_numeric(df, fields, step.get("errors", "coerce"), step.get("downcast"))
        elif t == "calculate_field":
            if not step.get("target") or not step.get("formula"):
                warnings.append("calculate_field skipped: needs target and formula")
                continue
            df = calculate_field(df, step["target"], step["formula"])
        elif t == "construct_date":
            if not step.get("target"):
                continue
            p = step.get("params") or {}
            if not p.get("year_field") or not p.get("month_field"):
                continue
            df = construct_date(df, step["target"], p)
        else:
            warnings.append(f"unknown preprocessing type {t!r} skipped")
    return df
