"""Spark SQL expression text for the per-column and per-config loops.

Building a Column through the Python API costs a few JVM round trips per
function; a spec with hundreds of config columns would spend most of its
planning time there. Loops over columns or configs therefore emit one SQL
expression text and hand it to ``F.expr`` in one call. Semantics are the same
as the Column builders in ``types`` and ``scalars``.
"""

from __future__ import annotations

from . import types as TY

_SQL_TYPES = {TY.INT: "BIGINT", TY.FLOAT: "DOUBLE", TY.STRING: "STRING", TY.BOOL: "BOOLEAN", TY.NULL: "STRING"}


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def lit(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"CAST({v} AS BIGINT)"
    if isinstance(v, float):
        if v != v:
            return "CAST('NaN' AS DOUBLE)"
        if v in (float("inf"), float("-inf")):
            return f"CAST('{'-' if v < 0 else ''}Infinity' AS DOUBLE)"
        return f"CAST({v!r} AS DOUBLE)"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def sql_type(fam: str) -> str:
    return _SQL_TYPES.get(fam, "STRING")


def is_missing(c: str, fam: str) -> str:
    return f"({c} IS NULL OR isnan({c}))" if fam == TY.FLOAT else f"({c} IS NULL)"


def int_trunc(c: str, fam: str) -> str:
    """Python ``int(float(x))``; null when not a number."""
    if fam in (TY.INT, TY.BOOL):
        return f"CAST({c} AS BIGINT)"
    if fam == TY.FLOAT:
        return f"try_cast({c} AS BIGINT)"
    return f"try_cast({TY.text_double_sql(c)} AS BIGINT)"


def py_str(c: str, fam: str) -> str:
    if fam in (TY.STRING, TY.NULL, TY.INT, TY.OTHER, TY.DATETIME):
        return f"CAST({c} AS STRING)"
    if fam == TY.BOOL:
        return f"(CASE WHEN {c} IS NULL THEN NULL WHEN {c} THEN 'True' ELSE 'False' END)"
    d = f"CAST({c} AS DOUBLE)"
    js = f"CAST({d} AS STRING)"
    ex = f"CAST(substring_index({js}, 'E', -1) AS INT)"
    expo = (f"concat(regexp_replace(substring_index({js}, 'E', 1), '\\\\.0$', ''), 'e', "
            f"CASE WHEN {ex} < 0 THEN '-' ELSE '+' END, "
            f"CASE WHEN abs({ex}) < 10 THEN concat('0', CAST(abs({ex}) AS STRING)) ELSE CAST(abs({ex}) AS STRING) END)")
    return (f"(CASE WHEN isnan({d}) THEN 'nan' WHEN {d} = CAST('Infinity' AS DOUBLE) THEN 'inf' "
            f"WHEN {d} = CAST('-Infinity' AS DOUBLE) THEN '-inf' "
            f"WHEN {d} = floor({d}) AND abs({d}) < 1e16 THEN concat(CAST(CAST({d} AS BIGINT) AS STRING), '.0') "
            f"WHEN abs({d}) >= 1e-4 AND abs({d}) < 1e16 AND {js} NOT LIKE '%E%' THEN {js} "
            f"WHEN abs({d}) >= 1e-4 AND abs({d}) < 1 THEN concat(CASE WHEN {d} < 0 THEN '-' ELSE '' END, '0.000', "
            f"regexp_replace(regexp_replace(substring_index({js}, 'E', 1), '[-.]', ''), '0+$', '')) "
            f"WHEN abs({d}) >= 1e-4 AND abs({d}) < 1e16 "
            f"THEN regexp_replace(CAST(try_cast({d} AS DECIMAL(38,18)) AS STRING), '0+$', '') "
            f"WHEN {js} LIKE '%E%' THEN {expo} ELSE {js} END)")


def to_family(c: str, src: str, dst: str) -> str:
    if src == dst:
        return c
    if src == TY.NULL:
        return f"CAST({c} AS {sql_type(dst)})"
    if dst == TY.STRING:
        return py_str(c, src)
    if dst == TY.FLOAT and src in (TY.INT, TY.FLOAT, TY.BOOL):
        return f"CAST({c} AS DOUBLE)"
    return f"CAST({c} AS {sql_type(dst)})"


def keep_value(c: str, fam: str, skip_values) -> str:
    """Expansion: the value is present and not a skip value (int-cast when it
    is a number, compared as it is otherwise)."""
    ints, texts = [], []
    for s in skip_values or []:
        if isinstance(s, bool) or isinstance(s, int):
            ints.append(int(s))
        elif isinstance(s, float) and s == s and s not in (float("inf"), float("-inf")) and s.is_integer():
            ints.append(int(s))
        elif isinstance(s, str):
            texts.append(s)
    iv = int_trunc(c, fam)
    skip_num = f"{iv} IN ({', '.join(str(i) for i in ints)})" if ints else "false"
    skip_txt = f"{py_str(c, fam)} IN ({', '.join(lit(t) for t in texts)})" if texts else "false"
    skipped = f"(CASE WHEN {iv} IS NOT NULL THEN {skip_num} ELSE {skip_txt} END)"
    return f"(NOT {is_missing(c, fam)} AND NOT coalesce({skipped}, false))"


def case_on(key: str, branches: list[tuple[int, str]], otherwise: str) -> str:
    if not branches:
        return otherwise
    body = " ".join(f"WHEN {k} THEN {v}" for k, v in branches)
    return f"(CASE {key} {body} ELSE {otherwise} END)"
