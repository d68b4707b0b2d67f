"""Type families and Python-style text rendering of Spark values.

The spec language compares values the way Python does: a number never equals
a text, and numbers render as Python prints them (``1.0`` for a whole double).
These helpers decide such questions at plan time from ``DataFrame.schema``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT = "int"
FLOAT = "float"
STRING = "string"
BOOL = "bool"
DATETIME = "datetime"
NULL = "null"
OTHER = "other"

NUMERIC = (INT, FLOAT)


def family(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return INT
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return FLOAT
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return STRING
    if isinstance(dt, T.BooleanType):
        return BOOL
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATETIME
    if isinstance(dt, T.NullType):
        return NULL
    return OTHER


def value_family(v) -> str:
    """Family of a Python literal from a spec."""
    if v is None:
        return NULL
    if isinstance(v, bool):
        return BOOL
    if isinstance(v, int):
        return INT
    if isinstance(v, float):
        return FLOAT
    if isinstance(v, str):
        return STRING
    return OTHER


def comparable(col_fam: str, val_fam: str) -> bool:
    """Would Python/pandas compare these two families by value?"""
    if col_fam in NUMERIC and val_fam in NUMERIC:
        return True
    if col_fam == BOOL and val_fam in (BOOL, INT, FLOAT):
        return True
    if col_fam in NUMERIC and val_fam == BOOL:
        return True
    if col_fam == val_fam:
        return True
    # pandas compares datetime columns with date text by parsing the text
    return col_fam == DATETIME and val_fam == STRING


def spark_type(fam: str) -> T.DataType:
    return {
        INT: T.LongType(),
        FLOAT: T.DoubleType(),
        STRING: T.StringType(),
        BOOL: T.BooleanType(),
        NULL: T.StringType(),
    }.get(fam, T.StringType())


def common_family(a: str, b: str) -> str:
    if a == NULL:
        return b
    if b == NULL or a == b:
        return a
    if a in NUMERIC and b in NUMERIC:
        return FLOAT
    return STRING


def is_missing(c: Column, fam: str) -> Column:
    """pandas ``isna``: null, and NaN for floating columns."""
    if fam == FLOAT:
        return c.isNull() | F.isnan(c)
    return c.isNull()


# Fixed value: the texts Python's float() reads, outer space aside. Java's parser alone also takes
# suffixes such as ``5d`` and ``3f``.
NUMBER_TEXT = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$"


def text_double(c: Column) -> Column:
    """A text as a double; null where Python's float() would raise."""
    s = F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")
    return F.when(s.rlike(NUMBER_TEXT), s.try_cast("double"))


def text_double_sql(c: str) -> str:
    """``text_double`` as SQL text."""
    s = f"regexp_replace(CAST({c} AS STRING), '^\\\\s+|\\\\s+$', '')"
    rx = NUMBER_TEXT.replace("\\", "\\\\")
    return f"(CASE WHEN {s} RLIKE '{rx}' THEN try_cast({s} AS DOUBLE) END)"


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def py_str(c: Column, fam: str) -> Column:
    """Render a value as Python's ``str()`` would (e.g. doubles as ``1.0``)."""
    if fam in (STRING, NULL):
        return c.cast("string")
    if fam == INT:
        return c.cast("string")
    if fam == FLOAT:
        # Python's repr: whole numbers as "1.0"; plain decimals for 1e-4 <= |x| < 1e16;
        # exponent form "1e-05" / "1.5e+16" outside (Java prints "1.0E-5" / "1.5E16").
        d = c.cast("double")
        whole = (d == F.floor(d)) & (F.abs(d) < F.lit(1e16))
        plain = (F.abs(d) >= F.lit(1e-4)) & (F.abs(d) < F.lit(1e16))
        # 1e7 and above have at most ten decimals; 1e-4 to 1e-3 print as d.ddE-4, whose digits follow 0.000
        dec = F.regexp_replace(d.try_cast("decimal(38,18)").cast("string"), "0+$", "")
        js = d.cast("string")
        small = F.concat(F.when(d < 0, F.lit("-")).otherwise(F.lit("")), F.lit("0.000"),
                         F.regexp_replace(F.regexp_replace(F.substring_index(js, "E", 1), r"[-.]", ""), "0+$", ""))
        mant = F.regexp_replace(F.substring_index(js, "E", 1), r"\.0$", "")
        ex = F.substring_index(js, "E", -1).cast("int")
        expo = F.concat(mant, F.lit("e"), F.when(ex < 0, F.lit("-")).otherwise(F.lit("+")),
                        F.when(F.abs(ex) < 10, F.concat(F.lit("0"), F.abs(ex).cast("string")))
                        .otherwise(F.abs(ex).cast("string")))
        return (
            F.when(F.isnan(d), F.lit("nan"))
            .when(d == F.lit(float("inf")), F.lit("inf"))
            .when(d == F.lit(float("-inf")), F.lit("-inf"))
            .when(whole, F.concat(d.cast("long").cast("string"), F.lit(".0")))
            .when(plain & ~js.contains("E"), js)
            .when(plain & (F.abs(d) < F.lit(1.0)), small)
            .when(plain, dec)
            .when(js.contains("E"), expo)
            .otherwise(js)
        )
    if fam == BOOL:
        return F.when(c.isNull(), F.lit(None)).when(c, F.lit("True")).otherwise(F.lit("False"))
    return c.cast("string")


def py_literal_str(v) -> str:
    """``str(v)`` for spec literals (lists become ``|``-joined by callers)."""
    return str(v)


def lit_of(v, fam: str | None = None) -> Column:
    """A typed literal; ``None`` becomes a string-typed null."""
    if v is None:
        return F.lit(None).cast("string")
    if isinstance(v, bool):
        return F.lit(v)
    if isinstance(v, int):
        return F.lit(v).cast("long")
    if isinstance(v, float):
        return F.lit(v).cast("double")
    return F.lit(str(v))


def to_family(c: Column, src_fam: str, dst_fam: str) -> Column:
    """Cast a column between families the way a mixed pandas column would hold it."""
    if src_fam == dst_fam or src_fam == NULL:
        return c.cast(spark_type(dst_fam)) if src_fam == NULL else c
    if dst_fam == STRING:
        return py_str(c, src_fam)
    if dst_fam == FLOAT and src_fam in NUMERIC + (BOOL,):
        return c.cast("double")
    if dst_fam == INT and src_fam == BOOL:
        return c.cast("long")
    return c.cast(spark_type(dst_fam))
