"""Unit tables for scalar functions, predicates and formulas."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohesion.functions import scalars as S
from cohesion.functions import types as TY
from cohesion.functions.formula import compile_formula
from cohesion.functions.predicates import SpecError, compile_condition, df_resolver


def _one(spark, rows, schema, expr_fn):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr_fn(df)).collect()]


def test_age_with_units(spark):
    vals = ["25", "24 months", "200 days", "17 weeks", "2.5 years", "121", "abc", None]
    got = _one(spark, [(v,) for v in vals], "v string", lambda d: S.age_with_units(F.col("v"), TY.STRING))
    assert got == [9131, 730, 200, 119, 913, None, None, None]
    got = _one(spark, [(25.0,), (121.0,), (None,)], "v double", lambda d: S.age_with_units(F.col("v"), TY.FLOAT))
    assert got == [9131, None, None]


def test_clean_numeric_string_and_safe_int(spark):
    got = _one(spark, [("2,019",), ("1,234.56",), (None,), ("  ",)], "v string",
               lambda d: S.clean_numeric_string(F.col("v")))
    assert got == ["2019", "1234.56", None, None]
    got = _one(spark, [("42",), ("2,019",), ("invalid",), (None,), ("3.7",), ("-3.7",)], "v string",
               lambda d: S.safe_int(F.col("v"), TY.STRING, 0))
    assert got == [42, 2019, 0, 0, 3, -3]


def test_parse_date(spark):
    vals = ["2020-5-1", "2020/05/01", "20200501", "05/13/2020", "13/05/2020", "05/06/2020", "2020-05",
            "2020-02-31", "2020-05-10 00:00:00", " 2020-05-01 ", None]
    got = _one(spark, [(v,) for v in vals], "v string", lambda d: S.parse_date(F.col("v")))
    d = dt.date
    assert got == [d(2020, 5, 1), d(2020, 5, 1), d(2020, 5, 1), d(2020, 5, 13), d(2020, 5, 13), d(2020, 5, 6),
                   d(2020, 5, 15), None, None, d(2020, 5, 1), None]


def test_age_in_days_rules(spark):
    rows = [("1985-03-15", "2020-05-10", None), ("2020-05-10", "1985-03-15", "30"),  # negative: no fallback
            (None, "2020-05-10", "30"), ("bad", "2020-05-10", "2 years")]
    df = spark.createDataFrame(rows, "b string, e string, f string")
    got = [r[0] for r in df.select(S.age_in_days((F.col("b"), TY.STRING), (F.col("e"), TY.STRING),
                                                 (F.col("f"), TY.STRING))).collect()]
    assert got == [12840, None, 10957, 730]


def test_construct_date(spark):
    rows = [("2,019", "5", None), ("2020", "13", "1"), ("2020", "2", "0"), ("2020", "2", "31"), (None, "1", "1"),
            ("2020", "0", "1"), ("2020", "3", "x")]
    df = spark.createDataFrame(rows, "y string, m string, d string")
    got = [r[0] for r in df.select(S.construct_date((F.col("y"), TY.STRING), (F.col("m"), TY.STRING),
                                                    (F.col("d"), TY.STRING))).collect()]
    assert got == ["2019-05-15", None, None, "2020-02-31", None, None, None]


def test_py_str_renders_doubles_like_python(spark):
    got = _one(spark, [(1.0,), (12345678.0,), (0.5,), (None,)], "v double", lambda d: TY.py_str(F.col("v"), TY.FLOAT))
    assert got == ["1.0", "12345678.0", "0.5", None]


def _pred(spark, rows, schema, cond):
    df = spark.createDataFrame(rows, schema)
    w = []
    c = compile_condition(cond, df_resolver(df), w)
    return [r[0] for r in df.select(c).collect()], w


def test_predicates_null_and_type_rules(spark):
    rows = [("a", 1, 1.0), (None, None, None), ("1", 2, 2.5)]
    schema = "s string, i long, d double"
    assert _pred(spark, rows, schema, {"field": "s", "op": "equals", "value": "a"})[0] == [True, False, False]
    assert _pred(spark, rows, schema, {"field": "s", "op": "equals", "value": 1})[0] == [False, False, False]
    assert _pred(spark, rows, schema, {"field": "s", "op": "not_equals", "value": "a"})[0] == [False, True, True]
    assert _pred(spark, rows, schema, {"field": "i", "op": "in", "value": [1, None]})[0] == [True, True, False]
    assert _pred(spark, rows, schema, {"field": "i", "op": "not_in", "value": [1]})[0] == [False, True, True]
    assert _pred(spark, rows, schema, {"field": "d", "op": "greater_than", "value": 1})[0] == [False, False, True]
    assert _pred(spark, rows, schema, {"field": "d", "op": "equals", "value": 1})[0] == [True, False, False]
    assert _pred(spark, rows, schema, {"field": "s", "op": "regex_match_any", "value": ["a", "[0-9]"]})[0] == \
        [True, False, True]
    assert _pred(spark, rows, schema, {"any": []})[0] == [True, True, True]
    got, warn = _pred(spark, rows, schema, {"any": [{"field": "nope", "op": "equals", "value": 1},
                                                    {"field": "i", "op": "equals", "value": 2}]})
    assert got == [True, True, True] and warn
    with pytest.raises(SpecError):
        _pred(spark, rows, schema, {"field": "s", "op": "greater_than", "value": 1})
    with pytest.raises(SpecError):
        _pred(spark, rows, schema, {"field": "s", "op": "regex_match_any", "value": ["("]})


def _formula(spark, rows, schema, text):
    df = spark.createDataFrame(rows, schema)
    c, _ = compile_formula(text, df_resolver(df))
    return [r[0] for r in df.select(c).collect()]


def test_formula_semantics(spark):
    rows = [(7, 2, 1.5), (-7, 2, None), (7, -3, 0.0), (0, 0, 2.0)]
    schema = "a long, b long, x double"
    assert _formula(spark, rows, schema, "a // b") == [3, -4, -3, None]
    assert _formula(spark, rows, schema, "a % b") == [1, 1, -2, None]
    assert _formula(spark, rows, schema, "a / b") == [3.5, -3.5, -7 / 3, None]
    assert _formula(spark, rows, schema, "a / x") == [7 / 1.5, None, float("inf"), 0.0]
    assert _formula(spark, rows, schema, "x.fillna(-1) * 2") == [3.0, -2.0, 0.0, 4.0]
    assert _formula(spark, rows, schema, "(a > 0) & (x > 1)") == [True, False, False, False]
    assert _formula(spark, rows, schema, "a ** 2") == [49, 49, 49, 0]
    assert _formula(spark, rows, schema, "'pos' if a > 0 else 'neg'") == ["pos", "neg", "pos", "neg"]
    with pytest.raises(SpecError):
        _formula(spark, rows, schema, "__import__('os')")
    with pytest.raises(SpecError):
        _formula(spark, rows, schema, "missing_col + 1")


def test_nan_compares_false(spark):
    rows = [(float("nan"),), (5.0,), (None,)]
    got, _ = _pred(spark, rows, "d double", {"field": "d", "op": "greater_than", "value": 1})
    assert got == [False, True, False]
    got, _ = _pred(spark, rows, "d double", {"field": "d", "op": "is_null"})
    assert got == [True, False, True]


def test_py_str_matches_python_repr_for_doubles(spark):
    from cohesion.functions import sqltext as Q

    vals = [0.1, 0.30000000000000004, 12345678.9, 1e-05, 1.5e-07, 1e16, 1.2345e20, 0.0001, 0.00012, -2.5,
            100.0, 1e300, 123456789012.345, 2.5e-4, 12345678.0, -7.25e-9]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [tuple(r) for r in df.select(TY.py_str(F.col("d"), TY.FLOAT),
                                       F.expr(Q.py_str("d", TY.FLOAT))).collect()]
    assert [g[0] for g in got] == [str(v) for v in vals]
    assert [g[1] for g in got] == [str(v) for v in vals]
