"""Numbers in texts, large integers, overflow and small doubles, against the rules written by hand."""
import pytest
from pyspark.sql import functions as F

from cohesion.functions import scalars as S
from cohesion.functions import sqltext as Q
from cohesion.functions import types as TY
from cohesion.operators import clean, post
from cohesion.sources.readers import read_file, sniff_delimiter
from cohesion.spec import expand_configs

NOT_NUMBERS = ["5d", "3f", "1D", "2F", "0d", "", "x", "0x1p3"]
NUMBERS = {"5": 5.0, " 7.5 ": 7.5, "-1e3": -1000.0, ".5": 0.5, "3.": 3.0}


def texts(spark):
    return spark.createDataFrame([(t,) for t in [*NOT_NUMBERS, *NUMBERS]], "t string")


def test_text_numbers_follow_float(spark):
    want = dict.fromkeys(NOT_NUMBERS) | NUMBERS
    df = texts(spark)
    assert dict(df.select("t", TY.text_double(F.col("t"))).collect()) == want
    assert dict(df.selectExpr("t", TY.text_double_sql("t")).collect()) == want
    ints = {t: None if v is None else int(v) for t, v in want.items()}
    assert dict(df.select("t", S.to_int_trunc(F.col("t"), TY.STRING)).collect()) == ints
    assert dict(df.selectExpr("t", Q.int_trunc("t", TY.STRING)).collect()) == ints


@pytest.mark.parametrize("text,days", [("5d", None), ("3f", None), ("1D", None), ("5", 1826), ("2 years", 730)])
def test_age_texts(spark, text, days):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(S.age_with_units(F.col("t"), TY.STRING)).first()[0] == days


def test_small_doubles_print_like_python(spark):
    values = [0.0012345678901234567, 0.00012345678901234567, 0.0001, -0.00025, 12345678.9, 1.0, 1e-05, 1e16, 0.5, 123456789012.25]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(TY.py_str(F.col("v"), TY.FLOAT)).collect()] == [str(v) for v in values]
    assert [r[0] for r in df.selectExpr(Q.py_str("v", TY.FLOAT)).collect()] == [str(v) for v in values]


def test_no_overflow_aborts(spark):
    df = spark.createDataFrame([(9007199254740993, 10, 20, float("inf"))], "big long, a long, b long, x double")
    assert clean.clean_numeric(df, ["big"]).first()["big"] == 9007199254740993
    assert clean.calculate_field(df, "p", "a ** b").first()["p"] is None
    assert clean.calculate_field(df, "p", "big * big").first()["p"] is None
    assert post.nullable_int(df, ["x"]).first()["x"] is None


def test_big_ids_stay_apart_and_the_header_names_the_delimiter(spark, tmp_path):
    p = tmp_path / "ids.csv"
    p.write_text("id,v\n1234567890123456789,1\n1234567890123456788,2\n")
    assert read_file(spark, str(p)).select("id").distinct().count() == 2
    t = tmp_path / "t.txt"
    t.write_text("a;b;c\n1,2,3;x;y\n")
    assert sniff_delimiter(spark, str(t)) == ";"


def test_patterns_and_ranges(spark):
    df = spark.createDataFrame([("1", "2")], "`s[1]` string, sx string")
    assert clean.resolve_patterns(df, ["s[1]"]) == ["s[1]"] and clean.resolve_patterns(df, ["s[1]*"]) == ["s[1]"]
    assert clean.resolve_patterns(df, ["auto"]) == ["s[1]", "sx"]
    assert len(expand_configs([{"start": 1, "end": 3, "template": {"field": "f{n}"}}], [])) == 3


def test_valid_age_takes_whole_texts_only(spark):
    df = spark.createDataFrame([("12",), ("12.5",), (None,)], "t string")
    assert [r[0] for r in df.select(S.valid_age(F.col("t"), TY.STRING)).collect()] == [True, False, True]


def test_counts_do_not_wait_for_an_action(spark):
    from cohesion import map_entity

    res = map_entity(spark.createDataFrame([("P1", 1)], "pid string, v long"),
                     {"entity": {"name": "e", "fields": {"base": ["pid"]}}, "mappings": [{"source_field": "pid", "target_field": "pid"}]}, name="e")
    assert set(res.counts().values()) <= {None}
    res.df.collect()
    assert 1 in res.counts().values()
