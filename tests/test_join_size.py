"""Joins whose keys are counted first: the expected rows, and keys split on both sides."""
import re

import pytest

from cohesion.sources import multifile as MF


def sides(spark):
    left = spark.createDataFrame([(None if i % 3 == 0 else i % 40, i) for i in range(600)], "k long, a long")
    right = spark.createDataFrame([(None if i % 3 == 0 else i % 50 + 20, i) for i in range(300)], "k long, b long")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "right", "full_outer"])
@pytest.mark.parametrize("nulls_match", [True, False])
def test_split_join_equals_the_plain_one(spark, how, nulls_match):
    left, right = sides(spark)
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    plain = MF.join_sources(left, right, ["k"], how, nulls_match=nulls_match)
    split = MF.join_sources(left, right, ["k"], how, nulls_match=nulls_match, split=100)
    assert key(plain) == key(split)
    told = MF.expected_rows(left, right, ["k"], how, nulls_match).first()
    assert (told.left_rows, told.right_rows, told.out_rows) == (600, 300, plain.count())
    if nulls_match:
        assert told.largest_key == 200 * 100


def test_parts_are_even_and_no_key_means_the_plain_plan(spark):
    left, right = sides(spark)
    split = MF.join_sources(left, right, ["k"], "left", split=400)
    assert "Union" in split._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in MF.join_sources(left, right, ["k"], "left", split=True)._jdf.queryExecution().optimizedPlan().toString()
    hot = MF._hot_keys(left, right, ["k"], True, 400).collect()
    assert [(r["__k0"], r["__a"], r["__b"]) for r in hot] == [(None, 10, 5)]


def test_empty_sides(spark):
    left, right = sides(spark)
    assert MF.join_sources(left.limit(0), right, ["k"], "right", split=10).count() == 300
    assert tuple(MF.expected_rows(left.limit(0), right.limit(0), ["k"]).first()) == (0, 0, 0, 0)


def test_copies_of_a_split_key_grow_as_its_rows(spark, monkeypatch):
    monkeypatch.setattr(MF, "PARTS", 64)
    copies = []
    for n in (400, 1600):
        left = spark.range(n).selectExpr("IF(id % 2 = 0, null, id) AS k", "id AS a")
        right = spark.range(n // 4).selectExpr("IF(id % 2 = 0, null, id) AS k", "id AS b")
        hot = MF._hot_keys(left, right, ["k"], True, 4)
        h = hot.first()
        assert h["__a"] * h["__b"] <= 1.3 * MF.PARTS
        copies.append(MF._dealt(left, ["k"], hot, "__i", "__j", "__a", "__b").count())
        key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
        assert key(MF.join_sources(left, right, ["k"], "full_outer", split=4)) == key(MF.join_sources(left, right, ["k"], "full_outer"))
    assert copies[1] <= 1.3 * 4 * copies[0]


def nulls(spark, nl, nr):
    return spark.range(nl).selectExpr("CAST(null AS long) AS k", "id AS a"), spark.range(nr).selectExpr("CAST(null AS long) AS k", "id AS b")


def test_rows_of_a_split_key_come_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(MF, "PACK", 8)
    monkeypatch.setattr(MF, "GATHER", 64)
    left, right = nulls(spark, 320, 160)
    out = [tuple(r) for r in MF.join_sources(left, right, ["k"], "full_outer", split=10_000).select("a", "b").collect()]
    assert sorted(out) == [(a, b) for a in range(320) for b in range(160)]
    seen, gaps = {}, []
    for at, (_, b) in enumerate(out):
        gaps.append(at - seen.get(b, at))
        seen[b] = at
    assert sorted(gaps)[len(gaps) // 2] <= 8


def test_rows_travel_in_packs_each_once_a_part(spark, monkeypatch):
    monkeypatch.setattr(MF, "PACK", 8)
    left, right = nulls(spark, 320, 160)
    hot = MF._hot_keys(left, right, ["k"], True, 10_000)
    h = hot.first()
    packs = MF._dealt(left, ["k"], hot, "__i", "__j", "__a", "__b").collect()
    assert max(len(p["__rows"]) for p in packs) == 8 and len(packs) <= h["__b"] * (320 // 8 + h["__a"])
    assert sorted((r["a"], p["__j"]) for p in packs for r in p["__rows"]) == [(a, j) for a in range(320) for j in range(h["__b"])]
    assert len({(r["a"], p["__i"]) for p in packs for r in p["__rows"]}) == 320


def test_tasks_of_split_keys_are_told_by_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(MF, "PART_PAIRS", 2000)
    left, right = nulls(spark, 320, 160)
    split = MF.join_sources(left, right, ["k"], "full_outer", split=1000)
    assert split.rdd.getNumPartitions() >= 320 * 160 // 2000
    assert split.count() == 320 * 160


def test_split_keys_that_differ_in_bytes_only(spark):
    left = spark.createDataFrame([(k, s, i) for i in range(40) for k in (0.0, -0.0, float("nan"), None) for s in ("x", None)], "k double, s string, a long")
    right = left.withColumnRenamed("a", "b")
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    split = MF.join_sources(left, right, ["k", "s"], "full_outer", split=50)
    assert list(map(repr, key(split))) == list(map(repr, key(MF.join_sources(left, right, ["k", "s"], "full_outer"))))


def test_a_left_pack_does_not_keep_all_its_rows(spark):
    left, right = nulls(spark, 320, 160)
    split = MF.join_sources(left, right, ["k"], "full_outer", split=1000)
    split.collect()
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Generate inline\(transform", plan) and not re.search(r"\*\(\d+\) Generate inline\(transform", plan)
    assert re.search(r"\*\(\d+\) Generate inline\(__r_rows", plan)
