"""Distinct counts from merged bitmaps against COUNT(DISTINCT), over several bitmaps of numbers."""

import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import bitmaps


@pytest.fixture(scope="module")
def facts(spark):
    rnd = random.Random(6)
    rows = [(d, rnd.choice("abc"), rnd.choice([None, f"p{rnd.randrange(300)}", "frequent"])) for d in range(30) for _ in range(120)]
    return spark.createDataFrame(rows, "day int, zip string, person string").repartition(5).cache()


@pytest.mark.parametrize("by", [["zip"], ["day"], ["day", "zip"], []])
def test_any_level_and_range(spark, facts, by):
    made = bitmaps.stored_bitmaps(facts, ["day", "zip"], "person")
    inside = F.col("day").between(3, 17)
    got = bitmaps.count_distinct(made.filter(inside), by, "n")
    want = facts.filter(inside).groupBy(*by).agg(F.count_distinct("person").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_numbers_are_dense_and_fill_several_bitmaps(spark):
    many = spark.range(70_000).select((F.col("id") * 7919).alias("x"), (F.col("id") % 2).alias("g"))
    numbers = bitmaps.dense_numbers(many, "x")
    assert numbers.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()[:] == (1, 70_000, 70_000)
    made = bitmaps.distinct_bitmaps(many, ["g"], "x", numbers)
    assert made.select("bucket").distinct().count() == 3
    assert {r["g"]: r["n"] for r in bitmaps.count_distinct(made, ["g"], "n").collect()} == {0: 35_000, 1: 35_000}
    assert bitmaps.count_distinct(made, [], "n").first()["n"] == 70_000


def test_nothing(spark, facts):
    made = bitmaps.stored_bitmaps(facts.limit(0), ["day"], "person")
    assert bitmaps.count_distinct(made, ["day"], "n").count() == 0
