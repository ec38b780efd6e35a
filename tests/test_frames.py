"""Trailing frames in blocks against plain windows, with a hot group; closure by doubling."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaarlens.operators import hierarchy
from bazaarlens.operators.frames import trailing_range, trailing_rows


@pytest.fixture(scope="module")
def rows(spark):
    """One group with a third of the rows, many small ones, gaps, ties and NULLs."""
    rnd = random.Random(2)
    out = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else rnd.choice([None, *(f"g{k}" for k in range(200))])
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.choice([0, 5, rnd.randint(0, 900)]))
        out.append((i, group, day, rnd.choice([None, rnd.randint(-50, 50)])))
    return spark.createDataFrame(out, "id long, g string, day date, v int").repartition(7).cache()


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


MEASURES = {"s": ("sum", "v"), "n": ("count", "v"), "low": ("min", "v"), "high": ("max", "v")}


@pytest.mark.parametrize("first,last,block", [(2, 0, 3), (2, 0, 50_000), (3, 1, 10), (40, 0, 7), (0, 0, 5)])
def test_rows(spark, rows, first, last, block):
    frame = W.partitionBy("g").orderBy("day", "id").rowsBetween(-first, -last)
    want = rows.select("*", F.sum("v").over(frame).alias("s"), F.count("v").over(frame).alias("n"), F.min("v").over(frame).alias("low"), F.max("v").over(frame).alias("high"))
    assert same(trailing_rows(rows, ["day", "id"], ["g"], MEASURES, first, last, block), want)


@pytest.mark.parametrize("days", [0, 1, 60, 5000])
def test_range(spark, rows, days):
    frame = W.partitionBy("g").orderBy(F.unix_date("day")).rangeBetween(-days, W.currentRow)
    want = rows.select("*", F.sum("v").over(frame).alias("s"), F.count("v").over(frame).alias("n"), F.min("v").over(frame).alias("low"), F.max("v").over(frame).alias("high"))
    columns = rows.columns + list(MEASURES)
    assert same(trailing_range(rows, "day", ["g"], MEASURES, days).select(columns), want.select(columns))
    whole = rows.withColumn("day", F.unix_date("day").cast("long"))
    assert same(trailing_range(whole, "day", ["g"], MEASURES, days).select("id", "s"), want.select("id", "s"))


def test_a_hot_group_is_cut_into_even_blocks(spark):
    hot = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(-1).alias("g"))
    out = trailing_rows(hot, ["id"], ["g"], {"n": ("count", "id")}, 2, block=100)
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(g" in text and "_block" in text
    assert out.count() == 20_000 and out.filter("n = 3").count() == 6665  # all but two of the hot group's 6,667


def direct(edges):
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    out = {}
    for a in after:
        level, distance = set(after[a]), 1
        while level:
            for b in level:
                out[a, b] = distance
            level = {c for b in level for c in after.get(b, ()) if (a, c) not in out}
            distance += 1
    return out


def pairs(spark, edges):
    frame = spark.createDataFrame(edges, "parent long, child long")
    found = hierarchy.closure(frame).collect()
    assert len(found) == len({(r["ancestor"], r["descendant"]) for r in found})
    return {(r["ancestor"], r["descendant"]): r["distance"] for r in found}


@pytest.mark.parametrize("seed", range(3))
def test_closure_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(25), rnd.randrange(25)) for _ in range(30)] + [(100 + i, 101 + i) for i in range(13)] + [(7, 7)]
    assert pairs(spark, edges) == direct(edges)


def test_closure_takes_a_logarithm_of_rounds(spark, monkeypatch):
    written = []
    cut = hierarchy.cut_lineage
    monkeypatch.setattr(hierarchy, "cut_lineage", lambda df: written.append(1) or cut(df))
    n = 130
    found = pairs(spark, [(i, i + 1) for i in range(n)])
    assert len(found) == n * (n + 1) // 2 and max(found.values()) == n
    assert len(written) <= 8 + 2  # log2(130) is a little over 7
