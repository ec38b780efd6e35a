"""Grouping sets by lattice against SQL, and differences of stored versions."""

import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import lattice
from bazaarlens.sources import versions
from bazaarlens.sources.durable import scratch_path


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(4)
    out = [(rnd.choice(["a", "b", None]), rnd.randrange(6), rnd.choice([None, "x", "y"]), rnd.choice([None, rnd.randint(0, 9)])) for _ in range(700)]
    return spark.createDataFrame(out, "p string, q int, r string, v int").repartition(5)


@pytest.mark.parametrize("sets", [
    [("p",), ("p", "q"), ("p", "q", "r")], [("p", "q", "r"), ("p", "q"), ("q", "r"), ("p",), ("q",), ()], [("p",), ("r",)]])
def test_equals_grouping_sets(spark, rows, sets):
    measures = {"total": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v"), "n": ("count", "v")}
    got = lattice.grouping_lattice(rows, sets, measures)
    columns = list(dict.fromkeys(c for s in sets for c in s))
    wanted = ", ".join(f"({', '.join(s)})" for s in sets)
    bits = f"grouping_id({', '.join(columns)})"
    want = spark.sql(f"select {bits} g, {', '.join(columns)}, sum(v) total, min(v) low, max(v) high, count(v) n from {{rows}} group by grouping sets ({wanted})", rows=rows)
    number = {i: sum(2 ** (len(columns) - 1 - k) for k, c in enumerate(columns) if c not in s) for i, s in enumerate(sets)}
    label = F.element_at(F.create_map(*[F.lit(x) for i, g in number.items() for x in (i, g)]), F.col("set"))
    assert same(got.withColumn("g", label.cast("long")).select(want.columns), want.withColumn("g", F.col("g").cast("long")))


def test_rows_are_read_once_without_expand(spark, rows, monkeypatch):
    plans = []
    cut = lattice.cut_lineage
    monkeypatch.setattr(lattice, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    groups = lattice.grouping_lattice(rows, [("p",), ("p", "q")], {"n": ("groups", None)})
    assert len(plans) == 2 and not any("Expand" in p for p in plans)
    found = {r["p"]: r["n"] for r in groups.filter("set = 0").collect()}
    assert found == {r["p"]: r["n"] for r in rows.select("p", "q").distinct().groupBy("p").agg(F.count("*").alias("n")).collect()}


def test_differences_are_named_and_equal_ranges_are_not_read(spark):
    old = spark.range(3000).select("id", (F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 > 0, F.lit("t")).alias("b"))
    changed = F.when(F.col("id") == 44, F.lit(99)).otherwise(F.col("a"))
    text = F.when(F.col("id") == 45, F.lit("t")).when(F.col("id") != 46, F.col("b"))  # NULL to text, text to NULL
    new = old.filter("id not in (10, 11)").withColumn("a", changed).withColumn("b", text).union(spark.sql("select 5000L, 1L, 'u'"))
    a, b, c = (scratch_path(spark, "version") for _ in range(3))
    versions.write_version(old, ["id"], a, 64)
    versions.write_version(new, ["id"], b, 64)
    versions.write_version(old.repartition(3), ["id"], c, 64)
    found = versions.difference(spark, a, b, old.schema, ["id"])
    assert {(r["id"], r["change"]) for r in found.collect()} == {
        (10, "removed"), (11, "removed"), (44, "changed"), (45, "changed"), (46, "changed"), (5000, "inserted")}
    ranges = versions.changed_ranges(spark, a, b)
    assert 1 <= len(ranges) <= 6
    assert "PartitionFilters: [_range" in found._jdf.queryExecution().executedPlan().toString().replace("isnotnull(", "")
    assert versions.changed_ranges(spark, a, c) == [] and versions.difference(spark, a, c, old.schema, ["id"]).count() == 0


def test_empty_versions(spark):
    some = spark.range(5).select("id", F.lit(1).alias("v"))
    a, b = scratch_path(spark, "version"), scratch_path(spark, "version")
    versions.write_version(some.limit(0), ["id"], a)
    versions.write_version(some, ["id"], b)
    assert {r["change"] for r in versions.difference(spark, a, b, some.schema, ["id"]).collect()} == {"inserted"}
    assert {r["change"] for r in versions.difference(spark, b, a, some.schema, ["id"]).collect()} == {"removed"}
