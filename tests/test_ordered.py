"""The distributed scan against plain windows, on data with one hot group."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaarlens.operators.ordered import ntile, ordered_scan, pareto, running_with_peers, value_ranks
from bazaarlens.operators.skew import join_per_key
from bazaarlens.operators.topk import best_per_group, ranked_top_k, top_n_per_group, top_row_numbers
from bazaarlens.sources.durable import cut_lineage


@pytest.fixture(scope="module")
def skewed(spark):
    """9,000 rows: group 0 holds half of them, group 7 is NULL, many ties in v."""
    g = F.when(F.col("id") % 2 == 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 7)
    v = F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") * 37 % 50).cast("decimal(12,2)"))
    return cut_lineage(spark.range(9000).select("id", g.alias("g"), v.alias("v"), (F.col("id") % 90).alias("d")))


def same(left, right):
    order = sorted(left.columns)
    assert order == sorted(right.columns)
    a, b = left.select(order), right.select(order)
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_scan_equals_window(skewed, by, partitions):
    got = ordered_scan(skewed, [F.desc("d"), "id"], by, "n", {"run": "v"}, {"prev": "v"}, partitions=partitions)
    w = W.partitionBy(*by).orderBy(F.desc("d"), "id")
    want = skewed.select(
        "*",
        F.row_number().over(w).cast("long").alias("n"),
        F.sum("v").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("run"),
        F.lag("v").over(w).alias("prev"),
    )
    same(got, want)


def test_hot_group_spreads_over_partitions(spark, skewed):
    placed = skewed.repartitionByRange(8, "g", "id").withColumn("p", F.spark_partition_id())
    hot = placed.filter("g = 0").groupBy("p").count().agg(F.max("count")).first()[0]
    assert hot < 4500 / 2


def test_totals_span_all_groups(skewed):
    got = ordered_scan(skewed, ["id"], ["g"], number=None, totals={"n": "*", "s": "v"}).select("n", "s").distinct().collect()
    want = skewed.agg(F.count("*"), F.sum("v")).first()
    assert [tuple(r) for r in got] == [tuple(want)]


@pytest.mark.parametrize("small", [0, 1000])
def test_join_per_key_with_a_hot_and_a_null_key(skewed, small):
    per_key = skewed.filter("g is null or g <> 3").groupBy("g").agg(F.count("*").alias("n"), F.sum("d").alias("s"))
    got = join_per_key(skewed, per_key, ["g"], "n", small=small)
    want = skewed.filter("g is null or g <> 3").withColumn("s", F.sum("d").over(W.partitionBy("g")))
    same(got, want)


def test_scan_of_nothing(spark):
    empty = spark.createDataFrame([], "g int, d int, v decimal(10,2)")
    assert ordered_scan(empty, ["d"], ["g"], "n", {"run": "v"}).collect() == []


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranks_equal_windows(skewed, by):
    got = value_ranks(skewed, "d", by, True, "r", "dr", "cd")
    w = W.partitionBy(*by).orderBy(F.desc("d"))
    want = skewed.select(
        "*", F.rank().over(w).cast("long").alias("r"), F.dense_rank().over(w).cast("long").alias("dr"),
        F.cume_dist().over(w).alias("cd"))
    same(got, want)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_peers_share_their_total(skewed, by):
    got = running_with_peers(skewed, "d", "v", "run", by)
    want = skewed.withColumn("run", F.sum("v").over(W.partitionBy(*by).orderBy("d")))
    same(got.select(want.columns), want)


@pytest.mark.parametrize("buckets", [1, 3, 10, 9001])
def test_ntile_equals_window(skewed, buckets):
    got = ntile(skewed, [F.desc("d"), "id"], buckets, "b")
    want = skewed.withColumn("b", F.ntile(buckets).over(W.orderBy(F.desc("d"), "id")).cast("long"))
    same(got, want)


def test_ntile_of_a_few_rows(spark):
    few = spark.range(3)
    assert sorted(r["b"] for r in ntile(few, ["id"], 10, "b").collect()) == [1, 2, 3]


def test_pareto_first_row_crosses(spark):
    one_giant = spark.createDataFrame([(1, 60), (2, 30), (3, 10)], "id int, v int").withColumn("v", F.col("v").cast("decimal(10,2)"))
    rows = pareto(one_giant, "v", "id", [25, 50, 80, 99]).orderBy("position").collect()
    assert [(r["position"], r["cumulative_pct"]) for r in rows] == [(1, 60.0), (2, 90.0), (3, 100.0)]


@pytest.mark.parametrize("ties, function", [("rank", F.rank), ("dense_rank", F.dense_rank)])
def test_top_n_keeps_ties_of_a_hot_group(skewed, ties, function):
    rows = skewed.filter("g is not null")
    got = top_n_per_group(rows, "g", "d", 3, ties, "place")
    w = W.partitionBy("g").orderBy(F.desc("d"))
    want = rows.withColumn("place", function().over(w).cast("long")).filter("place <= 3")
    same(got, want)


def test_ranks_inside_top_k(spark):
    # Two ties of two, as in a league table.
    units = [(1, 89), (2, 79), (3, 68), (4, 68), (5, 59), (6, 53), (7, 53), (8, 50), (9, 50)]
    rows = ranked_top_k(spark.createDataFrame(units, "id int, n int"), 8, "n", "id").orderBy("row_number").collect()
    assert [r["row_number"] for r in rows] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert [r["rank"] for r in rows] == [1, 2, 3, 3, 5, 6, 6, 8]
    assert [r["dense_rank"] for r in rows] == [1, 2, 3, 3, 4, 5, 5, 6]


def test_row_numbers_give_exactly_n(skewed):
    rows = top_row_numbers(skewed.filter("g is not null"), "g", [F.desc("d"), "id"], 2)
    assert {r["count"] for r in rows.groupBy("g").count().collect()} == {2}


def test_best_per_group_breaks_ties_by_label(spark):
    rows = spark.createDataFrame([("x", "b", 5), ("x", "a", 5), ("x", "c", 1), ("y", "z", -2)], "g string, c string, v int")
    best = {r["g"]: (r["c"], r["v"], r["group_total"]) for r in best_per_group(rows, "g", "v", "c").collect()}
    assert best == {"x": ("a", 5, 11), "y": ("z", -2, -2)}
