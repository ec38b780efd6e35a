"""Series with gaps, frames and warm-up, on literal rows."""

import datetime as dt

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaarlens.functions import months_index
from bazaarlens.operators.series import densify, full_frame_only, month_spine, trailing
from bazaarlens.plans.trend import change_pct


def sparse(spark):
    rows = [("2016-09-01", 135), ("2016-10-01", 40325), ("2016-12-01", 11)]
    return spark.createDataFrame(rows, "m string, revenue long").select(F.col("m").cast("date").alias("month"), "revenue")


def test_spine_is_inclusive(spark):
    months = [r["month"] for r in month_spine(spark, "2016-11-01", "2017-02-01").collect()]
    assert months == [dt.date(2016, 11, 1), dt.date(2016, 12, 1), dt.date(2017, 1, 1), dt.date(2017, 2, 1)]


def test_lag_across_a_gap(spark):
    by_month = W.orderBy("month")
    naive = sparse(spark).withColumn("prev", F.lag("month").over(by_month)).filter("revenue = 11").first()
    assert naive["prev"] == dt.date(2016, 10, 1)
    dense = densify(month_spine(spark, "2016-09-01", "2016-12-01"), sparse(spark), {"revenue": 0})
    growth = dense.select("month", change_pct(F.col("revenue"), F.lag("revenue").over(by_month)).alias("g"))
    got = {r["month"].month: r["g"] for r in growth.collect()}
    assert got[9] is None and got[11] == -100.0 and got[12] is None


def test_rows_and_range_differ_at_the_gap(spark):
    rows = W.orderBy("month").rowsBetween(-2, 0)
    months = W.orderBy(months_index("month")).rangeBetween(-2, 0)
    last = sparse(spark).select(
        "month", F.round(F.avg("revenue").over(rows), 0).alias("r"), F.round(F.avg("revenue").over(months), 0).alias("m")
    ).orderBy(F.desc("month")).first()
    assert (last["r"], last["m"]) == (13490.0, 20168.0)


def test_warm_up_guard_and_prior_frame(spark):
    dense = spark.range(1, 6).select(F.col("id").alias("month"), (F.col("id") * 10).alias("v"))
    three, prior = trailing("month", 2), trailing("month", 3, 1)
    rows = dense.select(
        "month", full_frame_only(F.sum("v").over(three), three, 3).alias("s"),
        full_frame_only(F.sum("v").over(prior), prior, 3).alias("p")).orderBy("month").collect()
    assert [r["s"] for r in rows] == [None, None, 60, 90, 120]
    assert [r["p"] for r in rows] == [None, None, None, 60, 90]
