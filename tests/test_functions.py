import pytest
from pyspark.sql import functions as F

from bazaarlens.functions import band, haversine_km, mean, pct, quotient
from bazaarlens.plans.delivery import delivery_outcome, distance_band


def value(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_rounding_is_half_away_from_zero(spark):
    assert value(spark, quotient(F.lit("83393303.55").cast("decimal(20,2)"), F.lit(6), 2)) == 13898883.93
    assert value(spark, quotient(F.lit(-5), F.lit(1000), 2)) == -0.01
    assert value(spark, pct(F.lit(1), F.lit(3), 1)) == 33.3


def test_zero_denominator_is_null(spark):
    assert value(spark, pct(F.lit(1), F.lit(0))) is None
    assert value(spark, quotient(F.lit(None), F.lit(2), 1)) is None


def test_mean_of_nothing_is_null(spark):
    rows = spark.createDataFrame([(1, True), (2, True), (30, False)], "v int, k boolean")
    got = rows.agg(mean("v", 2).alias("a"), mean("v", 2, where=F.col("k")).alias("b"), mean("v", 2, where=F.col("v") > 99).alias("c")).first()
    assert (got["a"], got["b"], got["c"]) == (11.0, 1.5, None)


def test_haversine(spark):
    quarter = haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))
    assert value(spark, quarter) == pytest.approx(6371 * 3.141592653589793 / 2)
    unknown = haversine_km(F.lit(0.0), F.lit(0.0), F.lit(None).cast("double"), F.lit(1.0))
    assert value(spark, unknown) is None


def test_distance_bands_and_their_bounds(spark):
    kms = [(None,), (0.0,), (49.9,), (50.0,), (199.9,), (200.0,), (500.0,), (999.9,), (1000.0,)]
    rows = spark.createDataFrame(kms, "km double").select(distance_band(F.col("km")).alias("b")).collect()
    assert [r["b"][0] for r in rows] == list("zaabbcdde")


def test_outcome_bounds(spark):
    days = [(-11,), (-10,), (-9,), (-1,), (0,), (1,), (3,), (4,), (10,), (11,)]
    rows = spark.createDataFrame(days, "d int").select(delivery_outcome(F.col("d")).alias("b")).collect()
    assert [r["b"][0] for r in rows] == list("aabbcddeef")


def test_band_without_else_is_null(spark):
    assert value(spark, band([(F.lit(False), "x")])) is None
