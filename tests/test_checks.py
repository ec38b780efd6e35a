import pytest
from pyspark.sql import functions as F

from bazaarlens.plans import checks
from bazaarlens.sources.schemas import Relation


def test_counts_duplicates_orphans_and_ranges_fail(spark):
    parents = spark.createDataFrame([(1,), (1,)], "id int")
    children = spark.createDataFrame([(1,), (2,), (None,)], "pid int")
    reviews = spark.createDataFrame([(5,), (6,)], "review_score int")
    reports = [
        checks.row_counts({"p": parents}, {"p": 3}),
        checks.uniqueness({"p": parents}, {"p": ["id"]}),
        checks.references({"c": children, "p": parents}, [Relation("c", "pid", "p", "id")]),
        checks.null_counts("c", children, ["pid"]),
        checks.score_range(reviews),
    ]
    for report in reports:
        row = report.first()
        assert row["ok"] is False
        with pytest.raises(checks.CheckFailed):
            checks.require(report)
    # A NULL reference is not an orphan.
    assert reports[2].first()["actual"] == 1


def test_passing_reports(spark, tables):
    checks.require(checks.spot_checks(tables, untranslated=2))
    checks.require(checks.references({n: tables.by_name(n) for n in (
        "customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews")}))


def test_profile_counts_copies(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    assert tuple(checks.profile("t", rows).first()) == ("t", 3, 2, 1)


def test_fingerprint_ignores_row_order_and_sees_changes(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    a = checks.fingerprint(df).first()
    assert a == checks.fingerprint(df.orderBy(F.desc("id")).repartition(5)).first()
    assert a != checks.fingerprint(df.filter("id < 999")).first()
