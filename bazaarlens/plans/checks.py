"""Data checks. Each returns a report; :func:`require` turns a failure into an error.

Reports share the columns ``check_name, subject, expected, actual, ok``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import orphans
from ..sources.schemas import RELATIONS, SCORE_RANGE, TABLES, Relation


class CheckFailed(ValueError):
    """At least one row of a check report is not ok."""


def _report(actual: DataFrame, check: str, subject: str, expected: Column, ok: Column) -> DataFrame:
    """``actual`` is a one-row frame with the column ``actual``."""
    return actual.select(
        F.lit(check).alias("check_name"),
        F.lit(subject).alias("subject"),
        expected.cast("string").alias("expected"),
        F.col("actual").cast("long").alias("actual"),
        ok.alias("ok"),
    )


def _all(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def _equals(actual: DataFrame, check: str, subject: str, expected: int) -> DataFrame:
    return _report(actual, check, subject, F.lit(expected), F.col("actual") == expected)


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("actual"))


def row_counts(frames: Mapping[str, DataFrame], expected: Mapping[str, int | Column]) -> DataFrame:
    """Rows of every table against the expected number (or scalar subquery)."""
    reports = []
    for name, frame in frames.items():
        want = expected[name] if isinstance(expected[name], Column) else F.lit(expected[name])
        reports.append(_report(_count(frame), "row count", name, want, F.col("actual") == want))
    return _all(reports)


def spot_checks(
    t,
    null_categories: int | None = None,
    undelivered: int | None = None,
    people: int | None = None,
    untranslated: int | None = None,
) -> DataFrame:
    """Traps a row count cannot catch. Expectations left out must only hold a positive number."""

    def judged(actual: DataFrame, subject: str, expected: int | None) -> DataFrame:
        if expected is None:
            return _report(actual, "spot check", subject, F.lit("> 0"), F.col("actual") > 0)
        return _equals(actual, "spot check", subject, expected)

    # Both questions about customers are answered by one pass.
    buyers = t.customers.agg(
        F.count_if(F.col("customer_zip_code_prefix").startswith("0")).alias("zeros"),
        F.count_distinct("customer_unique_id").alias("people"),
    )
    wanted_people = F.lit("> 0" if people is None else str(people))
    people_ok = F.col("people") > 0 if people is None else F.col("people") == people

    def line(subject: str, expected: Column, actual: str, ok: Column) -> Column:
        return F.struct(
            F.lit("spot check").alias("check_name"), F.lit(subject).alias("subject"), expected.alias("expected"),
            F.col(actual).alias("actual"), ok.alias("ok"),
        )

    about_customers = buyers.select(F.inline(F.array(
        line("zips with a leading zero", F.lit("> 0"), "zeros", F.col("zeros") > 0),
        line("distinct people", wanted_people, "people", people_ok),
    )))
    uncategorised = t.products.agg(F.count_if(F.col("product_category_name").isNull()).alias("actual"))
    never = t.orders.agg(F.count_if(F.col("order_delivered_customer_date").isNull()).alias("actual"))
    unknown = _count(
        orphans(t.products.select("product_category_name").distinct(), "product_category_name",
                t.translation, "product_category_name")
    )
    return _all([
        about_customers,
        judged(uncategorised, "products without category", null_categories),
        judged(never, "orders without delivery date", undelivered),
        judged(unknown, "categories without translation", untranslated),
    ])


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def uniqueness(frames: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    return _all([
        _equals(_count(duplicate_keys(frames[name], key)), "unique key", f"{name}({', '.join(key)})", 0)
        for name, key in keys.items()
    ])


def references(frames: Mapping[str, DataFrame], relations: Sequence[Relation] = RELATIONS) -> DataFrame:
    return _all([
        _equals(
            _count(orphans(frames[r.child], r.column, frames[r.parent], r.parent_column)),
            "reference", f"{r.child}.{r.column} -> {r.parent}.{r.parent_column}", 0,
        )
        for r in relations
    ])


def null_counts(name: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs in columns that may not hold any, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = counted.unpivot([], list(columns), "subject", "actual")
    return rows.select(
        F.lit("not null").alias("check_name"),
        F.concat(F.lit(f"{name}."), F.col("subject")).alias("subject"),
        F.lit("0").alias("expected"),
        "actual",
        (F.col("actual") == 0).alias("ok"),
    )


def score_range(reviews: DataFrame) -> DataFrame:
    low, high = SCORE_RANGE
    outside = reviews.agg(F.count_if(~F.col("review_score").between(low, high)).alias("actual"))
    return _equals(outside, "check", f"review_score between {low} and {high}", 0)


def required_columns(name: str) -> tuple[str, ...]:
    return TABLES[name].required


def require(report: DataFrame, shown: int = 100) -> None:
    """Raise with the failed rows of a report; beyond ``shown`` of them it says how many there are."""
    failed = report.filter(~F.coalesce("ok", F.lit(False))).limit(shown + 1).collect()
    if failed:
        told = "; ".join(f"{r['subject']}: {r['actual']} (expected {r['expected']})" for r in failed[:shown])
        if len(failed) > shown:
            told += f"; {shown} of {report.filter(~F.coalesce('ok', F.lit(False))).count()} failures shown"
        raise CheckFailed(told)


def profile(name: str, df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus exact copies of a table."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return groups.agg(
        F.sum("_copies").cast("long").alias("row_count"), F.count("*").alias("distinct_rows")
    ).select(
        F.lit(name).alias("table_name"), "row_count", "distinct_rows",
        (F.col("row_count") - F.col("distinct_rows")).alias("surplus_copies"),
    )


def time_of_day(df: DataFrame, timestamp: str) -> DataFrame:
    """How many timestamps carry a time, and how many are plain days."""
    midnight = (F.hour(timestamp) == 0) & (F.minute(timestamp) == 0) & (F.second(timestamp) == 0)
    return df.agg(F.count_if(midnight).alias("midnight"), F.count_if(~midnight).alias("with_time"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive hash of a result: equal results give equal rows."""
    columns = sorted(df.columns)
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("hash_sum"),
    )


def same_result(first: DataFrame, second: DataFrame) -> DataFrame:
    """Compare the fingerprints of two runs."""
    a = fingerprint(first).withColumnRenamed("row_count", "first_rows").withColumnRenamed("hash_sum", "first_hash")
    b = fingerprint(second)
    return a.select(
        "first_rows",
        b.select("row_count").scalar().alias("second_rows"),
        (F.col("first_hash") == b.select("hash_sum").scalar()).alias("equal"),
    )
