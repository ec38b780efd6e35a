"""Calendar expressions on timestamps without time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col


def day(ts) -> Column:
    return col(ts).cast("date")


def days_between(end, start) -> Column:
    """Whole days from ``start`` to ``end``, by calendar day."""
    return F.datediff(day(end), day(start)).cast("long")


def month_of(ts) -> Column:
    return F.trunc(col(ts), "MM")


def quarter_of(ts) -> Column:
    return F.trunc(col(ts), "QUARTER")


def year_month(date) -> Column:
    return F.date_format(col(date), "yyyy-MM")


def months_index(date) -> Column:
    """Months since year 0: turns an interval frame into an integer range frame."""
    return F.year(col(date)) * 12 + F.month(col(date))
