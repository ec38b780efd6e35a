"""Exact money, ratios that round once, guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value) -> Column:
    """Amounts are summed as exact decimals, never as floating point."""
    return col(value).cast("decimal(15,2)")


def rounded(value, digits: int = 2) -> Column:
    """Round half away from zero, as a double."""
    return F.round(col(value).cast("double"), digits)


def money_out(value) -> Column:
    """An exact amount as it appears in a report."""
    return rounded(value, 2)


def exact(value, scale: int = 2) -> Column:
    """Operand of a quotient: an exact decimal of up to 18 integer digits.

    Amounts have two decimals; ``scale`` must be given for a value with more.
    """
    return col(value).cast(f"decimal({18 + scale},{scale})")


def quotient(part, whole, digits: int, scale: int = 2) -> Column:
    """``part / whole`` rounded once, NULL for a zero denominator.

    The division is decimal: as a double, a value half way between two results
    can fall on either side of the tie. ``scale`` are the decimals of ``part``.
    """
    divisor = exact(whole)
    return F.round(exact(part, scale) / F.when(divisor != 0, divisor), digits).cast("double")


def pct(part, whole, digits: int = 1) -> Column:
    """``part`` in percent of ``whole``."""
    return quotient(F.lit(100) * exact(part), whole, digits)


def mean(value, digits: int, where: Column | None = None, scale: int = 2) -> Column:
    """Average of an exact number of up to ``scale`` decimals, from its exact sum and its count.

    Summing doubles would make the last digits depend on the task order.
    """
    kept = col(value) if where is None else F.when(where, col(value))
    return quotient(F.sum(kept), F.count(kept), digits, scale)
