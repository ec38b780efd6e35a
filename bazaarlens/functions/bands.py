"""Ordered bands as one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(steps: Iterable[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """Label of the first condition that holds."""
    expr = None
    for condition, label in steps:
        expr = F.when(condition, label) if expr is None else expr.when(condition, label)
    return expr if otherwise is None else expr.otherwise(otherwise)
