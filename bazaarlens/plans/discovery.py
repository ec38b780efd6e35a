"""What a table looks like, and which columns identify its rows.

``column_profile`` reads the table once: one aggregate gives every column its NULLs,
extremes, a sketch of the distinct values, quantiles and heavy hitters.

``minimal_keys`` walks the lattice of column sets by size. One scan per size sketches
the distinct values of all sets that hold no key yet; only a set whose sketch comes
near the number of rows is grouped exactly. Sketches never make a key, and one with a
standard error of RSD falls below NEAR of a true key practically never.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

RSD = 0.02
NEAR = 0.8
QUANTILES = (0.25, 0.5, 0.75)
TRACKED = 1000  # values that the search for heavy hitters keeps count of


def column_profile(name: str, df: DataFrame, top: int = 3) -> DataFrame:
    """One row per column, in one scan.

    Quantiles are those of numbers, else NULL. Heavy hitters are the ``top`` most frequent
    values and their estimated counts; NULLs are not among them. Extremes of an empty
    column are NULL.
    """
    sketches, rows = [F.count("*").alias("rows")], []
    for i, field in enumerate(df.schema.fields):
        c = F.col(f"`{field.name}`")
        quantiles = F.percentile_approx(c.cast("double"), list(QUANTILES)) if isinstance(field.dataType, NumericType) else F.lit(None).cast("array<double>")
        sketches.append(F.struct(
            F.count(c).alias("filled"), F.approx_count_distinct(c, RSD).alias("distinct"),
            F.min(c).cast("string").alias("least"), F.max(c).cast("string").alias("most"), quantiles.alias("quantiles"),
            F.expr(f"approx_top_k(`{field.name}`, {top + 1}, {TRACKED})").alias("hitters")).alias(f"c{i}"))
        held = F.filter(F.col(f"c{i}.hitters"), lambda h: h["item"].isNotNull())
        rows.append(F.struct(
            F.lit(i).alias("position"), F.lit(field.name).alias("column_name"), F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"c{i}.filled")).alias("null_count"), F.col(f"c{i}.least").alias("min_value"),
            F.col(f"c{i}.most").alias("max_value"), F.col(f"c{i}.distinct").alias("distinct_estimate"),
            F.col(f"c{i}.quantiles").alias("quantiles"),
            F.transform(F.slice(held, 1, top), lambda h: F.struct(h["item"].cast("string").alias("value"), h["count"].alias("n"))).alias("heavy_hitters")))
    return df.agg(*sketches).select(F.explode(F.array(*rows)).alias("c")).select(F.lit(name).alias("table_name"), "c.*")


def is_key(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether no two rows agree in all of the columns; NULLs agree with each other."""
    return df.groupBy(*[F.col(f"`{c}`") for c in columns]).count().filter("count > 1").isEmpty()


def minimal_keys(df: DataFrame, widest: int | None = None) -> list[tuple[str, ...]]:
    """All column sets that identify the rows, and of which no part does.

    A column with a NULL is in no key. ``widest`` ends the walk at sets of that many
    columns; without it all sizes are searched. A table of up to one row has the empty key.
    """
    named = {c: F.col(f"`{c}`") for c in df.columns}
    first = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(named.values())]).first()
    rows = first["rows"]
    if rows <= 1:
        return [()]
    usable = [c for i, c in enumerate(named) if first[f"c{i}"] == rows]
    if not usable or not is_key(df, usable):
        return []
    found: list[tuple[str, ...]] = []
    for width in range(1, min(widest or len(usable), len(usable)) + 1):
        open_sets = [s for s in combinations(usable, width) if not any(set(k) <= set(s) for k in found)]
        if not open_sets:
            break
        estimates = df.agg(*[
            F.approx_count_distinct(F.xxhash64(*[named[c] for c in s]), RSD).alias(f"s{i}") for i, s in enumerate(open_sets)]).first()
        found += [s for i, s in enumerate(open_sets) if estimates[f"s{i}"] >= NEAR * rows and is_key(df, s)]
    return found
