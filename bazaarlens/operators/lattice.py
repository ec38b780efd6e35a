"""Grouping sets from each other instead of from the rows.

GROUPING SETS repeats every row once per set. Here the rows are aggregated once,
by all columns of the sets, and each coarser set is computed from the smallest
finer aggregate that is already there. Every aggregate is written, because its
own row, the sets below it and the count that chooses between them read it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.durable import cut_lineage

KINDS = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
MERGED = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum, "groups": F.sum}


def grouping_lattice(df: DataFrame, sets: Sequence[Sequence[str]], measures: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """The rows of all grouping sets: their columns (NULL outside the set), the measures, and ``set`` (its number, from 0).

    A measure is ("sum" | "min" | "max" | "count", column), or ("groups", None):
    the number of different combinations of all columns of the sets.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    first = [(F.lit(1).cast("long") if kind == "groups" else KINDS[kind](source)).alias(name) for name, (kind, source) in measures.items()]
    finest = cut_lineage(df.groupBy(*columns).agg(F.count("*").alias("_rows"), *first).drop("_rows"))
    found = {frozenset(columns): (finest.count(), finest)}
    # Larger sets first, so that a set finds its finer ones.
    for one in sorted({frozenset(s) for s in sets} - set(found), key=len, reverse=True):
        _, finer = min((found[s] for s in found if one < s), key=lambda x: x[0])
        again = [MERGED[kind](name).alias(name) for name, (kind, _) in measures.items()]
        coarse = cut_lineage(finer.groupBy(*[c for c in columns if c in one]).agg(*again))
        found[one] = (coarse.count(), coarse)
    out = None
    for i, one in enumerate(sets):
        frame = found[frozenset(one)][1]
        shown = [F.col(c) if c in one else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in columns]
        part = frame.select(F.lit(i).alias("set"), *shown, *measures)
        out = part if out is None else out.unionByName(part)
    return out
