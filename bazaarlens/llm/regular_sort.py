"""Parallel sorting by regular sampling, with exact ranks.

1. The rows are cut into as many runs as there will be parts; each run is sorted
   on its own and written with the places of its rows.
2. Every run gives keys at regular distances. The sorted samples, again at regular
   distances, are the splitters: no part gets more than about twice its share,
   whatever the values, because the place of a row is the last part of its key.
3. Rows are dealt out by the splitters; the sorted segments that meet in a part
   are merged there.
4. Counts of the parts, summed up, give the rank of each part's first row, so
   every row knows its rank. Parts that begin beyond the wanted ranks are counted
   but neither exchanged nor merged.

The driver holds at most MAX_PARTS ** 2 sampled keys.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

ROWS_A_PART = 50_000
MAX_PARTS = 512
_LOCAL = (1 << 33) - 1  # the row within its partition, of monotonically_increasing_id


def cut_runs(df: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """``df`` in ``parts`` sorted runs, with ``_place`` (run and row)."""
    return stored(
        df.coalesce(parts).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id()), "sorted-runs")


def splitters(runs: DataFrame, keys: list[str], parts: int) -> list[tuple]:
    """Regular samples of every run, and regular samples of those."""
    run = F.shiftright("_place", 33)
    sizes = {r["run"]: r["n"] for r in runs.groupBy(run.alias("run")).agg(F.count("*").alias("n")).collect()}
    if not sizes or parts < 2:
        return []
    step = F.create_map(*[F.lit(x) for r, n in sizes.items() for x in (r, max(1, -(-n // parts)))])
    local = F.col("_place").bitwiseAND(F.lit(_LOCAL))
    found = sorted(tuple(r) for r in runs.filter(local % F.element_at(step, run) == 0).select(*keys, "_place").collect())
    return [found[i * len(found) // parts] for i in range(1, parts)]


def deal(runs: DataFrame, keys: list[str], cuts: list[tuple]) -> DataFrame:
    """``runs`` with the part of each row."""

    def part_of(batches):
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in [*keys, "_place"]]
            parts = [bisect_right(cuts, key) for key in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(parts, pa.int32())], [*batch.schema.names, "_part"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema.fields)
    return runs.mapInArrow(part_of, f"{fields}, _part int")


def first_ranks(df: DataFrame, keys: list[str], wanted: int, rows: int) -> DataFrame:
    """``df`` with ``rank`` (long): 1 to ``wanted`` in ascending order of ``keys``, null beyond.

    ``keys`` are long columns without nulls; ``rows`` is the number of rows. Rows
    with equal keys are ranked in an order fixed by their place in the runs.
    """
    columns = df.columns
    if wanted < 1:
        return df.withColumn("rank", F.lit(None).cast("long"))
    parts = min(MAX_PARTS, max(1, -(-rows // ROWS_A_PART)))
    runs = cut_runs(df, keys, parts)
    dealt = stored(deal(runs, keys, splitters(runs, keys, parts)), "dealt-runs")
    counts = {r["_part"]: r["n"] for r in dealt.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    before = [0, *accumulate(counts.get(i, 0) for i in range(parts))]
    needed = sum(1 for x in before[:parts] if x < wanted)
    offsets = F.array(*[F.lit(x).cast("long") for x in before[:needed]])
    merged = (
        dealt.filter(F.col("_part") < needed)
        .repartitionById(needed, F.col("_part"))
        .sortWithinPartitions(*keys, "_place")
        .withColumn("rank", F.get(offsets, F.col("_part")) + F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL)) + 1))
    rank = F.when(F.col("rank") <= wanted, F.col("rank"))
    rest = dealt.filter(F.col("_part") >= needed)
    return merged.select(*columns, rank.alias("rank")).unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))
