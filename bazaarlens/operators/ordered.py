"""Ordered computations over groups of any size.

A plain window sorts each group in one task, and an unpartitioned window sorts
everything in one task. Here the rows are range-partitioned by group and order,
so that a hot group spreads over many partitions; every partition is scanned on
its own and then shifted by what came before it. The shifts number at most one
per partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import pct
from ..sources.durable import cut_lineage
from .skew import join_per_key


def _order_column(spec) -> Column:
    return F.col(spec) if isinstance(spec, str) else spec


def ordered_scan(
    df: DataFrame,
    order: Sequence,
    by: Sequence[str] = (),
    number: str | None = "row_number",
    sums: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Row number, running sums and previous-row values within each group.

    ``order`` must be unique within a group. ``sums`` maps a new column to the
    column it accumulates (ROWS UNBOUNDED PRECEDING), ``previous`` a new column
    to the column it takes from the preceding row (LAG). ``totals`` maps a new
    column to the column it sums over all groups, ``*`` for the number of rows.
    """
    sums, previous, totals, by = dict(sums or {}), dict(previous or {}), dict(totals or {}), list(by)
    spark = df.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*(F.col(c) for c in by), *(_order_column(o) for o in order)]

    # _pos carries the partition in its upper bits and the row in its lower 33.
    # Both are fixed by the write: a recomputed partition cannot renumber them.
    placed = cut_lineage(
        df.repartitionByRange(count, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_pos", 33))

    # Per group and partition: rows, sums and last values. Only a group that
    # continues from an earlier partition needs a shift, which is at most one
    # group per partition.
    pieces = placed.groupBy(*by, "_part").agg(
        F.count("*").alias("_rows"),
        *[F.sum(src).alias(f"_sum_{dst}") for dst, src in sums.items()],
        *[F.max_by(src, "_pos").alias(f"_last_{dst}") for dst, src in previous.items()],
        *[F.sum(src).alias(f"_total_{dst}") for dst, src in totals.items() if src != "*"],
    )
    # At most one row per partition and group, so these windows stay small.
    earlier = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy(*by).orderBy("_part")
    shifts = (
        pieces
        .select(
            *[F.col(c).alias(f"_by_{c}") for c in by],
            F.col("_part").alias("_shift_part"),
            F.sum("_rows").over(earlier).alias("_rows_before"),
            *[F.sum(f"_sum_{dst}").over(earlier).alias(f"_before_{dst}") for dst in sums],
            *[F.lag(f"_last_{dst}").over(before).alias(f"_carry_{dst}") for dst in previous],
        )
        .filter(F.col("_rows_before") > 0)
    )

    inside = W.partitionBy(*by, "_part").orderBy("_pos")
    running = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = placed.select(
        *placed.columns,
        F.row_number().over(inside).alias("_local"),
        *[F.sum(src).over(running).alias(f"_run_{dst}") for dst, src in sums.items()],
        *[F.lag(src).over(inside).alias(f"_prev_{dst}") for dst, src in previous.items()],
    )
    same = F.col("_part") == F.col("_shift_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    joined = local.join(F.broadcast(shifts), same, "left")

    out = [F.col(c) for c in df.columns]
    if number:
        out.append((F.col("_local") + F.coalesce("_rows_before", F.lit(0))).cast("long").alias(number))
    for dst in sums:
        # A sum over nothing but NULLs stays NULL, as in a window.
        run, shift = F.col(f"_run_{dst}"), F.col(f"_before_{dst}")
        out.append(F.when(run.isNull(), shift).when(shift.isNull(), run).otherwise(run + shift).alias(dst))
    for dst in previous:
        first = (F.col("_local") == 1) & F.col("_rows_before").isNotNull()
        out.append(F.when(first, F.col(f"_carry_{dst}")).otherwise(F.col(f"_prev_{dst}")).alias(dst))
    for dst, src in totals.items():
        total = pieces.agg(F.sum("_rows" if src == "*" else f"_total_{dst}"))
        out.append(total.scalar().alias(dst))
    return joined.select(*out)


def running_with_peers(
    df: DataFrame, order: str, value: str, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Running sum under the default frame: rows with equal ``order`` share a total.

    The total belongs to the distinct order value, so the values are summed
    before they are scanned. Pass a frame that is cheap to read twice.
    """
    by = list(by)
    steps = df.groupBy(*by, order).agg(F.sum(value).alias("_step"), F.count("*").alias("_rows_here"))
    scanned = ordered_scan(steps, [order], by, number=None, sums={name: "_step"})
    return join_per_key(df, scanned.drop("_step"), [*by, order], "_rows_here")


def value_ranks(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    descending: bool = True,
    rank: str | None = "rank",
    dense_rank: str | None = None,
    cume_dist: str | None = None,
) -> DataFrame:
    """RANK, DENSE_RANK and CUME_DIST of every row, with ties of any number.

    Tied rows share their ranks, so ranks belong to distinct values: the values
    are counted, scanned in order, and joined back. Pass a frame that is cheap
    to read twice.
    """
    by = list(by)
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_ties"))
    order = [F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)]
    scanned = ordered_scan(
        counts, order, by, number="_dense", sums={"_upto": "_ties"},
        totals={"_all": "_ties"} if cume_dist and not by else None,
    )
    ranks = [*[F.col(c) for c in by], F.col(value), F.col("_ties")]
    if rank:
        ranks.append((F.col("_upto") - F.col("_ties") + 1).cast("long").alias(rank))
    if dense_rank:
        ranks.append(F.col("_dense").alias(dense_rank))
    if cume_dist:
        if by:
            members = counts.groupBy(*by).agg(F.sum("_ties").alias("_all"), F.count("*").alias("_values"))
            scanned = join_per_key(cut_lineage(scanned), members, by, "_values")
        ranks.append((F.col("_upto").cast("double") / F.col("_all")).alias(cume_dist))
    return join_per_key(df, scanned.select(*ranks), [*by, value], "_ties")


def ntile(df: DataFrame, order: Sequence, buckets: int, name: str = "ntile") -> DataFrame:
    """NTILE over all rows: buckets differ by at most one row, larger ones first."""
    numbered = ordered_scan(df, order, number="_n", totals={"_total": "*"})
    base = F.floor(F.col("_total") / F.lit(buckets)).cast("long")
    extra = (F.col("_total") % F.lit(buckets)).cast("long")
    ahead = F.col("_n") - 1
    wide = extra * (base + 1)
    # Rows beyond the wide buckets exist only when base >= 1.
    bucket = F.when(ahead < wide, F.floor(ahead / (base + 1))).otherwise(
        extra + F.floor((ahead - wide) / F.greatest(base, F.lit(1)))
    ) + 1
    return numbered.withColumn(name, bucket.cast("long")).drop("_n", "_total")


def pareto(
    df: DataFrame,
    value: str,
    tiebreak: str,
    thresholds: Sequence[float],
    digits: int = 3,
) -> DataFrame:
    """Rows at which the cumulative share, largest first, crosses a threshold.

    The share is rounded before it is tested. The share of the row before equals
    the running sum without the row's own value, so no LAG is needed and the
    first row compares against zero.
    """
    scanned = ordered_scan(
        df, [F.desc(value), F.col(tiebreak)], number="position", sums={"_running": value},
        totals={"_total": value, "members": "*"},
    )
    curve = scanned.withColumn("cumulative_pct", pct("_running", "_total", digits)).withColumn(
        "_prev_pct", pct(F.col("_running") - F.col(value), "_total", digits)
    )
    crossing = F.lit(False)
    for t in thresholds:
        crossing = crossing | ((F.col("cumulative_pct") >= t) & (F.col("_prev_pct") < t))
    return curve.filter(crossing).drop("_running", "_total", "_prev_pct")
