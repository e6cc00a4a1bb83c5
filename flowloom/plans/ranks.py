"""Positions and running maxima within groups of any size.

A plain window sends one group to one task. Here a hot group is cut into ordered
slices first; slices are ranked on their own, and the few per-slice totals of a
group carry the offset, so it spreads over as many tasks as it has slices.
Results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.plans.staging import stage_table

# Default of spark.sql.optimizer.windowGroupLimitThreshold.
CUT_LIMIT = 1000


def slice_positions(
    df: DataFrame, group: list[str], order: list[str], pos: str = "pos", running: dict[str, Column] | None = None
) -> DataFrame:
    """1-based position within ``group`` ordered by ``order``.

    ``running`` adds columns: the sum of a value over the earlier rows of the group.

    Rows are dealt out by ranges of (group, order), whose bounds Spark samples, so a
    group spreads over as many tasks as its rows take, whatever their order values
    are. The written table fixes the ranges. A row's position is its rank in its range
    plus the number of rows of the group in earlier ranges.
    """
    ranges = df.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id())
    dealt = stage_table(ranges, "ranges")
    key = [*group, "_slice"]
    earlier = (
        Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = {"_rows": F.lit(1), **(running or {})}
    totals = dealt.groupBy(*key).agg(*[F.sum(value).alias(f"_all_{name}") for name, value in sums.items()])
    offsets = totals.select(
        *[F.col(c).alias(f"_of_{c}") for c in key], *[F.sum(f"_all_{name}").over(earlier).alias(f"_to_{name}") for name in sums]
    )
    # Only where a group goes on from an earlier range, which is one group a range at most.
    carry = stage_table(offsets.where(F.col("_to__rows").isNotNull()), "offsets")
    within = Window.partitionBy(*key).orderBy(*order)
    passed = within.rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("_in__rows", F.row_number().over(within)).withColumns(
        {f"_in_{name}": F.coalesce(F.sum(value).over(passed), F.lit(0)) for name, value in (running or {}).items()}
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in key]
    carried = lambda name: F.coalesce(f"_to_{name}", F.lit(0)) + F.col(f"_in_{name}")
    columns = {pos: carried("_rows"), **{name: carried(name) for name in running or {}}}
    return ranked.join(carry, same, "left").withColumns(columns).select(*df.columns, *columns)


def max_before_slice(
    df: DataFrame, group: list[str], slice_col: str, value: Column, name: str
) -> DataFrame:
    """Per (group, slice): the maximum of ``value`` over all earlier slices of the group."""
    earlier = (
        Window.partitionBy(*group).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.groupBy(*group, slice_col)
        .agg(F.max(value).alias("_max"))
        .select(*group, slice_col, F.max("_max").over(earlier).alias(name))
    )


def lowest_per_group(
    df: DataFrame, group: list[str], order: list[str], k: int, rank: str = "rank", fan: int | None = None
) -> DataFrame:
    """The ``k`` lowest rows of each group by ``order``, with their rank.

    Each input partition forwards at most ``k`` rows of a group; on many thousand
    partitions that is still too much for one task, so a first round keeps ``k``
    per group and ``fan``-th of the partitions and the last round sees at most
    ``fan * k`` rows of a group. Spark cuts ahead of the shuffle only up to
    ``CUT_LIMIT``; beyond it a group is dealt out to more tasks instead.
    """
    fan = fan or (64 if k <= CUT_LIMIT else 1024)
    first = Window.partitionBy(*group, "_fan").orderBy(*order)
    last = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_fan", F.spark_partition_id() % fan)
        .withColumn(rank, F.row_number().over(first))
        .where(F.col(rank) <= k)
        .drop("_fan", rank)
        .withColumn(rank, F.row_number().over(last))
        .where(F.col(rank) <= k)
    )
