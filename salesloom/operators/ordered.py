"""Places of values within their group, counted over ranges so that no task holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesloom.session import shared_folder


def running_counts(counted: DataFrame, group: str, order: Column, count: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """Every row with `_before`, the sum of `count` over the rows of its group that come before it.

    `order` must leave no ties in a group. Also `_total`, the sum of `count` over the group, and what
    `sums` asks for, summed over the group.

    Rows are range-partitioned by group and order, so that a group of any size is dealt to as many tasks
    as it needs. Each range sums its own rows, a group has at most one sum for each range, and the sums
    of the ranges before it are added. The ranges are checkpointed: all reads see the same ones, even
    after an executor is lost.
    """
    shared_folder(counted.sparkSession)
    placed = counted.repartitionByRange(F.col(group), order).withColumn(
        "_range", F.spark_partition_id()).checkpoint()
    sums = {"_total": F.col(count), **(sums or {})}
    parts = placed.groupBy(group, "_range").agg(*[F.sum(value).alias(name) for name, value in sums.items()])
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col(group).alias("_group"), F.col("_range").alias("_at"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"),
        *[F.sum(name).over(Window.partitionBy(group)).alias(name) for name in sums])
    own = Window.partitionBy("_range", group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("_within", F.coalesce(F.sum(count).over(own), F.lit(0)))
    # A range of a group is what one task sorted already, so this join gathers no more than that.
    joined = within.join(offsets, (F.col("_range") == F.col("_at")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.select(
        *counted.columns, (F.col("_offset") + F.col("_within")).alias("_before"), *sums)
