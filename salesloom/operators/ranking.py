"""Top-k lists and ranks within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesloom.functions.numbers import ratio
from salesloom.operators.ordered import running_counts


def top(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The first k rows in a total order; each task keeps k rows."""
    return df.orderBy(*order).limit(k)


def top_with_others(df: DataFrame, label: str, value: str, k: int, others: str) -> DataFrame:
    """The k largest labels and one row with the total of all the others.

    `df` has one row per label. The k labels are found first and joined back, so no window has to
    order all labels in one task.
    """
    leaders = top(df.select(label, value), k, [F.desc(value), F.asc(label)]).select(
        F.col(label).alias("_leader")
    )
    # k rows at most.
    marked = df.join(F.broadcast(leaders), F.col(label) == F.col("_leader"), "left")
    name = F.coalesce("_leader", F.lit(others)).alias(label)
    return marked.groupBy(name).agg(F.sum(value).alias(value))


def first_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in a total order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def rank_within(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rank (largest first), percent rank, size and average of the group, of each row.

    Ranks are computed once per distinct value of a group and joined back. A value rounded to a few
    digits has few distinct values, so even a group that holds most rows is ordered cheaply.
    """
    per_value = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_equals"))
    largest_first = Window.partitionBy(group).orderBy(F.desc_nulls_last(value))
    above = F.coalesce(
        F.sum("_equals").over(largest_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    everyone = Window.partitionBy(group)
    size = F.sum("_equals").over(everyone)
    known = F.sum(F.when(F.col(value).isNotNull(), F.col("_equals"))).over(everyone)
    average = ratio(F.sum(F.col(value) * F.col("_equals")).over(everyone), known)
    ranks = per_value.select(
        F.col(group).alias("_group"),
        F.col(value).alias("_value"),
        (above + 1).alias("peer_rank"),
        size.alias("peer_count"),
        average.alias("peer_average"),
    )
    joined = df.join(
        ranks,
        F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value")),
    ).drop("_group", "_value")
    percent = F.when(F.col("peer_count") == 1, F.lit(0.0)).otherwise(
        (F.col("peer_rank") - 1) / (F.col("peer_count") - 1)
    )
    return joined.withColumn("peer_percent_rank", F.round(percent, 6).cast("decimal(18,6)"))


def rank_in_ranges(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rank (largest first, NULL last), percent rank, size and average of the group, of each row.

    For values of which a group may have very many distinct ones: they are ranked by running counts
    over ranges of values, so that a group of any size is ranked by many tasks.
    """
    per_value = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_equals"))
    placed = running_counts(per_value, group, F.desc_nulls_last(value), "_equals", {
        "_sum": F.col(value) * F.col("_equals"), "_known": F.when(F.col(value).isNotNull(), F.col("_equals"))})
    ranks = placed.select(
        F.col(group).alias("_group"), F.col(value).alias("_value"), (F.col("_before") + 1).alias("peer_rank"),
        F.col("_total").alias("peer_count"), ratio(F.col("_sum"), F.col("_known")).alias("peer_average"))
    joined = df.join(
        ranks, F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value")),
    ).drop("_group", "_value")
    percent = F.when(F.col("peer_count") == 1, F.lit(0.0)).otherwise(
        (F.col("peer_rank") - 1) / (F.col("peer_count") - 1))
    return joined.withColumn("peer_percent_rank", F.round(percent, 6).cast("decimal(18,6)"))
