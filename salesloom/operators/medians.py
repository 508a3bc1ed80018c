"""Exact medians per group that do not gather a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.operators.ordered import running_counts


def grouped_median(df: DataFrame, group: str, value: Column, name: str) -> DataFrame:
    """Exact median of `value` per group; the mean of the two middle values for an even count.

    Equal values are counted before any shuffle. Distinct values are placed by running counts over
    ranges of values, whatever their distribution, and only the one or two in the middle of a group go on.
    NULL values count nowhere; a group of NULL values has no median and no row.
    """
    counted = (
        df.select(F.col(group), value.cast("double").alias("_value"))
        .where("_value is not null")
        .groupBy(group, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = running_counts(counted, group, F.col("_value").asc(), "_n")
    # Places count from 0; an odd total has one middle place, which is both.
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)

    def holds(place: Column) -> Column:
        return (F.col("_before") <= place) & (place < F.col("_before") + F.col("_n"))

    middle = placed.withColumns({"_low": holds(low), "_high": holds(high)}).where("_low or _high")
    return middle.groupBy(group).agg(
        ((F.max(F.when(F.col("_low"), F.col("_value"))) + F.max(F.when(F.col("_high"), F.col("_value")))) / 2
         ).alias(name))
