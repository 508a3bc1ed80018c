"""Daily and monthly series: gap filling, running totals, comparisons, rolling windows.

Windows here run over series already reduced to one row per entity and day or month, so their
partitions are bounded by the calendar.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from salesloom.functions.numbers import RATIO, ratio


def calendar(spark: SparkSession, start: date, end: date, name: str = "date") -> DataFrame:
    """One row per day from start to end."""
    days = spark.range((end - start).days + 1, numPartitions=1)
    return days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def months(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per month that [start, end] touches, as its first day."""
    count = (end.year - start.year) * 12 + end.month - start.month + 1
    first = F.trunc(F.lit(start), "month")
    rows = spark.range(count, numPartitions=1)
    return rows.select(F.add_months(first, F.col("id").cast("int")).alias("month"))


def fill_calendar(
    series: DataFrame, entity: list[str], day: str, value: str, start: date, end: date
) -> DataFrame:
    """Every day of [start, end] for every entity: last known value, before it the first known one.

    `series` has at most one row per entity and day, all within the range. Every known value is
    stretched to the day before the next known one, the first one also back to the start, so the
    series is read once and joined to nothing. An entity without any known value stays NULL.
    """
    all_days = Window.partitionBy(*entity)
    in_order = all_days.orderBy(day)
    known = (
        series.select(*entity, day, value)
        .withColumns({"_known": F.count(value).over(all_days), "_first": F.row_number().over(in_order)})
        .where(F.col(value).isNotNull() | ((F.col("_known") == 0) & (F.col("_first") == 1)))
    )
    since = F.when(F.lag(day).over(in_order).isNull(), F.lit(start)).otherwise(F.col(day))
    until = F.coalesce(F.date_sub(F.lead(day).over(in_order), 1), F.lit(end))
    stretched = known.withColumns({"_since": since, "_until": until})
    return stretched.select(
        *entity, value, F.explode(F.sequence("_since", "_until")).alias(day)
    )


def calendar_per_group(
    spark: SparkSession, start: date, end: date, step: str, rows: DataFrame, by: list[str]
) -> DataFrame:
    """Every `date` (step day) or `month` (step month) of [start, end], for every group of `rows`."""
    if not by:
        return calendar(spark, start, end) if step == "day" else months(spark, start, end)
    name, first = ("date", F.lit(start)) if step == "day" else ("month", F.trunc(F.lit(start), "month"))
    steps = F.sequence(first.cast("date"), F.lit(end), F.expr(f"interval 1 {step}"))
    return rows.select(*by).distinct().select(*by, F.explode(steps).alias(name))


def daily_totals(
    rows: DataFrame, spark: SparkSession, day: str, totals: dict[str, Column], start: date, end: date,
    by: list[str] | None = None,
) -> DataFrame:
    """One row per day of [start, end] and group with the totals of that day, NULL on days without rows."""
    by = by or []
    per_day = rows.groupBy(*by, F.col(day).alias("date")).agg(*[c.alias(n) for n, c in totals.items()])
    spine = calendar_per_group(spark, start, end, "day", per_day, by)
    return spine.join(per_day, [*by, "date"], "left")


def to_date_totals(daily: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Year-, quarter- and month-to-date totals of a daily series, per group."""
    by = by or []
    year, quarter, month = F.year("date"), F.quarter("date"), F.month("date")

    def running(*parts: Column) -> Column:
        return F.sum(value).over(Window.partitionBy(*by, *parts).orderBy("date"))

    return daily.select(
        *by,
        "date",
        F.col(value),
        running(year).cast("decimal(28,2)").alias(f"{value}_ytd"),
        running(year, quarter).cast("decimal(28,2)").alias(f"{value}_qtd"),
        running(year, month).cast("decimal(28,2)").alias(f"{value}_mtd"),
    )


def monthly_change(
    monthly: DataFrame, value: str, months_back: int, prior: str, change: str, by: list[str] | None = None
) -> DataFrame:
    """Value `months_back` months earlier and the relative change; NULL without an earlier value.

    Months are compared by their number, so one that is missing cannot shift the comparison.
    """
    number = F.year("month") * 12 + F.month("month")
    same_distance = Window.partitionBy(*(by or [])).orderBy(number).rangeBetween(-months_back, -months_back)
    earlier = F.max(value).over(same_distance)
    return monthly.withColumn(prior, earlier).withColumn(
        change, ratio(F.col(value) - F.col(prior), F.col(prior))
    )


def rolling_sum(daily: DataFrame, value: str, days: int, name: str, by: list[str] | None = None) -> DataFrame:
    """Sum of the last `days` calendar days, shorter at the start."""
    return daily.withColumn(name, F.sum(value).over(_last_days(days, by)).cast("decimal(28,2)"))


def rolling_mean(daily: DataFrame, value: str, days: int, name: str, by: list[str] | None = None) -> DataFrame:
    """Average of the last `days` calendar days, shorter at the start."""
    window = _last_days(days, by)
    return daily.withColumn(name, ratio(F.sum(value).over(window), F.count(value).over(window)))


def _last_days(days: int, by: list[str] | None = None):
    day = F.datediff("date", F.lit("1970-01-01").cast("date"))
    return Window.partitionBy(*(by or [])).orderBy(day).rangeBetween(-(days - 1), 0)


def compare_prior_months(
    monthly: DataFrame, value: str, months_before: int, by: list[str] | None = None
) -> DataFrame:
    """Average of the preceding months on a complete month series, and the change against it."""
    window = Window.partitionBy(*(by or [])).orderBy("month").rowsBetween(-months_before, -1)
    average = ratio(F.sum(value).over(window), F.count(value).over(window))
    return monthly.withColumn("prior_average", average).withColumn(
        "change_pct", ratio(F.col(value).cast("double") - F.col("prior_average"), F.col("prior_average"))
    )


def latest_rate(fx: DataFrame) -> DataFrame:
    """Latest rate of each currency pair."""
    return fx.groupBy("base_currency", "quote_currency").agg(
        F.max("date_key").alias("date_key"), F.max_by("rate", "date_key").alias("rate")
    )


def rate_range(fx: DataFrame) -> DataFrame:
    """Per pair: (max - min) / min over the selection, and first to last change."""
    low, high = F.min("rate"), F.max("rate")
    first, last = F.min_by("rate", "date_key"), F.max_by("rate", "date_key")
    return fx.groupBy("base_currency", "quote_currency").agg(
        ratio(high - low, low, 0).alias("fx_range_pct"),
        ratio(last - first, first, 0).alias("fx_change_pct"),
    )


def weekly_moves(fx: DataFrame, threshold: float) -> DataFrame:
    """Last rate of each ISO week per pair, its change on the week before, and a flag beyond the threshold."""
    week = F.trunc("date", "week").alias("week_start")
    weekly = fx.groupBy("base_currency", "quote_currency", week).agg(
        F.max_by("rate", "date").alias("rate")
    )
    in_order = Window.partitionBy("base_currency", "quote_currency").orderBy("week_start")
    previous = F.lag("rate").over(in_order)
    return weekly.withColumn(
        "change_pct", ratio(F.col("rate") - previous, previous)
    ).withColumn("is_large_move", F.abs("change_pct") > F.lit(threshold).cast(RATIO))

