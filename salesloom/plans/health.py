"""Pipeline health: coverage, status, pass rate, rows over time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from salesloom.functions.fixed import PASS_RATE_AMBER_PCT, PASS_RATE_GREEN_PCT
from salesloom.functions.numbers import ratio, share
from salesloom.operators.single_rows import side_by_side
from salesloom.sources.versions import Snapshot


def join_coverage(sales_weather: DataFrame, sales_usd: DataFrame) -> DataFrame:
    """Share of sales with weather and with a rate, and null rates of the join keys."""
    weather = sales_weather.agg(
        share(F.col("temp_max").isNotNull()).alias("weather_coverage"),
        share(F.col("order_code").isNull()).alias("order_code_null_rate"),
        share(F.col("customer_key").isNull()).alias("customer_key_null_rate"),
    )
    fx = sales_usd.agg(share(F.col("usd_to_brl_rate").isNotNull()).alias("fx_coverage"))
    return side_by_side(weather, fx)


def pipeline_status(counts: DataFrame, baselines: dict[str, int], rates: DataFrame) -> DataFrame:
    """NOMINAL, REVIEW NEEDED or PIPELINE FAULT.

    `counts` has one row per table (table_name, row_count). `rates` is one row: `order_id_null_rate`,
    `join_key_null_rate`, `undocumented_drop` (share of rows that left Bronze without reaching Silver
    or the quarantine) and `missing_days` (days of the expected range that a feed did not deliver).

    Fault: a table is empty, over 5 % of order ids are NULL, or over 10 % of rows went without a
    reason. Review: a count is off its baseline by more than 0.5 %, over 2 % of join keys are NULL, or
    more than 3 days are missing.
    """
    baseline = F.create_map(*[F.lit(x) for kv in baselines.items() for x in kv])[F.col("table_name")]
    deviation = ratio(F.abs(F.col("row_count") - baseline), baseline)
    checked = counts.agg(
        F.max(deviation).alias("max_deviation"), F.min("row_count").alias("min_rows")
    )
    c = F.col
    status = (
        F.when(
            (c("min_rows") == 0) | (c("order_id_null_rate") > 0.05) | (c("undocumented_drop") > 0.1),
            "PIPELINE FAULT",
        )
        .when(
            (c("max_deviation") > 0.005) | (c("join_key_null_rate") > 0.02) | (c("missing_days") > 3),
            "REVIEW NEEDED",
        )
        .otherwise("NOMINAL")
    )
    return side_by_side(checked, rates).select(
        "max_deviation", "min_rows", "order_id_null_rate", "join_key_null_rate", "undocumented_drop",
        "missing_days", status.alias("pipeline_status"),
    )


def pass_rate(results: DataFrame) -> DataFrame:
    """Percentage of passed checks and its band."""
    rate = results.agg(
        F.count(F.lit(1)).alias("checks"),
        ratio(F.count_if(F.col("status") == "PASS") * 100, F.count(F.lit(1))).alias("pass_rate_pct"),
    )
    return rate.withColumn(
        "band",
        F.when(F.col("pass_rate_pct") >= PASS_RATE_GREEN_PCT, "green")
        .when(F.col("pass_rate_pct") >= PASS_RATE_AMBER_PCT, "amber")
        .otherwise("red"),
    )


def rows_over_time(tables: Snapshot, facts: list[str]) -> DataFrame:
    """Rows per fact and month of loading, from the lists of files; no fact is read."""
    parts = [
        tables.files(name).groupBy(F.trunc("load_day", "month").alias("load_month")).agg(
            F.lit(name).alias("table_name"), F.sum("rows").alias("row_count"))
        for name in facts
    ]
    return reduce(DataFrame.unionByName, parts)
