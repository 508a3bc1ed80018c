"""One-row summaries of what an extraction delivered."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F


def weather_manifest(weather: DataFrame, start: date, end: date, requested: int) -> DataFrame:
    """Requested and delivered cities, records, and success, partial or failed."""
    cities = F.countDistinct("city")
    return weather.agg(
        F.lit("weather").alias("source"),
        F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
        F.lit(requested).cast("long").alias("requested"),
        cities.alias("delivered"),
        F.count(F.lit(1)).alias("total_records"),
        F.when(cities == 0, "failed")
        .when(cities < requested, "partial")
        .otherwise("success")
        .alias("status"),
    )


def fx_manifest(
    daily_rates: DataFrame, start: date, end: date, requested: DataFrame | None = None
) -> DataFrame:
    """Per currency pair: calendar days of the range, and trading days as the number of rate changes.

    `requested` has the pairs that were asked for (base_currency, quote_currency); one without any
    rate failed. Without it the delivered pairs are taken.
    """
    pair = ["base_currency", "quote_currency"]
    in_order = Window.partitionBy(*pair).orderBy("date")
    changed = ~F.col("rate").eqNullSafe(F.col("_previous")) | F.col("_previous").isNull()
    delivered = daily_rates.withColumn("_previous", F.lag("rate").over(in_order)).groupBy(*pair).agg(
        F.count_if(changed).alias("delivered"), F.count(F.lit(1)).alias("total_records")
    )
    asked = delivered.select(*pair) if requested is None else requested.select(*pair).distinct()
    none = F.lit(0).cast("long")
    return asked.join(delivered, pair, "left").select(
        F.concat(F.lit("fx "), "base_currency", F.lit("/"), "quote_currency").alias("source"),
        F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
        F.lit((end - start).days + 1).cast("long").alias("requested"),
        F.coalesce("delivered", none).alias("delivered"),
        F.coalesce("total_records", none).alias("total_records"),
        F.when(F.col("total_records").isNull(), "failed").otherwise("success").alias("status"),
    )


def all_manifests(
    weather: DataFrame, daily_rates: DataFrame, start: date, end: date, requested_cities: int,
    requested_pairs: DataFrame | None = None,
) -> DataFrame:
    """Manifests of every source: for rates, requested is calendar and delivered trading days."""
    return weather_manifest(weather, start, end, requested_cities).unionByName(
        fx_manifest(daily_rates, start, end, requested_pairs)
    )
