"""Landed JSON responses of the weather and exchange rate services, one response per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom.functions.dates import parse_date
from salesloom.functions.fixed import WEATHER_CITIES
from salesloom.operators.contracts import REASON
from salesloom.sources.schemas import (
    FX_FLAT_PAYLOAD,
    FX_LIST_PAYLOAD,
    FX_NESTED_PAYLOAD,
    WEATHER_PAYLOAD,
)

RATE = "decimal(16,6)"


UNREADABLE = "unreadable JSON"


def land(responses: DataFrame, path: str) -> None:
    """Write responses (file_name, payload) as one file each, in a folder of its name."""
    responses.select("file_name", "payload").write.mode("append").partitionBy("file_name").text(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files with their name, without `.json`, and where they were read.

    The name is that of the file, or of its folder where `land` wrote it.
    """
    text = spark.read.text(path, wholetext=True)
    named = "file_name" in text.columns
    name = F.col("file_name").cast("string") if named else F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1)
    return text.select(
        name.alias("file_name"), F.col("value").alias("payload"), F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"), F.col("_metadata.file_block_length").alias("block_length"))


def split_corrupt(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responses that are JSON, and the others with a reason; an empty file has no row at all."""
    broken = F.try_parse_json("payload").isNull()
    return responses.where(~broken), responses.where(broken).withColumn(REASON, F.lit(UNREADABLE))


def city_list(spark: SparkSession) -> DataFrame:
    """The cities whose weather is landed."""
    return spark.createDataFrame(WEATHER_CITIES, "city string, state string, lat double, lng double")


def with_city(responses: DataFrame, cities: DataFrame) -> DataFrame:
    """City and state of a weather file named `<city_with_underscores>_<start date>.json`."""
    city = F.translate(F.regexp_replace("file_name", r"_\d{4}-\d{2}-\d{2}$", ""), "_", " ")
    return responses.withColumn("city", city).join(cities.select("city", "state"), "city")


def parse_weather(responses: DataFrame) -> DataFrame:
    """One row per city and day out of parallel daily arrays. Windspeed is the daily maximum."""
    daily = F.from_json("payload", WEATHER_PAYLOAD)["daily"]
    days = responses.select(
        "city",
        "state",
        F.inline(
            F.arrays_zip(
                daily["time"].alias("day"),
                daily["temperature_2m_max"].alias("temp_max"),
                daily["temperature_2m_min"].alias("temp_min"),
                daily["precipitation_sum"].alias("precipitation"),
                daily["windspeed_10m_max"].alias("windspeed"),
                daily["weather_code"].alias("weathercode"),
            )
        ),
    )
    return days.select(
        "city",
        "state",
        parse_date(F.col("day")).alias("date"),
        "temp_max",
        "temp_min",
        "precipitation",
        "windspeed",
        "weathercode",
    )


def _rates(day: Column, base: Column, quote: Column, rate: Column) -> list[Column]:
    return [
        parse_date(day).alias("date"),
        base.alias("base_currency"),
        quote.alias("quote_currency"),
        rate.cast(RATE).alias("rate"),
    ]


def parse_fx_nested(responses: DataFrame, base: Column, quote: Column) -> DataFrame:
    """Rates of `{"rates": {date: {currency: rate}}}` for one quote currency."""
    by_day = responses.withColumn("base", base).withColumn("quote", quote).select(
        "base",
        "quote",
        F.explode(F.from_json("payload", FX_NESTED_PAYLOAD)["rates"]).alias("day", "by_currency"),
    )
    rate = F.try_element_at("by_currency", F.col("quote"))
    return by_day.where(rate.isNotNull()).select(
        *_rates(F.col("day"), F.col("base"), F.col("quote"), rate)
    )


def parse_fx_list(responses: DataFrame) -> DataFrame:
    """Rates of `[{"date", "base", "quote", "rate"}, ...]`; entries without date or rate are skipped."""
    entries = responses.select(F.inline(F.from_json("payload", FX_LIST_PAYLOAD)))
    return entries.where("date is not null and rate is not null").select(
        *_rates(F.col("date"), F.col("base"), F.col("quote"), F.col("rate"))
    )


def parse_fx_flat(responses: DataFrame, base: Column, quote: Column) -> DataFrame:
    """Rates of a flat `{date: rate}` map of one currency pair."""
    entries = responses.withColumn("base", base).withColumn("quote", quote).select(
        "base", "quote", F.explode(F.from_json("payload", FX_FLAT_PAYLOAD)).alias("day", "rate")
    )
    return entries.where("rate is not null").select(
        *_rates(F.col("day"), F.col("base"), F.col("quote"), F.col("rate"))
    )
