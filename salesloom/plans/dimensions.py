"""Gold dimensions. Type 1: the latest row of a business key wins, no history is kept."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom.functions.dates import calendar_columns, date_key
from salesloom.functions.numbers import parse_number
from salesloom.functions.text import currency_name, normalize_city
from salesloom.operators.dedup import keep_last
from salesloom.operators.keys import assign_surrogate_keys
from salesloom.operators.medians import grouped_median
from salesloom.operators.timeseries import calendar

# Currency codes are three letters, so there are at most 26 ** 3 of them.


def dim_date(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day with its calendar attributes."""
    day = F.col("date")
    return calendar(spark, start, end).select(
        date_key(day).alias("date_key"),
        "date",
        *[c.alias(n) for n, c in calendar_columns(day).items()],
    )


def latest_members(
    rows: DataFrame, key: str, columns: list[str | Column], recency: list[Column]
) -> DataFrame:
    """The latest row of every non-null business key."""
    keyed = rows.where(F.col(key).isNotNull())
    return keep_last(keyed, [key], recency).select(*columns)


def customer_members(customers: DataFrame, recency: list[Column]) -> DataFrame:
    """The customers of the dimension, not numbered yet."""
    columns = ["customer_id", "customer_code", "zip_code_prefix", "city", "state", "is_active"]
    members = latest_members(customers, "customer_code", columns, recency)
    return members.withColumn("normalized_city", normalize_city(F.col("city")))


def dim_customer(
    customers: DataFrame, recency: list[Column]
) -> DataFrame:
    return assign_surrogate_keys(
        customer_members(customers, recency), "customer_key", [F.col("customer_code")])


def dim_product(
    products: DataFrame, recency: list[Column]
) -> DataFrame:
    columns = [
        "product_id", "product_code", "category_name_en", "category_name_pt",
        parse_number(F.col("weight_g"), "decimal(10,2)").alias("weight_g"), "is_active",
    ]
    members = latest_members(products, "product_code", columns, recency)
    return assign_surrogate_keys(members, "product_key", [F.col("product_code")])


def dim_store(
    stores: DataFrame, recency: list[Column]
) -> DataFrame:
    columns = ["store_id", "store_code", "zip_code_prefix", "city", "state", "region", "is_active"]
    members = latest_members(stores, "store_code", columns, recency)
    return assign_surrogate_keys(members, "store_key", [F.col("store_code")])


def currency_codes(orders: DataFrame, fx: DataFrame) -> DataFrame:
    """Distinct currency codes of orders and of both sides of the rates."""
    rate_codes = F.explode(F.array("base_currency", "quote_currency")).alias("currency_code")
    # Each part is reduced to its few codes before the union is.
    codes = [orders.select("currency_code").distinct(), fx.select(rate_codes).distinct()]
    return codes[0].union(codes[1]).where("currency_code is not null").distinct()


def dim_currency(orders: DataFrame, fx: DataFrame) -> DataFrame:
    """Currencies in use, keyed in the order of their codes."""
    named = currency_codes(orders, fx).withColumn(
        "currency_name", currency_name(F.col("currency_code"))
    )
    return assign_surrogate_keys(named, "currency_key", [F.col("currency_code")])


def dim_geolocation(points: DataFrame) -> DataFrame:
    """Median coordinates of every zip prefix: outliers among its points do not move it."""
    latitude = grouped_median(points, "zip_code_prefix", F.col("latitude"), "latitude")
    longitude = grouped_median(points, "zip_code_prefix", F.col("longitude"), "longitude")
    return latitude.join(longitude, "zip_code_prefix", "full")


def with_coordinates(dim: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Customer or store dimension with the coordinates of its zip prefix, NULL when unknown."""
    return dim.join(geolocation, "zip_code_prefix", "left")
