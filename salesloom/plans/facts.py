"""Gold facts. Every builder resolves natural ids to surrogate keys and keeps rows that find none."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesloom.functions.dates import date_key
from salesloom.operators import skew
from salesloom.operators.keys import assign_surrogate_keys
from salesloom.operators.lookups import lookup


def _with_currency(rows: DataFrame, dim_currency: DataFrame) -> DataFrame:
    """Currency key of each row. Codes are three letters, so the dimension is always small."""
    codes = dim_currency.select("currency_code", "currency_key")
    return rows.join(F.broadcast(codes), "currency_code", "left")


def _keys(dim: DataFrame, natural: str, surrogate: str) -> DataFrame:
    return dim.select(natural, surrogate)


def fact_sales(
    items: DataFrame,
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    dim_currency: DataFrame,
    hot_orders: dict[int, int] | None = None,
) -> DataFrame:
    """Order lines: items of Silver orders with dimension keys and delivery days.

    `hot_orders` are the orders with very many lines, from `skew.hot_keys`.
    """
    header = orders.select(
        "order_id", "order_code", "customer_id", "order_status",
        date_key(F.col("order_date")).alias("date_key"), "source_channel", "currency_code",
        "delivery_days_actual", "delivery_days_estimated",
    )
    row = ["order_item_id"]
    # The customer is looked up once for each order, not for each line.
    header = lookup(
        header, _keys(dim_customer, "customer_id", "customer_key"), {"customer_id": "customer_id"}, ["order_id"]
    ).drop("customer_id")
    lines = skew.join(items, header, ["order_id"], hot_orders or {}, row)
    for dim, natural, surrogate in (
        (dim_product, "product_id", "product_key"),
        (dim_store, "store_id", "store_key"),
    ):
        lines = lookup(lines, _keys(dim, natural, surrogate), {natural: natural}, row)
    return _with_currency(lines, dim_currency).select(
        "order_item_id", "order_id", "order_code", "line_number", "date_key", "customer_key",
        "product_key", "store_key", "currency_key", "order_status", "source_channel",
        "unit_price", "freight_value", "quantity", "delivery_days_actual", "delivery_days_estimated",
    )


def fact_weather_daily(weather: DataFrame) -> DataFrame:
    """Daily weather per city and state."""
    return weather.select(
        date_key(F.col("date")).alias("date_key"), "city", "state", "temp_max", "temp_min",
        "precipitation", "windspeed", "weathercode",
    )


def fact_fx_rates(fx: DataFrame, dim_currency: DataFrame) -> DataFrame:
    """Daily rates; the currency dimension plays the base and the quote role."""
    base = dim_currency.select(
        F.col("currency_code").alias("base_currency"), F.col("currency_key").alias("base_currency_key")
    )
    quote = dim_currency.select(
        F.col("currency_code").alias("quote_currency"), F.col("currency_key").alias("quote_currency_key")
    )
    return (
        fx.join(F.broadcast(base), "base_currency", "left")
        .join(F.broadcast(quote), "quote_currency", "left")
        .select(
            date_key(F.col("date")).alias("date_key"), "base_currency_key", "quote_currency_key",
            "base_currency", "quote_currency", "rate",
        )
    )


def fact_payments(
    payments: DataFrame, orders: DataFrame, dim_customer: DataFrame, dim_currency: DataFrame,
    hot_orders: dict[int, int] | None = None,
) -> DataFrame:
    """Payments of Silver orders; `hot_orders` as for `fact_sales`."""
    header = orders.select(
        "order_id", "order_code", "customer_id",
        date_key(F.col("order_date")).alias("date_key"), "currency_code",
    )
    row = ["order_id", "payment_sequential"]
    paid = skew.join(payments, header, ["order_id"], hot_orders or {}, row)
    paid = lookup(paid, _keys(dim_customer, "customer_id", "customer_key"), {"customer_id": "customer_id"}, row)
    return _with_currency(paid, dim_currency).select(
        "order_id", "order_code", "payment_sequential", "date_key", "customer_key", "currency_key",
        "payment_type", "payment_installments", "payment_value",
    )


def payments_without_order(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Valid payments that the payment fact leaves out because their order is not in Silver."""
    return payments.join(orders.select("order_id"), "order_id", "left_anti")


def fact_reviews(reviews: DataFrame) -> DataFrame:
    """Every review of every order; the same review may belong to several orders."""
    named = reviews.select(
        "review_id", "order_id", "review_score",
        F.length("review_comment_message").alias("comment_length"),
    )
    order = [F.col("review_id"), F.col("order_id")]
    return assign_surrogate_keys(named, "review_key", order)
