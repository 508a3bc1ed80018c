"""Pre-joined marts over the Gold star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesloom.functions.dates import is_on_time, key_to_date
from salesloom.functions.numbers import mean, to_usd
from salesloom.functions.text import late_label, or_dash, rain_label
from salesloom.operators.lookups import lookup

ROW = ["order_item_id"]
WEATHER = ["temp_max", "temp_min", "precipitation", "windspeed", "weathercode"]


def sales_enriched(
    fact_sales: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
) -> DataFrame:
    """Sales with date, customer, product and seller attributes; dates outside the calendar drop out."""
    days = dim_date.select(
        "date_key", "year", "quarter", "month", "day_of_week", "is_weekend", "is_month_end"
    )
    customers = dim_customer.select(
        "customer_key", F.col("city").alias("customer_city"), F.col("state").alias("customer_state")
    )
    products = dim_product.select(
        "product_key", F.col("category_name_en").alias("category_english"), "weight_g"
    )
    sellers = dim_store.select("store_key", F.col("state").alias("seller_state"))
    # One row per calendar day.
    sales = fact_sales.join(F.broadcast(days), "date_key")
    for table, key in ((customers, "customer_key"), (products, "product_key"), (sellers, "store_key")):
        sales = lookup(sales, table, {key: key}, ROW)
    return sales.select(
        "order_item_id", "order_id", "order_code", "line_number", "date_key", "year", "quarter",
        "month", "day_of_week", "is_weekend", "is_month_end", "customer_city", "customer_state",
        "category_english", "weight_g", "seller_state", "unit_price", "freight_value", "quantity",
        "delivery_days_actual", "delivery_days_estimated", "order_status",
        *[c for c in fact_sales.columns if c == "_loaded_at"],
    )


def with_daily_weather(
    sales: DataFrame, weather: DataFrame, city: str, state: str, row: list[str]
) -> DataFrame:
    """Left join of daily weather on the day, the normalized city and the state; `row` is the row id."""
    per_day = weather.select("date_key", "city", "state", *WEATHER).withColumnsRenamed(
        {"date_key": "_day", "city": "_city", "state": "_state"}
    )
    on = {"date_key": "_day", city: "_city", state: "_state"}
    return lookup(sales, per_day, on, row)


def sales_with_weather(
    fact_sales: DataFrame, dim_customer: DataFrame, fact_weather: DataFrame
) -> DataFrame:
    """Sales with the customer's place and its weather on the order day, NULL where not covered."""
    customers = dim_customer.select(
        "customer_key",
        F.col("city").alias("customer_city"),
        F.col("normalized_city").alias("customer_city_normalized"),
        F.col("state").alias("customer_state"),
    )
    placed = lookup(fact_sales, customers, {"customer_key": "customer_key"}, ROW)
    sales = with_daily_weather(placed, fact_weather, "customer_city_normalized", "customer_state", ROW)
    return sales.select(
        "order_item_id", "order_code", "date_key", "customer_key", "unit_price", "freight_value",
        "delivery_days_actual", "delivery_days_estimated",
        is_on_time(F.col("delivery_days_actual"), F.col("delivery_days_estimated")).alias("is_on_time"),
        "order_status", "customer_city", "customer_city_normalized", "customer_state", *WEATHER,
    )


def pair_rates(fact_fx: DataFrame, base: str, quote: str, name: str) -> DataFrame:
    """Daily rate of one currency pair."""
    of_pair = (F.col("base_currency") == base) & (F.col("quote_currency") == quote)
    return fact_fx.where(of_pair).select(F.col("date_key"), F.col("rate").alias(name))


def sales_usd(fact_sales: DataFrame, fact_fx: DataFrame) -> DataFrame:
    """Sales in BRL and USD at the rate of the order day; USD is NULL outside the rate series."""
    rates = pair_rates(fact_fx, "USD", "BRL", "usd_to_brl_rate")
    rate = F.col("usd_to_brl_rate")
    # One row per calendar day.
    return fact_sales.join(F.broadcast(rates), "date_key", "left").select(
        "order_item_id", "order_code", "date_key",
        F.col("unit_price").alias("unit_price_brl"),
        F.col("freight_value").alias("freight_value_brl"),
        rate,
        to_usd(F.col("unit_price"), rate).alias("unit_price_usd"),
        to_usd(F.col("freight_value"), rate).alias("freight_value_usd"),
    )


def source_detail(
    fact_sales: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    fact_weather: DataFrame,
    fact_fx: DataFrame,
) -> DataFrame:
    """One row per order line with its place, product, weather and rates, as shown to a reader."""
    customers = dim_customer.select(
        "customer_key", F.col("city").alias("customer_city"),
        F.col("normalized_city").alias("_normalized"), F.col("state").alias("customer_state"),
    )
    products = dim_product.select("product_key", F.col("category_name_en").alias("category_english"))
    sales = lookup(fact_sales, customers, {"customer_key": "customer_key"}, ROW)
    sales = lookup(sales, products, {"product_key": "product_key"}, ROW)
    sales = with_daily_weather(sales, fact_weather, "_normalized", "customer_state", ROW)
    for base, quote, name in (("EUR", "BRL", "eur_brl_rate"), ("EUR", "USD", "eur_usd_rate")):
        # One row per calendar day.
        rates = pair_rates(fact_fx, base, quote, name)
        sales = sales.join(F.broadcast(rates), "date_key", "left")
    return sales.select(
        "order_code", "line_number",
        key_to_date(F.col("date_key")).alias("order_purchase_date"),
        or_dash(F.col("customer_city")).alias("customer_city"),
        or_dash(F.col("customer_state")).alias("customer_state"),
        or_dash(F.col("category_english")).alias("category_english"),
        "unit_price", "freight_value", "quantity", "delivery_days_actual", "delivery_days_estimated",
        late_label(F.col("delivery_days_actual"), F.col("delivery_days_estimated")).alias("delivery_label"),
        "order_status",
        rain_label(F.col("precipitation")).alias("precipitation_label"),
        or_dash(F.col("eur_brl_rate")).alias("eur_brl_label"),
        or_dash(F.col("eur_usd_rate")).alias("eur_usd_label"),
    )


def weather_by_month(fact_weather: DataFrame) -> DataFrame:
    """Monthly weather of each state."""
    day = key_to_date(F.col("date_key"))
    return fact_weather.groupBy(
        F.year(day).alias("year"), F.month(day).alias("month"), "state"
    ).agg(
        mean(F.col("temp_max")).alias("avg_temp_max"),
        mean(F.col("temp_min")).alias("avg_temp_min"),
        F.max("windspeed").alias("max_windspeed"),
        F.sum("precipitation").cast("decimal(28,1)").alias("total_precipitation"),
    )
