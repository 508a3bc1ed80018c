"""Analytic queries.

`sales` stands for order totals (`measures.order_totals`), `lines` for sales lines with the
attributes of their order. Questions about orders are asked of the former, so that only questions
about products and sellers have to carry lines through a join.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom.functions.dates import key_to_date, month_start
from salesloom.functions.numbers import line_revenue, mean, money_sum, ratio
from salesloom.functions.text import weather_category
from salesloom.operators import ranking, timeseries
from salesloom.plans.measures import line_mean, lines_where


def _line_revenue() -> Column:
    return money_sum(line_revenue(F.col("unit_price"), F.col("quantity")))


def _gross() -> Column:
    return money_sum(F.col("price") + F.col("freight"))


def _actual() -> Column:
    return F.col("delivery_days_actual")


def _estimated() -> Column:
    return F.col("delivery_days_estimated")


def top_states(sales: DataFrame, k: int = 10) -> DataFrame:
    """States by price plus freight, with their orders."""
    by_state = sales.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("orders"), _gross().alias("revenue_brl")
    )
    return ranking.top(by_state, k, [F.desc("revenue_brl"), F.asc("customer_state")])


def monthly_trend(sales: DataFrame) -> DataFrame:
    """Price plus freight and line items by month."""
    day = F.col("order_date")
    return sales.groupBy(F.year(day).alias("year"), F.month(day).alias("month")).agg(
        _gross().alias("revenue_brl"), F.sum("lines").alias("line_items")
    )


def _product_totals(lines: DataFrame, products: DataFrame, by: list[str]) -> DataFrame:
    """Totals per product and `by`, with the product's category, looked up after the lines are summed."""
    totals = lines.groupBy("product_id", *by).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("unit_price").alias("price"),
        F.sum("freight_value").alias("freight"),
        F.sum(line_revenue(F.col("unit_price"), F.col("quantity"))).alias("revenue"),
    )
    categories = products.select("product_id", F.col("category_name_en").alias("category"))
    return totals.join(categories, "product_id", "left")


def _by_category(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Totals per category."""
    return _product_totals(lines, products, []).groupBy("category").agg(
        F.sum("lines").alias("line_items"),
        money_sum(F.col("price")).alias("revenue_brl"),
        money_sum(F.col("revenue")).alias("total_revenue"),
    )


def top_categories(lines: DataFrame, products: DataFrame, k: int = 15) -> DataFrame:
    """Categories by price, lines without a category left out."""
    known = _by_category(lines, products).where("category is not null").drop("total_revenue")
    return ranking.top(known, k, [F.desc("revenue_brl"), F.asc("category")])


def categories_and_others(lines: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Revenue of the k best categories and of all the others together."""
    named = _by_category(lines, products).select(
        F.coalesce("category", F.lit("unknown")).alias("category"), "total_revenue"
    )
    ranked = ranking.top_with_others(named, "category", "total_revenue", k, "All Others")
    return ranked.withColumn("total_revenue", F.col("total_revenue").cast("decimal(28,2)"))


def top_category_per_state(lines: DataFrame, products: DataFrame) -> DataFrame:
    """The category with the most revenue in each state; products without one count as unknown."""
    category = F.coalesce("category", F.lit("unknown")).alias("category")
    revenue = _product_totals(lines, products, ["customer_state"]).groupBy("customer_state", category).agg(
        money_sum(F.col("revenue")).alias("total_revenue")
    )
    return ranking.first_per_group(
        revenue, ["customer_state"], [F.desc("total_revenue"), F.asc("category")]
    )


def delivery_performance(sales: DataFrame) -> DataFrame:
    """Average actual and promised days and the on-time share of delivered lines."""
    delivered = sales.where(_actual().isNotNull() & _estimated().isNotNull())
    return delivered.agg(
        line_mean(_actual()).alias("avg_actual_days"),
        line_mean(_estimated()).alias("avg_estimated_days"),
        ratio(lines_where(_actual() <= _estimated()) * 100, F.sum("lines")).alias("on_time_pct"),
    )


def order_delivery(sales: DataFrame) -> DataFrame:
    """Delivery measures per order instead of per line."""
    delay = _actual() - _estimated()
    return sales.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count(_actual()).alias("delivered_orders"),
        mean(_actual()).alias("avg_delivery_days"),
        mean(delay).alias("avg_delivery_delay"),
        ratio(F.count_if(delay > 0), F.count(delay)).alias("late_order_rate"),
    )


def seller_scorecard(lines: DataFrame, stores: DataFrame) -> DataFrame:
    """On-time rate and volume of each seller, ranked among the sellers of its state.

    Lines are summed per seller before the state is looked up. The rate has four decimals, so a
    state has at most 10,001 distinct rates to rank.
    """
    both = _actual().isNotNull() & _estimated().isNotNull()
    on_time = F.count_if(_actual() <= _estimated()).cast("double")
    per_seller = lines.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("line_items"),
        _line_revenue().alias("total_revenue"),
        F.round(F.try_divide(on_time, F.count_if(both).cast("double")), 4)
        .cast("decimal(5,4)")
        .alias("on_time_rate"),
    )
    placed = per_seller.join(
        stores.select("store_id", F.col("state").alias("seller_state")), "store_id"
    )
    return ranking.rank_within(placed, "seller_state", "on_time_rate").withColumnRenamed(
        "peer_average", "state_avg_on_time_rate"
    )


def customer_ranks(sales: DataFrame) -> DataFrame:
    """Revenue of each customer and its rank among the customers of its state."""
    revenue = sales.groupBy(F.col("customer_state").alias("state"), "customer_id").agg(
        money_sum(F.col("revenue")).alias("total_revenue"))
    return ranking.rank_in_ranges(revenue, "state", "total_revenue").select(
        "state", "customer_id", "total_revenue", "peer_rank", "peer_count", "peer_percent_rank")


def freight_ratio(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Freight as a share of price by category and region."""
    totals = _product_totals(lines, products, ["customer_state"])
    return totals.groupBy("category", "customer_state").agg(
        money_sum(F.col("freight")).alias("freight"),
        money_sum(F.col("price")).alias("price"),
        ratio(F.sum("freight"), F.sum("price"), 0).alias("freight_ratio"),
    )


def weather_correlation(sales: DataFrame, weather: DataFrame, state: str) -> DataFrame:
    """Correlation and R squared of daily orders of a state with its average rain of the day."""
    orders = (
        sales.where(F.col("customer_state") == state)
        .groupBy("date_key")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    rain = (
        weather.where(F.col("state") == state)
        .groupBy("date_key")
        .agg(mean(F.col("precipitation")).cast("double").alias("rain"))
    )
    # NULL when one of the two never varies; the built-in correlation would fail.
    spread = F.stddev_pop("rain") * F.stddev_pop("orders")
    correlation = F.try_divide(F.covar_pop("rain", "orders"), spread)
    return orders.join(rain, "date_key").where("rain is not null").agg(
        F.count(F.lit(1)).alias("days"),
        F.round(correlation, 6).cast("decimal(9,6)").alias("correlation"),
        F.round(F.regr_r2("orders", "rain"), 6).cast("decimal(9,6)").alias("r_squared"),
    )


def rainy_day_orders(
    sales: DataFrame, weather: DataFrame, spark: SparkSession, state: str, start: date, end: date, rain_mm: float
) -> DataFrame:
    """Rainy days of a state with its orders against the average of the last seven days."""
    orders = sales.where(F.col("customer_state") == state)
    daily = timeseries.daily_totals(
        orders, spark, "order_date", {"orders": F.count(F.lit(1))}, start, end
    ).fillna(0, ["orders"])
    smoothed = timeseries.rolling_mean(daily, "orders", 7, "orders_7d_avg")
    rain = (
        weather.where(F.col("state") == state)
        .groupBy(key_to_date(F.col("date_key")).alias("date"))
        .agg(F.max("precipitation").alias("precipitation"))
        .where(F.col("precipitation") > rain_mm)
    )
    return smoothed.join(rain, "date").withColumn(
        "above_average", F.col("orders") > F.col("orders_7d_avg")
    )


def extreme_temperature_shift(
    lines: DataFrame, products: DataFrame, weather: DataFrame, cold_below: float, hot_above: float
) -> DataFrame:
    """Average daily lines of each category on hot, cold and moderate days.

    A day's temperature is the average maximum over all places. The thresholds are parameters:
    what counts as extreme depends on the climate.
    """
    temperature = F.col("temp")
    days = (
        weather.groupBy("date_key")
        .agg(mean(F.col("temp_max")).alias("temp"))
        .where("temp is not null")
        .select(
            "date_key",
            F.when(temperature > hot_above, "hot")
            .when(temperature < cold_below, "cold")
            .otherwise("moderate")
            .alias("day_type"),
        )
    )
    day_counts = days.groupBy("day_type").agg(F.count(F.lit(1)).alias("days"))
    per_type = _product_totals(lines.join(days, "date_key"), products, ["day_type"]).groupBy(
        "category", "day_type"
    ).agg(F.sum("lines").alias("lines"))
    return per_type.join(day_counts, "day_type").withColumn(
        "lines_per_day", ratio(F.col("lines"), F.col("days"))
    )


def weather_scatter(sales_weather: DataFrame) -> DataFrame:
    """Revenue, orders, average rain and on-time share by weather category of the order day."""
    category = weather_category(F.col("weathercode")).alias("weather_category")
    return sales_weather.groupBy(category).agg(
        money_sum(F.col("price")).alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        line_mean(F.col("precipitation")).alias("avg_precipitation"),
        ratio(lines_where(F.col("is_on_time")), F.sum("lines")).alias("on_time_share"),
    )


def monthly_revenue(
    sales: DataFrame, spark: SparkSession, start: date, end: date, by: list[str] | None = None
) -> DataFrame:
    """Revenue and orders of every month of [start, end], per group, NULL in a month without sales."""
    by = by or []
    totals = sales.groupBy(*by, month_start(F.col("order_date")).alias("month")).agg(
        money_sum(F.col("revenue")).alias("total_revenue"), F.count(F.lit(1)).alias("order_count")
    )
    spine = timeseries.calendar_per_group(spark, start, end, "month", totals, by)
    return spine.join(totals, [*by, "month"], "left")


def daily_revenue(
    sales: DataFrame, spark: SparkSession, start: date, end: date, by: list[str] | None = None
) -> DataFrame:
    """Revenue of every day of [start, end], per group."""
    revenue = {"total_revenue": money_sum(F.col("revenue"))}
    return timeseries.daily_totals(sales, spark, "order_date", revenue, start, end, by)


def listing(detail: DataFrame, order: list[Column], ties: list[str]) -> DataFrame:
    """All detail rows in the order of the listing; `ties` decide among rows that it leaves equal."""
    return detail.orderBy(*order, *ties)


def delivery_listing(detail: DataFrame, status: Column) -> DataFrame:
    """All detail rows of a status, those with the most delivery days first."""
    return detail.where(F.col("order_status") == status).orderBy(
        F.desc_nulls_last("delivery_days_actual"), "order_code", "line_number", "unit_price"
    )
