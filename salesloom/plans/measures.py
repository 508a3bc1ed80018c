"""Named measures. A filter context is a `where`, a group context a list of columns.

Base measures are aggregate expressions over order totals; derived measures are quotients or sums of
base measures, taken after the aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.functions.dates import key_to_date
from salesloom.functions.fixed import CLEAR_DAY_CODES, HIGH_VALUE_PRICE, RAINY_DAY_MM
from salesloom.functions.numbers import MONEY_TOTAL, line_revenue, mean, money_sum, ratio, to_usd


# Per-order totals, from which every measure over order attributes is computed.
ORDER_TOTALS = {
    "revenue": lambda: F.sum(line_revenue(F.col("unit_price"), F.col("quantity"))),
    "high_value": lambda: F.sum(
        F.when(
            F.col("unit_price") > HIGH_VALUE_PRICE,
            line_revenue(F.col("unit_price"), F.col("quantity")),
        ).otherwise(0)
    ),
    "price": lambda: F.sum("unit_price"),
    "freight": lambda: F.sum("freight_value"),
    "units": lambda: F.sum("quantity"),
    "lines": lambda: F.count(F.lit(1)),
}


def order_totals(lines: DataFrame, orders: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Orders that have lines, with the totals of their lines.

    `by` names attributes of the lines, such as the category: then an order has a row for each of
    their values, and measures grouped by them, alone or with order attributes, count it once each.

    Lines are summed per order before they are joined, partly even before they are shuffled: an
    order with very many lines costs no more than another one, each order is one row afterwards,
    and counting orders needs no distinct.
    """
    totals = lines.groupBy("order_id", *(by or [])).agg(*[c().alias(n) for n, c in ORDER_TOTALS.items()])
    return totals.join(orders, "order_id")


def _delay() -> Column:
    return F.col("delivery_days_actual") - F.col("delivery_days_estimated")


def lines_where(condition: Column) -> Column:
    """Number of lines of the orders for which a condition holds."""
    return F.coalesce(F.sum(F.when(condition, F.col("lines"))), F.lit(0)).cast("long")


def line_mean(value: Column) -> Column:
    """Average of an order attribute over lines: orders count as often as they have lines."""
    return ratio(F.sum(value * F.col("lines")), lines_where(value.isNotNull()))


# Functions, because a Column can only be made while a session is active.
BASE = {
    "total_revenue": lambda: money_sum(F.col("revenue")),
    "total_freight": lambda: money_sum(F.col("freight")),
    "order_count": lambda: F.count(F.lit(1)),
    "units_sold": lambda: F.sum("units").cast("long"),
    "line_count": lambda: F.sum("lines").cast("long"),
    "avg_unit_price": lambda: ratio(F.sum("price"), F.sum("lines")),
    "avg_delivery_days": lambda: line_mean(F.col("delivery_days_actual")),
    "avg_delivery_delay": lambda: line_mean(_delay()),
    "late_delivery_rate": lambda: ratio(lines_where(_delay() > 0), lines_where(_delay().isNotNull())),
    "late_deliveries": lambda: lines_where(_delay() > 0),
    "high_value_revenue": lambda: money_sum(F.col("high_value")),
    "lines_with_customer": lambda: lines_where(F.col("customer_key").isNotNull()),
    "lines_without_customer": lambda: lines_where(F.col("customer_key").isNull()),
}

# Base measures a derived one needs, and its expression over them.
DERIVED = {
    "total_sales_incl_freight": (
        ["total_revenue", "total_freight"],
        lambda revenue, freight: (revenue + freight).cast(MONEY_TOTAL),
    ),
    "average_order_value": (["total_revenue", "order_count"], ratio),
    "freight_pct_of_revenue": (
        ["total_freight", "total_revenue"],
        lambda freight, revenue: ratio(freight, revenue, 0),
    ),
    "avg_freight_per_order": (["total_freight", "order_count"], ratio),
}


def measure(sales: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """The named measures of order totals per group of order attributes, or one row without a group."""
    needed = dict.fromkeys(b for n in names for b in (DERIVED[n][0] if n in DERIVED else [n]))
    totals = sales.groupBy(*by).agg(*[BASE[n]().alias(n) for n in needed])

    def value(name: str) -> Column:
        if name in BASE:
            return F.col(name)
        inputs, combine = DERIVED[name]
        return combine(*[F.col(i) for i in inputs]).alias(name)

    return totals.select(*by, *[value(n) for n in names])


def revenue_in_usd(sales: DataFrame, rates: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Revenue converted at the rate of each day; a day without a rate counts 0.

    Revenue is reduced to one row per day before rates are looked up. `rates` has one row per
    `date_key` with `rate` in local units per dollar.
    """
    by = by or []
    daily = sales.groupBy("date_key", *by).agg(money_sum(F.col("revenue")).alias("revenue"))
    usd = F.coalesce(to_usd(F.col("revenue"), F.col("rate")), F.lit(0).cast("decimal(18,4)"))
    return (
        daily.join(rates, "date_key", "left")
        .groupBy(*by)
        .agg(F.sum(usd).cast("decimal(28,4)").alias("revenue_usd"))
    )


def cross_rates(fx: DataFrame, base: str, local: str, foreign: str) -> DataFrame:
    """Daily local units per foreign unit out of two pairs with the same base."""
    def of(quote: str) -> Column:
        return F.max(F.when(F.col("quote_currency") == quote, F.col("rate")))

    return (
        fx.where((F.col("base_currency") == base) & F.col("quote_currency").isin(local, foreign))
        .groupBy("date_key")
        .agg(ratio(of(local), of(foreign)).alias("rate"))
    )


def latest_cross_rate(latest: DataFrame, base: str, local: str, foreign: str) -> DataFrame:
    """Local units per foreign unit at the latest rates; see `timeseries.latest_rate`."""
    def of(quote: str) -> Column:
        return F.max(F.when(F.col("quote_currency") == quote, F.col("rate")))

    return latest.where(F.col("base_currency") == base).agg(
        of(local).alias("local_rate"),
        of(foreign).alias("foreign_rate"),
        ratio(of(local), of(foreign)).alias("local_per_foreign"),
    )


def weather_revenue(sales: DataFrame, weather: DataFrame, by: list[str]) -> DataFrame:
    """Revenue on rainy and clear days of the customer's place, and their ratio.

    Sales are reduced to one row per day, place and group, and weather to one row per day and
    place, before they are joined. Sales without weather count 0.
    """
    place = ["date_key", "city", "state"]
    per_place = sales.groupBy(*place, *[c for c in by if c not in place]).agg(
        money_sum(F.col("revenue")).alias("revenue")
    )
    conditions = weather.groupBy(*place).agg(
        F.max("precipitation").alias("precipitation"), F.max("weathercode").alias("weathercode")
    )
    zero = F.lit(0).cast(MONEY_TOTAL)

    def revenue_where(condition: Column) -> Column:
        return money_sum(F.when(condition, F.col("revenue")).otherwise(zero))

    return (
        per_place.join(conditions, place, "left")
        .groupBy(*by)
        .agg(
            revenue_where(F.col("precipitation") > RAINY_DAY_MM).alias("rainy_revenue"),
            revenue_where(F.col("weathercode").isin(CLEAR_DAY_CODES)).alias("clear_revenue"),
        )
        .withColumn("rainy_vs_clear", ratio(F.col("rainy_revenue"), F.col("clear_revenue")))
    )


def customer_loyalty(sales: DataFrame) -> DataFrame:
    """Unique customers, orders per customer and the share of customers with several orders."""
    per_customer = sales.where("customer_key is not null").groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("orders")
    )
    customers = F.count(F.lit(1))
    return per_customer.agg(
        customers.alias("unique_customers"),
        ratio(F.sum("orders"), customers, 0).alias("avg_orders_per_customer"),
        ratio(F.count_if(F.col("orders") > 1), customers, 0).alias("repeat_customer_rate"),
    )


def weather_measures(weather: DataFrame, by: list[str]) -> DataFrame:
    """Average temperatures and range, summed daily range, windspeed, rainy and heavy-rain days."""
    high, low = F.col("temp_max"), F.col("temp_min")
    return weather.groupBy(*by).agg(
        mean(high).alias("avg_temp_max"),
        mean(low).alias("avg_temp_min"),
        F.sum(high - low).cast("decimal(28,1)").alias("total_temp_range"),
        mean(F.col("windspeed")).alias("avg_windspeed"),
        F.count_if(F.col("precipitation") > 0).alias("rainy_days"),
        F.count_if(F.col("precipitation") > RAINY_DAY_MM).alias("high_precipitation_days"),
        F.count(F.lit(1)).alias("weather_rows"),
    ).withColumn("avg_temp_range", (F.col("avg_temp_max") - F.col("avg_temp_min")).cast("decimal(18,6)"))


def with_unfiltered_weather(selected: DataFrame, weather: DataFrame) -> DataFrame:
    """Selected days with the average temperature of their city and the maximum wind of their state,
    both over all days whatever the selection."""
    by_city = weather.groupBy("city").agg(mean(F.col("temp_max")).alias("city_avg_temp_max"))
    by_state = weather.groupBy("state").agg(F.max("windspeed").alias("state_max_windspeed"))
    return selected.join(by_city, "city", "left").join(by_state, "state", "left")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = None
    for name, df in tables.items():
        row = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        counts = row if counts is None else counts.unionByName(row)
    return counts


def data_freshness(fact: DataFrame) -> DataFrame:
    """Latest load time of the whole fact, whatever the selection."""
    return fact.agg(
        F.date_format(F.max("_loaded_at"), "yyyy-MM-dd HH:mm 'UTC'").alias("data_freshness")
    )


def date_span(sales: DataFrame, today: Column) -> DataFrame:
    """Selected range in days, and whether its last year is the current one."""
    first, last = key_to_date(F.min("date_key")), key_to_date(F.max("date_key"))
    return sales.agg(
        first.alias("first_date"),
        last.alias("last_date"),
        F.datediff(last, first).alias("range_days"),
        (F.year(last) == F.year(today)).alias("is_current_year"),
    )


def review_measures(reviews: DataFrame) -> DataFrame:
    """Average score, best and worst scores, and average comment length."""
    return reviews.agg(
        F.count(F.lit(1)).alias("review_count"),
        mean(F.col("review_score")).alias("avg_review_score"),
        F.count_if(F.col("review_score") == 5).alias("five_star"),
        F.count_if(F.col("review_score") == 1).alias("one_star"),
        mean(F.col("comment_length")).alias("avg_comment_length"),
    )
