"""Analytic queries: rankings, trends, delivery, freight, weather effects."""

from pyspark.sql import functions as F

from salesloom.catalog.registry import query
from salesloom.catalog.sql import MONEY, mean, ratio
from salesloom.catalog.tables import END, START, Tables
from salesloom.functions.dates import is_on_time
from salesloom.functions.text import normalize_city
from salesloom.plans import analysis, marts

GROSS = f"CAST(sum(unit_price + freight_value) AS {MONEY})"
REVENUE = f"CAST(sum(unit_price * quantity) AS {MONEY})"
ORDERS = "count(DISTINCT order_code)"
BOTH = "delivery_days_actual IS NOT NULL AND delivery_days_estimated IS NOT NULL"


@query(f"""SELECT customer_state, {ORDERS} AS orders, {GROSS} AS revenue_brl
    FROM sales_by_customer GROUP BY customer_state ORDER BY revenue_brl DESC, customer_state LIMIT 10""")
def top_states(t: Tables):
    return analysis.top_states(t.sales_by_customer)


@query(f"""SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
    {GROSS} AS revenue_brl, count(*) AS line_items FROM sales GROUP BY 1, 2""")
def monthly_trend(t: Tables):
    return analysis.monthly_trend(t.sales)


@query(f"""SELECT category, count(*) AS line_items, CAST(sum(unit_price) AS {MONEY}) AS revenue_brl
    FROM sales_by_product WHERE category IS NOT NULL GROUP BY category
    ORDER BY revenue_brl DESC, category LIMIT 15""")
def top_categories(t: Tables):
    return analysis.top_categories(t.lines, t.dim_product)


_BY_CATEGORY = f"(SELECT coalesce(category, 'unknown') AS category, {REVENUE} AS total_revenue FROM sales_by_product GROUP BY 1)"


@query(f"""SELECT CASE WHEN rn <= 10 THEN category ELSE 'All Others' END AS category,
    CAST(sum(total_revenue) AS {MONEY}) AS total_revenue FROM (SELECT *, row_number() OVER (
        ORDER BY total_revenue DESC, category) AS rn FROM {_BY_CATEGORY}) GROUP BY 1""")
def categories_and_others(t: Tables):
    return analysis.categories_and_others(t.lines, t.dim_product)


@query(f"""SELECT customer_state, category, total_revenue FROM (SELECT *, row_number() OVER (
        PARTITION BY customer_state ORDER BY total_revenue DESC, category) AS rn
    FROM (SELECT customer_state, coalesce(category, 'unknown') AS category, {REVENUE} AS total_revenue
        FROM sales_by_customer_product GROUP BY 1, 2)) WHERE rn = 1""")
def top_category_per_state(t: Tables):
    return analysis.top_category_per_state(t.lines_of_customers, t.dim_product)


@query(f"""SELECT {mean('delivery_days_actual')} AS avg_actual_days,
    {mean('delivery_days_estimated')} AS avg_estimated_days,
    {ratio('count(*) FILTER (delivery_days_actual <= delivery_days_estimated) * 100', 'count(*)')}
    AS on_time_pct FROM sales WHERE {BOTH}""")
def delivery_performance(t: Tables):
    return analysis.delivery_performance(t.sales)


@query(f"""SELECT count(*) AS orders, count(a) AS delivered_orders, {mean('a')} AS avg_delivery_days,
    {mean('(a - e)')} AS avg_delivery_delay,
    {ratio('count(*) FILTER (a > e)', 'count(a - e)')} AS late_order_rate
    FROM (SELECT order_code, max(delivery_days_actual) AS a, max(delivery_days_estimated) AS e
        FROM sales GROUP BY order_code)""")
def order_delivery(t: Tables):
    return analysis.order_delivery(t.sales)


_SELLERS = f"""(SELECT seller_state, store_id, count(*) AS line_items, {REVENUE} AS total_revenue,
    CAST(round(CAST(count(*) FILTER (delivery_days_actual <= delivery_days_estimated) AS DOUBLE)
        / nullif(count(*) FILTER ({BOTH}), 0), 4) AS DECIMAL(5,4)) AS on_time_rate
    FROM sales_by_store GROUP BY ALL)"""


@query(f"""SELECT seller_state, store_id, line_items, total_revenue, on_time_rate,
    rank() OVER w AS peer_rank, count(*) OVER (PARTITION BY seller_state) AS peer_count,
    CAST(round(percent_rank() OVER w, 6) AS DECIMAL(18,6)) AS peer_percent_rank,
    CAST(round(CAST(sum(on_time_rate) OVER (PARTITION BY seller_state) AS DOUBLE)
        / count(on_time_rate) OVER (PARTITION BY seller_state), 6) AS DECIMAL(18,6))
        AS state_avg_on_time_rate FROM {_SELLERS}
    WINDOW w AS (PARTITION BY seller_state ORDER BY on_time_rate DESC NULLS LAST)""")
def seller_scorecard(t: Tables):
    return analysis.seller_scorecard(t.sale_lines, t.dim_store).select(
        "seller_state", "store_id", "line_items", "total_revenue", "on_time_rate",
        F.col("peer_rank").cast("long"), F.col("peer_count").cast("long"), "peer_percent_rank",
        "state_avg_on_time_rate",
    )


@query("""SELECT state, customer_id, total_revenue, rank() OVER w AS peer_rank,
    count(*) OVER (PARTITION BY state) AS peer_count,
    CAST(round(percent_rank() OVER w, 6) AS DECIMAL(18,6)) AS peer_percent_rank FROM (
        SELECT customer_state AS state, customer_id, CAST(sum(unit_price * quantity) AS DECIMAL(28,2)) AS total_revenue
        FROM sales_by_customer GROUP BY ALL)
    WINDOW w AS (PARTITION BY state ORDER BY total_revenue DESC NULLS LAST)""")
def customer_ranks(t: Tables):
    """All customers ranked in their state by revenue, which nearly every customer has another value of."""
    return analysis.customer_ranks(t.sales_by_customer)


@query(f"""SELECT category, customer_state, CAST(sum(freight_value) AS {MONEY}) AS freight,
    CAST(sum(unit_price) AS {MONEY}) AS price,
    {ratio('sum(freight_value)', 'sum(unit_price)', '0')} AS freight_ratio
    FROM sales_by_customer_product GROUP BY category, customer_state""")
def freight_ratio(t: Tables):
    return analysis.freight_ratio(t.lines_of_customers, t.dim_product)


@query(f"""SELECT count(*) AS days, CASE WHEN stddev_pop(orders) > 0
    AND stddev_pop(rain) > 0 THEN CAST(round(corr(orders, rain), 6) AS DECIMAL(9,6)) END AS correlation,
    CAST(round(regr_r2(orders, rain), 6) AS DECIMAL(9,6)) AS r_squared FROM
    (SELECT date_key, {ORDERS} AS orders FROM sales_by_customer WHERE customer_state = 'AS' GROUP BY 1) o
    JOIN (SELECT date_key, CAST({mean('precipitation')} AS DOUBLE) AS rain FROM fact_weather
        WHERE state = 'AS' GROUP BY 1) w USING (date_key) WHERE rain IS NOT NULL""")
def weather_correlation(t: Tables):
    return analysis.weather_correlation(t.sales_by_customer, t.fact_weather, "AS")


@query(f"""SELECT date, orders, orders_7d_avg, precipitation, orders > orders_7d_avg AS above_average
    FROM (SELECT date, orders, CAST(round(CAST(sum(orders) OVER w AS DOUBLE) / count(orders) OVER w, 6)
        AS DECIMAL(18,6)) AS orders_7d_avg FROM (SELECT d.date, coalesce(n, 0) AS orders FROM days d
        LEFT JOIN (SELECT order_date, {ORDERS} AS n FROM sales_by_customer
            WHERE customer_state = 'AS' GROUP BY 1) o ON d.date = o.order_date)
        WINDOW w AS (ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)) s
    JOIN (SELECT date AS rain_date, max(precipitation) AS precipitation FROM silver_weather
        WHERE state = 'AS' GROUP BY 1) r ON s.date = r.rain_date WHERE precipitation > 10""")
def rainy_day_orders(t: Tables):
    return analysis.rainy_day_orders(
        t.sales_by_customer, t.fact_weather, t.spark, "AS", START, END, 10
    )


@query(f"""SELECT * FROM (WITH day_types AS (SELECT date_key, CASE WHEN m > 5 THEN 'hot'
        WHEN m < -15 THEN 'cold' ELSE 'moderate' END AS day_type FROM (
        SELECT date_key, {mean('temp_max')} AS m FROM fact_weather GROUP BY 1) WHERE m IS NOT NULL),
    day_counts AS (SELECT day_type, count(*) AS days FROM day_types GROUP BY 1)
    SELECT day_type, category, count(*) AS lines, any_value(days) AS days,
    {ratio('count(*)', 'any_value(days)')} AS lines_per_day
    FROM sales_by_product JOIN day_types USING (date_key) JOIN day_counts USING (day_type)
    GROUP BY day_type, category)""")
def extreme_temperature_shift(t: Tables):
    return analysis.extreme_temperature_shift(t.sale_lines, t.dim_product, t.fact_weather, -15, 5)


@query(f"""SELECT CASE WHEN weathercode IS NULL THEN NULL WHEN weathercode BETWEEN 0 AND 1 THEN 'clear'
         WHEN weathercode BETWEEN 2 AND 3 THEN 'cloudy'
         WHEN weathercode BETWEEN 51 AND 67 OR weathercode BETWEEN 80 AND 82 THEN 'rainy'
         WHEN weathercode BETWEEN 95 AND 99 THEN 'stormy' ELSE 'other' END AS weather_category,
    CAST(sum(unit_price) AS {MONEY}) AS revenue, {ORDERS} AS orders,
    {mean('precipitation')} AS avg_precipitation,
    {ratio('count(*) FILTER (delivery_days_actual <= delivery_days_estimated)', 'count(*)')} AS on_time_share
    FROM sales_by_customer s LEFT JOIN fact_weather w ON w.date_key = s.date_key
        AND w.city = lower(s.customer_city) AND w.state = s.customer_state GROUP BY 1""")
def weather_scatter(t: Tables):
    placed = t.sales_by_customer.select(
        "order_id", "date_key", "price", "lines",
        is_on_time(F.col("delivery_days_actual"), F.col("delivery_days_estimated")).alias("is_on_time"),
        normalize_city(F.col("customer_city")).alias("customer_city"), "customer_state",
    )
    sales = marts.with_daily_weather(
        placed, t.fact_weather, "customer_city", "customer_state", ["order_id"]
    )
    return analysis.weather_scatter(sales)


@query("""SELECT order_code, line_number, customer_state, unit_price, delivery_days_actual,
    delivery_days_estimated, order_status FROM sales_by_customer WHERE order_status = 'delivered'
    ORDER BY delivery_days_actual DESC NULLS LAST, order_code, line_number, unit_price""")
def worst_deliveries(t: Tables):
    """The whole listing, in its order."""
    detail = t.lines_of_customers.select(
        "order_code", "line_number", "customer_state", "unit_price", "delivery_days_actual",
        "delivery_days_estimated", "order_status",
    )
    return analysis.delivery_listing(detail, F.lit("delivered"))
