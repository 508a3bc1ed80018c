"""Measures, time comparisons, currency and weather measures."""

from datetime import date

from pyspark.sql import functions as F

from salesloom.catalog.queries_sources import LOAD_TIMES, three_loads
from salesloom.catalog.registry import query
from salesloom.catalog.sql import MONEY, mean, ratio
from salesloom.catalog.tables import END, START, Tables
from salesloom.functions.numbers import line_revenue, money_sum
from salesloom.functions.text import change_label, normalize_city
from salesloom.operators import timeseries
from salesloom.operators.dedup import keep_last
from salesloom.plans import analysis, facts, marts, measures

REVENUE = f"CAST(sum(unit_price * quantity) AS {MONEY})"
FREIGHT = f"CAST(sum(freight_value) AS {MONEY})"
ORDERS = "count(DISTINCT order_code)"
DELAY = "(delivery_days_actual - delivery_days_estimated)"


@query(f"SELECT customer_state, {REVENUE} AS total_revenue, {ORDERS} AS order_count"
       " FROM sales_by_customer GROUP BY customer_state")
def revenue_by_state(t: Tables):
    return measures.measure(t.sales_by_customer, ["customer_state"], ["total_revenue", "order_count"])


@query(f"""SELECT order_status, {REVENUE} AS total_revenue, {FREIGHT} AS total_freight,
    CAST({REVENUE} + {FREIGHT} AS {MONEY}) AS total_sales_incl_freight, {ORDERS} AS order_count,
    CAST(sum(quantity) AS BIGINT) AS units_sold, count(*) AS line_count,
    {ratio(REVENUE, ORDERS)} AS average_order_value,
    {ratio(FREIGHT, REVENUE, '0')} AS freight_pct_of_revenue,
    {ratio(FREIGHT, ORDERS)} AS avg_freight_per_order
    FROM sales GROUP BY order_status""")
def sales_measures(t: Tables):
    names = [
        "total_revenue", "total_freight", "total_sales_incl_freight", "order_count", "units_sold",
        "line_count", "average_order_value", "freight_pct_of_revenue", "avg_freight_per_order",
    ]
    return measures.measure(t.sales, ["order_status"], names)


@query(f"""SELECT {mean('delivery_days_actual')} AS avg_delivery_days,
    {mean(DELAY)} AS avg_delivery_delay,
    {ratio(f'count(*) FILTER ({DELAY} > 0)', f'count({DELAY})')} AS late_delivery_rate,
    count(*) FILTER ({DELAY} > 0) AS late_deliveries,
    CAST(sum(CASE WHEN unit_price > 500 THEN unit_price * quantity ELSE 0 END) AS {MONEY})
        AS high_value_revenue, {mean('unit_price')} AS avg_unit_price,
    count(customer_key) AS lines_with_customer,
    count(*) FILTER (customer_key IS NULL) AS lines_without_customer FROM sales""")
def delivery_measures(t: Tables):
    names = [
        "avg_delivery_days", "avg_delivery_delay", "late_delivery_rate", "late_deliveries",
        "high_value_revenue", "avg_unit_price", "lines_with_customer", "lines_without_customer",
    ]
    return measures.measure(t.sales, [], names)


_LOYALTY = """(SELECT customer_key, count(DISTINCT order_code) AS orders FROM sales
    WHERE customer_key IS NOT NULL GROUP BY customer_key)"""


@query(f"""SELECT count(*) AS unique_customers, {ratio('sum(orders)', 'count(*)', '0')}
    AS avg_orders_per_customer,
    {ratio('count(*) FILTER (orders > 1)', 'count(*)', '0')} AS repeat_customer_rate
    FROM {_LOYALTY}""")
def customer_loyalty(t: Tables):
    return measures.customer_loyalty(t.sales)


_SLICED = ["total_revenue", "order_count", "average_order_value", "line_count"]


def _sliced(attribute: str, view: str) -> str:
    return f"""SELECT {attribute}, {REVENUE} AS total_revenue, {ORDERS} AS order_count,
        {ratio(REVENUE, ORDERS)} AS average_order_value, count(*) AS line_count
        FROM {view} GROUP BY {attribute}"""


@query(_sliced("category", "sales_by_product"))
def measures_by_category(t: Tables):
    return measures.measure(t.sales_by("category"), ["category"], _SLICED)


@query(_sliced("seller_state", "sales_by_store"))
def measures_by_seller_state(t: Tables):
    return measures.measure(t.sales_by("seller_state"), ["seller_state"], _SLICED)


_FACT_TOTALS = f"""{REVENUE} AS total_revenue, {FREIGHT} AS total_freight,
    CAST(sum(quantity) AS BIGINT) AS units_sold, count(*) AS line_count FROM fact_sales"""


@query(f"SELECT 'measures' AS base, {_FACT_TOTALS} UNION ALL SELECT 'fact', {_FACT_TOTALS}")
def measures_reconcile(t: Tables):
    """The measures over all sales, and plain aggregates of the fact: the same figures twice."""
    names = ["total_revenue", "total_freight", "units_sold", "line_count"]
    measured = measures.measure(t.sales, [], names).select(F.lit("measures").alias("base"), *names)
    revenue = money_sum(line_revenue(F.col("unit_price"), F.col("quantity")))
    plain = t.fact_sales.agg(
        F.lit("fact").alias("base"), revenue.alias("total_revenue"),
        money_sum(F.col("freight_value")).alias("total_freight"),
        F.sum("quantity").cast("long").alias("units_sold"), F.count(F.lit(1)).alias("line_count"),
    )
    return measured.unionByName(plain)


# Time comparisons.

_DAILY = f"""(SELECT d.date, total_revenue FROM days d LEFT JOIN (
    SELECT order_date AS date, {REVENUE} AS total_revenue FROM sales GROUP BY order_date) r
    ON d.date = r.date)"""
_MONTHLY = f"""(SELECT m.month, total_revenue, order_count FROM month_list m LEFT JOIN (
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {REVENUE} AS total_revenue,
    {ORDERS} AS order_count FROM sales GROUP BY 1) r ON m.month = r.month)"""


def _running(*parts: str) -> str:
    return f"CAST(sum(total_revenue) OVER (PARTITION BY {', '.join(parts)} ORDER BY date) AS {MONEY})"


@query(f"""SELECT date, total_revenue, {_running('year(date)')} AS total_revenue_ytd,
    {_running('year(date)', 'quarter(date)')} AS total_revenue_qtd,
    {_running('year(date)', 'month(date)')} AS total_revenue_mtd FROM {_DAILY}""")
def revenue_to_date(t: Tables):
    daily = analysis.daily_revenue(t.sales, t.spark, START, END)
    return timeseries.to_date_totals(daily, "total_revenue")


def _change(prior: str) -> str:
    return ratio(f"(total_revenue - {prior})", prior)


@query(f"""SELECT month, total_revenue, order_count, lag(total_revenue) OVER (ORDER BY month)
        AS prior_month,
    {_change('lag(total_revenue) OVER (ORDER BY month)')} AS mom_change,
    lag(total_revenue, 12) OVER (ORDER BY month) AS prior_year,
    {_change('lag(total_revenue, 12) OVER (ORDER BY month)')} AS yoy_change FROM {_MONTHLY}""")
def revenue_growth(t: Tables):
    monthly = analysis.monthly_revenue(t.sales, t.spark, START, END)
    with_month = timeseries.monthly_change(monthly, "total_revenue", 1, "prior_month", "mom_change")
    return timeseries.monthly_change(with_month, "total_revenue", 12, "prior_year", "yoy_change")


@query(f"""SELECT month, CASE WHEN c > 0 THEN '▲ +' || CAST(round(abs(c) * 100, 1) AS DECIMAL(18,1)) || '% (UP)'
    WHEN c < 0 THEN '▼ -' || CAST(round(abs(c) * 100, 1) AS DECIMAL(18,1)) || '% (DOWN)'
    ELSE '▬ 0.0% (FLAT)' END AS trend FROM (SELECT month,
        {_change('lag(total_revenue) OVER (ORDER BY month)')} AS c FROM {_MONTHLY})""")
def revenue_trend_labels(t: Tables):
    monthly = analysis.monthly_revenue(t.sales, t.spark, START, END)
    changed = timeseries.monthly_change(monthly, "total_revenue", 1, "prior", "change")
    return changed.select("month", change_label(F.col("change")).alias("trend"))


@query(f"""SELECT date, total_revenue, CAST(sum(total_revenue) OVER (ORDER BY date
    RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS {MONEY}) AS revenue_30d
    FROM {_DAILY}""")
def rolling_revenue(t: Tables):
    daily = analysis.daily_revenue(t.sales, t.spark, START, END)
    return timeseries.rolling_sum(daily, "total_revenue", 30, "revenue_30d")


_PRIOR3 = "OVER (ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"


@query(f"""SELECT month, order_count, prior_average,
    {ratio('(CAST(order_count AS DOUBLE) - CAST(prior_average AS DOUBLE))', 'prior_average')} AS change_pct
    FROM (SELECT month, order_count,
        CAST(round(CAST(sum(order_count) {_PRIOR3} AS DOUBLE) / count(order_count) {_PRIOR3}, 6)
            AS DECIMAL(18,6)) AS prior_average FROM {_MONTHLY})""")
def orders_against_prior_months(t: Tables):
    monthly = analysis.monthly_revenue(t.sales, t.spark, START, END).select("month", "order_count")
    return timeseries.compare_prior_months(monthly, "order_count", 3)


# The same per group: every day or month of the range for every state of a customer.

_STATES = "(SELECT DISTINCT customer_state FROM sales_by_customer)"
_DAILY_BY_STATE = f"""(SELECT customer_state, date, total_revenue FROM (SELECT * FROM {_STATES}, days)
    LEFT JOIN (SELECT customer_state, order_date AS date, {REVENUE} AS total_revenue
        FROM sales_by_customer GROUP BY 1, 2) USING (customer_state, date))"""
_MONTHLY_BY_STATE = f"""(SELECT customer_state, month, total_revenue, order_count
    FROM (SELECT * FROM {_STATES}, month_list)
    LEFT JOIN (SELECT customer_state, CAST(date_trunc('month', order_date) AS DATE) AS month,
        {REVENUE} AS total_revenue, {ORDERS} AS order_count
        FROM sales_by_customer GROUP BY 1, 2) USING (customer_state, month))"""
_STATE = ["customer_state"]


@query(f"""SELECT customer_state, date, total_revenue,
    {_running('customer_state', 'year(date)')} AS total_revenue_ytd,
    {_running('customer_state', 'year(date)', 'quarter(date)')} AS total_revenue_qtd,
    {_running('customer_state', 'year(date)', 'month(date)')} AS total_revenue_mtd
    FROM {_DAILY_BY_STATE}""")
def revenue_to_date_by_state(t: Tables):
    daily = analysis.daily_revenue(t.sales_by_customer, t.spark, START, END, _STATE)
    return timeseries.to_date_totals(daily, "total_revenue", _STATE)


_BEFORE = "OVER (PARTITION BY customer_state ORDER BY month)"


@query(f"""SELECT customer_state, month, total_revenue, order_count,
    lag(total_revenue) {_BEFORE} AS prior_month,
    {_change(f'lag(total_revenue) {_BEFORE}')} AS mom_change,
    lag(total_revenue, 12) {_BEFORE} AS prior_year,
    {_change(f'lag(total_revenue, 12) {_BEFORE}')} AS yoy_change FROM {_MONTHLY_BY_STATE}""")
def revenue_growth_by_state(t: Tables):
    monthly = analysis.monthly_revenue(t.sales_by_customer, t.spark, START, END, _STATE)
    with_month = timeseries.monthly_change(
        monthly, "total_revenue", 1, "prior_month", "mom_change", _STATE
    )
    return timeseries.monthly_change(with_month, "total_revenue", 12, "prior_year", "yoy_change", _STATE)


@query(f"""SELECT customer_state, date, total_revenue, CAST(sum(total_revenue) OVER (
    PARTITION BY customer_state ORDER BY date
    RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS {MONEY}) AS revenue_30d
    FROM {_DAILY_BY_STATE}""")
def rolling_revenue_by_state(t: Tables):
    daily = analysis.daily_revenue(t.sales_by_customer, t.spark, START, END, _STATE)
    return timeseries.rolling_sum(daily, "total_revenue", 30, "revenue_30d", _STATE)


# Exchange rates.


@query("SELECT date, base_currency, quote_currency, rate FROM filled_fx")
def fx_gap_fill(t: Tables):
    usable = t.fx.where(F.col("date").between(F.lit(START), F.lit(END))).where("base_currency is not null")
    pair = ["base_currency", "quote_currency"]
    daily = keep_last(usable, [*pair, "date"], [F.col("event_id")]).drop("event_id")
    return timeseries.fill_calendar(daily, pair, "date", "rate", START, END)


@query("""SELECT base_currency, quote_currency, max(date_key) AS date_key,
    arg_max(rate, date_key) AS rate FROM fact_fx GROUP BY ALL""")
def latest_rates(t: Tables):
    return timeseries.latest_rate(t.fact_fx)


def _latest(quote: str) -> str:
    return (
        "(SELECT arg_max(rate, date_key) FROM fact_fx WHERE base_currency = 'EUR'"
        f" AND quote_currency = '{quote}')"
    )


@query(f"SELECT {_latest('BRL')} AS local_rate, {_latest('USD')} AS foreign_rate,"
       f" {ratio(_latest('BRL'), _latest('USD'))} AS local_per_foreign")
def cross_rate(t: Tables):
    return measures.latest_cross_rate(timeseries.latest_rate(t.fact_fx), "EUR", "BRL", "USD")


_DAY_REVENUE = f"(SELECT date_key, {REVENUE} AS revenue FROM sales GROUP BY date_key)"


def _usd(rates: str) -> str:
    return f"""SELECT CAST(sum(coalesce(CAST(round(revenue / rate, 4) AS DECIMAL(18,4)), 0))
        AS DECIMAL(28,4)) AS revenue_usd FROM {_DAY_REVENUE} LEFT JOIN {rates} r USING (date_key)"""


@query(_usd("""(SELECT date_key, rate FROM fact_fx WHERE base_currency = 'USD'
    AND quote_currency = 'BRL')"""))
def revenue_in_usd(t: Tables):
    return measures.revenue_in_usd(t.sales, marts.pair_rates(t.fact_fx, "USD", "BRL", "rate"))


@query(_usd(f"""(SELECT b.date_key, {ratio('b.rate', 'u.rate')} AS rate FROM fact_fx b
    JOIN fact_fx u ON b.date_key = u.date_key WHERE b.base_currency = 'EUR'
    AND u.base_currency = 'EUR' AND b.quote_currency = 'BRL' AND u.quote_currency = 'USD')"""))
def revenue_in_usd_cross(t: Tables):
    return measures.revenue_in_usd(t.sales, measures.cross_rates(t.fact_fx, "EUR", "BRL", "USD"))


@query(f"""SELECT base_currency, quote_currency,
    {ratio('(max(rate) - min(rate))', 'min(rate)', '0')} AS fx_range_pct,
    {ratio('(arg_max(rate, date_key) - arg_min(rate, date_key))', 'arg_min(rate, date_key)', '0')}
        AS fx_change_pct FROM fact_fx GROUP BY ALL""")
def fx_range(t: Tables):
    return timeseries.rate_range(t.fact_fx)


@query(f"""SELECT base_currency, quote_currency, week_start, rate, change_pct,
    abs(change_pct) > 0.02 AS is_large_move FROM (SELECT *, {ratio('(rate - previous)', 'previous')} AS change_pct
    FROM (SELECT *, lag(rate) OVER (PARTITION BY base_currency, quote_currency ORDER BY week_start)
        AS previous FROM (SELECT base_currency, quote_currency,
            CAST(date_trunc('week', date) AS DATE) AS week_start, arg_max(rate, date) AS rate
            FROM silver_fx GROUP BY ALL)))""")
def fx_weekly_moves(t: Tables):
    return timeseries.weekly_moves(t.silver_fx, 0.02)


# Weather.


@query(f"""SELECT state, CAST(sum(CASE WHEN precipitation > 10 THEN revenue ELSE 0 END) AS {MONEY})
        AS rainy_revenue,
    CAST(sum(CASE WHEN weathercode IN (0, 1, 2) THEN revenue ELSE 0 END) AS {MONEY}) AS clear_revenue,
    {ratio('sum(CASE WHEN precipitation > 10 THEN revenue ELSE 0 END)',
           'sum(CASE WHEN weathercode IN (0, 1, 2) THEN revenue ELSE 0 END)')} AS rainy_vs_clear
    FROM (SELECT s.customer_state AS state, unit_price * quantity AS revenue, w.precipitation,
        w.weathercode FROM sales_by_customer s LEFT JOIN fact_weather w
        ON w.date_key = s.date_key AND w.city = lower(s.customer_city) AND w.state = s.customer_state)
    GROUP BY state""")
def weather_revenue(t: Tables):
    placed = t.sales_by_customer.withColumn("city", normalize_city(F.col("customer_city")))
    return measures.weather_revenue(
        placed.withColumnRenamed("customer_state", "state"), t.fact_weather, ["state"]
    )


@query(f"""SELECT state, {mean('temp_max')} AS avg_temp_max, {mean('temp_min')} AS avg_temp_min,
    CAST(sum(temp_max - temp_min) AS DECIMAL(28,1)) AS total_temp_range,
    {mean('windspeed')} AS avg_windspeed, count(*) FILTER (precipitation > 0) AS rainy_days,
    count(*) FILTER (precipitation > 10) AS high_precipitation_days, count(*) AS weather_rows,
    CAST({mean('temp_max')} - {mean('temp_min')} AS DECIMAL(18,6)) AS avg_temp_range
    FROM fact_weather GROUP BY state""")
def weather_measures(t: Tables):
    return measures.weather_measures(t.fact_weather, ["state"])


@query(f"""SELECT date_key, w.city, w.state, temp_max, city_avg_temp_max, state_max_windspeed
    FROM fact_weather w
    JOIN (SELECT city, {mean('temp_max')} AS city_avg_temp_max FROM fact_weather GROUP BY city) c
        ON w.city = c.city
    JOIN (SELECT state, max(windspeed) AS state_max_windspeed FROM fact_weather GROUP BY state) s
        ON w.state = s.state WHERE date_key >= 20000101""")
def weather_against_all_days(t: Tables):
    selected = t.fact_weather.where("date_key >= 20000101").select(
        "date_key", "city", "state", "temp_max"
    )
    return measures.with_unfiltered_weather(selected, t.fact_weather)


# Counts, freshness, spans, reviews.


# Table, view in SQL, and attribute of the tables: everything that is read and loaded.
_COUNTED = [
    ("customers", "src_customers", "customers"), ("stores", "src_stores", "stores"),
    ("products", "src_products", "products"), ("orders", "src_orders", "orders"),
    ("order_items", "src_items", "order_items"), ("payments", "src_payments", "payments"),
    ("weather", "src_weather", "weather"), ("fx", "src_fx", "fx"), ("reviews", "reviews", "reviews"),
    ("geolocation", "geolocation", "geolocation"), ("dim_date", "dim_date", "dim_date"),
    ("dim_customer", "dim_customer", "dim_customer"), ("dim_product", "dim_product", "dim_product"),
    ("dim_store", "dim_store", "dim_store"), ("dim_currency", "dim_currency", "dim_currency"),
    ("fact_sales", "fact_sales", "fact_sales"), ("fact_weather_daily", "fact_weather", "fact_weather"),
    ("fact_fx_rates", "fact_fx", "fact_fx"), ("fact_payments", "fact_payments", "fact_payments"),
]


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {view}" for name, view, _ in _COUNTED
))
def table_row_counts(t: Tables):
    """Rows of all source and warehouse tables."""
    return measures.row_counts({name: getattr(t, attribute) for name, _, attribute in _COUNTED})


@query(f"""SELECT strftime(max({LOAD_TIMES}), '%Y-%m-%d %H:%M UTC') AS data_freshness FROM fact_sales
    WHERE date_key IS NOT NULL""")
def data_freshness(t: Tables):
    """Latest load time of the sales fact after three loads."""
    return measures.data_freshness(three_loads(t, {"fact_sales": "fact_sales"}).read("fact_sales"))


@query("""SELECT min(order_date) AS first_date, max(order_date) AS last_date,
    CAST(date_diff('day', min(order_date), max(order_date)) AS INTEGER) AS range_days,
    year(max(order_date)) = 2001 AS is_current_year FROM sales""")
def date_span(t: Tables):
    return measures.date_span(t.sales, F.lit(date(2001, 12, 31)))


@query(f"""SELECT count(*) AS review_count, {mean('review_score')} AS avg_review_score,
    count(*) FILTER (review_score = 5) AS five_star, count(*) FILTER (review_score = 1) AS one_star,
    {mean('length(review_comment_message)')} AS avg_comment_length FROM reviews""")
def review_measures(t: Tables):
    return measures.review_measures(facts.fact_reviews(t.reviews))
