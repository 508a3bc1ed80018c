"""Source tables, dimensions, facts, marts and the joins behind them."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from salesloom.catalog.registry import query
from salesloom.catalog.sql import MONEY, RUN, mean
from salesloom.catalog.tables import END, RUN_AT, Tables
from salesloom.functions.dates import date_key
from salesloom.functions.numbers import money_sum
from salesloom.operators import dedup, keys, lookups, skew
from salesloom.plans import analysis, dimensions, facts, marts, source_tables

# Source tables from the raw files.


@query("SELECT * FROM source_customers")
def source_customers(t: Tables):
    return t.source_customers


@query("SELECT * FROM source_stores")
def source_stores(t: Tables):
    return t.source_stores


@query("SELECT * FROM source_products")
def source_products(t: Tables):
    return t.source_products


@query("SELECT * FROM source_orders")
def source_orders(t: Tables):
    return t.source_orders[0]


@query("""SELECT 'customer_id' AS key_column, count(*) AS missing_rows,
    (SELECT string_agg(k, ', ') FROM (SELECT DISTINCT customer_id AS k FROM raw_orders
        WHERE customer_id NOT IN (SELECT customer_id FROM raw_customers) ORDER BY k LIMIT 5))
        AS sample_keys
    FROM raw_orders WHERE customer_id NOT IN (SELECT customer_id FROM raw_customers)
    UNION ALL SELECT 'customer_unique_id' AS key_column,
    CAST(count(*) FILTER (c.customer_id IS NULL) AS BIGINT) AS missing_rows,
    (SELECT string_agg(k, ', ') FROM (SELECT DISTINCT r.customer_unique_id AS k FROM raw_orders o
        JOIN raw_customers r ON o.customer_id = r.customer_id
        WHERE r.customer_unique_id NOT IN (SELECT customer_code FROM src_customers
            WHERE customer_code IS NOT NULL) ORDER BY k LIMIT 5)) AS sample_keys
    FROM raw_orders o JOIN raw_customers r ON o.customer_id = r.customer_id
    LEFT JOIN src_customers c ON r.customer_unique_id = c.customer_code""")
def unresolved_customers(t: Tables):
    """Report of two key lookups that miss: orders without a person, persons without a code."""
    _, report = source_tables.orders(
        t.raw_orders, t.raw_customers, t.customers, RUN_AT
    )
    shown = F.nullif(F.concat_ws(", ", "sample_keys"), F.lit(""))
    return report.withColumn("sample_keys", shown)


@query(f"""SELECT * FROM (WITH first_items AS (SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY order_id, order_item_id
        ORDER BY product_id, seller_id, price, freight_value, shipping_limit_date) AS rn
        FROM raw_order_items) WHERE rn = 1)
    SELECT row_number() OVER (ORDER BY o.order_id, order_item_id) AS order_item_id,
    o.order_id, p.product_id, s.store_id, order_item_id AS line_number, price AS unit_price,
    freight_value, CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date, 1 AS quantity,
    {RUN} AS created_at, {RUN} AS ingested_at
    FROM first_items i JOIN source_orders o ON i.order_id = o.order_code
    JOIN source_products p ON i.product_id = p.product_code
    JOIN source_stores s ON i.seller_id = s.store_code)""")
def source_order_items(t: Tables):
    items, _ = source_tables.order_items(
        t.raw_order_items, t.source_orders[0], t.source_products, t.source_stores, RUN_AT
    )
    return items


@query(f"""SELECT row_number() OVER (ORDER BY o.order_id, payment_sequential) AS payment_id,
    o.order_id, payment_sequential, payment_type, payment_installments, payment_value,
    {RUN} AS created_at, {RUN} AS ingested_at
    FROM raw_payments p JOIN source_orders o ON p.order_id = o.order_code""")
def source_payments(t: Tables):
    payments, _ = source_tables.payments(
        t.raw_payments, t.source_orders[0], RUN_AT
    )
    return payments


def _missed(key: str, rows: str, table: str, code: str) -> str:
    return f"""SELECT '{key}' AS key_column, CAST(count(*) AS BIGINT) AS missing_rows,
        (SELECT string_agg(k, ', ') FROM (SELECT DISTINCT {key} AS k FROM {rows}
            WHERE {key} NOT IN (SELECT {code} FROM {table}) ORDER BY k LIMIT 5)) AS sample_keys
        FROM {rows} WHERE {key} NOT IN (SELECT {code} FROM {table})"""


@query(f"""SELECT * FROM (WITH items AS (SELECT order_id AS order_code, product_id AS product_code,
        seller_id AS store_code FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
        ORDER BY product_id, seller_id, price, freight_value, shipping_limit_date) AS rn
        FROM raw_order_items) WHERE rn = 1),
    placed AS (SELECT * FROM items WHERE order_code IN (SELECT order_code FROM source_orders)),
    made AS (SELECT * FROM placed WHERE product_code IN (SELECT product_code FROM source_products)),
    paid AS (SELECT order_id AS order_code FROM raw_payments)
    {_missed('order_code', 'items', 'source_orders', 'order_code')} UNION ALL
    {_missed('product_code', 'placed', 'source_products', 'product_code')} UNION ALL
    {_missed('store_code', 'made', 'source_stores', 'store_code')} UNION ALL
    {_missed('order_code', 'paid', 'source_orders', 'order_code')})""")
def unresolved_source_keys(t: Tables):
    """What the lookups of items and payments did not find, each with five of its keys."""
    _, items = source_tables.order_items(
        t.raw_order_items, t.source_orders[0], t.source_products, t.source_stores, RUN_AT)
    _, paid = source_tables.payments(t.raw_payments, t.source_orders[0], RUN_AT)
    shown = F.nullif(F.concat_ws(", ", "sample_keys"), F.lit(""))
    return reduce(DataFrame.unionByName, [*items, paid]).withColumn("sample_keys", shown)


@query("SELECT * FROM dim_date")
def dim_date(t: Tables):
    return t.dim_date


@query("SELECT * FROM dim_customer")
def dim_customer(t: Tables):
    return t.dim_customer


@query("SELECT * FROM dim_product")
def dim_product(t: Tables):
    return t.dim_product


@query("SELECT * FROM dim_store")
def dim_store(t: Tables):
    return t.dim_store


@query("SELECT * FROM dim_currency")
def dim_currency(t: Tables):
    return t.dim_currency


@query("""SELECT zip_code_prefix, median(latitude) AS latitude, median(longitude) AS longitude
    FROM geolocation GROUP BY zip_code_prefix""")
def dim_geolocation(t: Tables):
    return dimensions.dim_geolocation(t.geolocation)


@query("""SELECT c.*, latitude, longitude FROM dim_customer c LEFT JOIN (
    SELECT zip_code_prefix, median(latitude) AS latitude, median(longitude) AS longitude
    FROM geolocation GROUP BY zip_code_prefix) g USING (zip_code_prefix)""")
def dim_customer_located(t: Tables):
    return dimensions.with_coordinates(t.dim_customer, dimensions.dim_geolocation(t.geolocation))


@query("SELECT * FROM currency_codes")
def currency_codes(t: Tables):
    return dimensions.currency_codes(t.silver_orders, t.silver_fx)


# Facts.


@query("SELECT * FROM fact_sales")
def fact_sales(t: Tables):
    return t.fact_sales


@query("SELECT * FROM fact_weather")
def fact_weather_daily(t: Tables):
    return t.fact_weather


@query("SELECT * FROM fact_fx")
def fact_fx_rates(t: Tables):
    return t.fact_fx


@query("SELECT * FROM fact_payments")
def fact_payments(t: Tables):
    return t.fact_payments


@query("""SELECT payment_type, count(*) AS payments FROM silver_payments
    WHERE order_id NOT IN (SELECT order_id FROM silver_orders) GROUP BY payment_type""")
def payments_without_order(t: Tables):
    left_out = facts.payments_without_order(t.silver_payments, t.silver_orders)
    return left_out.groupBy("payment_type").agg(F.count(F.lit(1)).alias("payments"))


_REVIEWS = """SELECT row_number() OVER (ORDER BY review_id, order_id) AS review_key, review_id,
    order_id, review_score, length(review_comment_message) AS comment_length FROM reviews"""


@query(f"""SELECT review_key, review_id, order_id, CAST(review_score AS INTEGER) AS review_score,
    CAST(comment_length AS INTEGER) AS comment_length FROM ({_REVIEWS})""")
def fact_reviews(t: Tables):
    return facts.fact_reviews(t.reviews)


# Marts.

_ENRICHED = """SELECT order_item_id, order_id, order_code, line_number, f.date_key, year, quarter,
    month, day_of_week, is_weekend, is_month_end, c.city AS customer_city,
    c.state AS customer_state, category_name_en AS category_english, weight_g,
    s.state AS seller_state, unit_price, freight_value, quantity, delivery_days_actual,
    delivery_days_estimated, order_status
    FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key
    LEFT JOIN dim_customer c ON f.customer_key = c.customer_key
    LEFT JOIN dim_product p ON f.product_key = p.product_key
    LEFT JOIN dim_store s ON f.store_key = s.store_key"""

_WITH_WEATHER = """SELECT order_item_id, order_code, f.date_key, f.customer_key, unit_price,
    freight_value, delivery_days_actual, delivery_days_estimated,
    delivery_days_actual <= delivery_days_estimated AS is_on_time, order_status,
    c.city AS customer_city, c.normalized_city AS customer_city_normalized,
    c.state AS customer_state, temp_max, temp_min, precipitation, windspeed, weathercode
    FROM fact_sales f LEFT JOIN dim_customer c ON f.customer_key = c.customer_key
    LEFT JOIN fact_weather w ON w.date_key = f.date_key AND w.city = c.normalized_city
        AND w.state = c.state"""

_USD = """SELECT order_item_id, order_code, f.date_key, unit_price AS unit_price_brl,
    freight_value AS freight_value_brl, rate AS usd_to_brl_rate,
    CAST(round(unit_price / rate, 4) AS DECIMAL(18,4)) AS unit_price_usd,
    CAST(round(freight_value / rate, 4) AS DECIMAL(18,4)) AS freight_value_usd
    FROM fact_sales f LEFT JOIN fact_fx x ON x.date_key = f.date_key
        AND x.base_currency = 'USD' AND x.quote_currency = 'BRL'"""


@query(_ENRICHED)
def sales_enriched(t: Tables):
    return marts.sales_enriched(t.fact_sales, t.dim_date, t.dim_customer, t.dim_product, t.dim_store)


@query(_WITH_WEATHER)
def sales_with_weather(t: Tables):
    return marts.sales_with_weather(t.fact_sales, t.dim_customer, t.fact_weather)


@query(_USD)
def sales_usd(t: Tables):
    return marts.sales_usd(t.fact_sales, t.fact_fx)


# Detail listings in their documented order; each is the whole listing.


@query("""SELECT order_code, line_number, store_id, s.state AS seller_state, category_name_en AS category, unit_price,
    freight_value, delivery_days_actual, order_status FROM fact_sales f
    LEFT JOIN dim_store s ON f.store_key = s.store_key LEFT JOIN dim_product p ON f.product_key = p.product_key
    WHERE date_key BETWEEN 19970101 AND 19971231""")
def seller_listing(t: Tables):
    """Lines of a year with their seller: by status, then the longest deliveries first."""
    stores = t.dim_store.select("store_key", "store_id", F.col("state").alias("seller_state"))
    products = t.dim_product.select("product_key", F.col("category_name_en").alias("category"))
    lines = t.fact_sales.where(F.col("date_key").between(19970101, 19971231))
    for table, key in ((stores, "store_key"), (products, "product_key")):
        lines = lookups.lookup(lines, table, {key: key}, marts.ROW)
    return analysis.listing(lines.select(
        "order_code", "line_number", "store_id", "seller_state", "category", "unit_price", "freight_value",
        "delivery_days_actual", "order_status"),
        [F.desc("order_status"), F.desc_nulls_last("delivery_days_actual")], ["order_code", "line_number"])


@query(f"""SELECT date_key, unit_price_brl, usd_to_brl_rate, order_code FROM ({_USD})
    WHERE date_key BETWEEN 19970301 AND 19970331""")
def rate_listing(t: Tables):
    """Prices of a month with the rate of their day, by day."""
    lines = t.fact_sales.where(F.col("date_key").between(19970301, 19970331))
    return analysis.listing(marts.sales_usd(lines, t.fact_fx).select(
        "date_key", "unit_price_brl", "usd_to_brl_rate", "order_code"), [F.asc("date_key")], ["order_code", "unit_price_brl"])


@query(f"""SELECT date_key, order_code, customer_city, customer_state, precipitation FROM ({_WITH_WEATHER})
    WHERE customer_state = 'AM'""")
def weather_listing(t: Tables):
    """Lines of a state with the rain of their day, the most rain first."""
    customers = t.dim_customer.where("state = 'AM'")
    lines = marts.sales_with_weather(t.fact_sales, customers, t.fact_weather).where("customer_state = 'AM'")
    return analysis.listing(lines.select(
        "date_key", "order_code", "customer_city", "customer_state", "precipitation"),
        [F.desc_nulls_last("precipitation")], ["date_key", "order_code", "customer_city"])


@query("""SELECT order_code, line_number, strptime(CAST(f.date_key AS VARCHAR), '%Y%m%d')::DATE
        AS order_purchase_date,
    coalesce(c.city, '—') AS customer_city, coalesce(c.state, '—') AS customer_state,
    coalesce(category_name_en, '—') AS category_english, unit_price, freight_value, quantity,
    delivery_days_actual, delivery_days_estimated,
    CASE WHEN delivery_days_actual > delivery_days_estimated
         THEN 'LATE: ' || delivery_days_actual || ' days'
         ELSE coalesce(CAST(delivery_days_actual AS VARCHAR), '—') END AS delivery_label,
    order_status,
    CASE WHEN precipitation > 10 THEN precipitation || ' (High)'
         ELSE coalesce(CAST(precipitation AS VARCHAR), '—') END AS precipitation_label,
    coalesce(CAST(b.rate AS VARCHAR), '—') AS eur_brl_label,
    coalesce(CAST(u.rate AS VARCHAR), '—') AS eur_usd_label
    FROM fact_sales f LEFT JOIN dim_customer c ON f.customer_key = c.customer_key
    LEFT JOIN dim_product p ON f.product_key = p.product_key
    LEFT JOIN fact_weather w ON w.date_key = f.date_key AND w.city = c.normalized_city
        AND w.state = c.state
    LEFT JOIN fact_fx b ON b.date_key = f.date_key AND b.base_currency = 'EUR'
        AND b.quote_currency = 'BRL'
    LEFT JOIN fact_fx u ON u.date_key = f.date_key AND u.base_currency = 'EUR'
        AND u.quote_currency = 'USD'""")
def source_detail(t: Tables):
    return marts.source_detail(
        t.fact_sales, t.dim_customer, t.dim_product, t.fact_weather, t.fact_fx
    )


@query(f"""SELECT CAST(date_key // 10000 AS INTEGER) AS year,
    CAST(date_key // 100 % 100 AS INTEGER) AS month, state,
    {mean('temp_max')} AS avg_temp_max, {mean('temp_min')} AS avg_temp_min,
    max(windspeed) AS max_windspeed,
    CAST(sum(precipitation) AS DECIMAL(28,1)) AS total_precipitation
    FROM fact_weather GROUP BY ALL""")
def weather_by_month(t: Tables):
    return marts.weather_by_month(t.fact_weather)


# Joins, referential integrity, row-level visibility.


@query("""SELECT order_item_id, i.order_id, order_code, order_date FROM src_items i
    JOIN silver_orders o ON i.order_id = o.order_id""")
def items_with_orders(t: Tables):
    header = t.silver_orders.select("order_id", "order_code", "order_date")
    return skew.join(
        t.order_items.select("order_item_id", "order_id"), header, ["order_id"], t.hot_orders, ["order_item_id"]
    ).select("order_item_id", "order_id", "order_code", "order_date")


@query(f"""SELECT order_item_id, order_id, customer_id FROM checked_items i
    JOIN (SELECT order_id AS oid, customer_id FROM src_orders) o ON i.order_id = oid
    WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM src_customers
        WHERE is_active)""")
def orphan_customers(t: Tables):
    """Items whose order has no active customer; a missing customer is an orphan too."""
    linked = t.order_items.join(t.orders.select("order_id", "customer_id"), "order_id").select(
        "order_item_id", "order_id", "customer_id"
    )
    return lookups.orphans(linked, t.customers.where("is_active"), "customer_id", "customer_id")


def _orphan_count(view: str, fk: str, dim: str, pk: str, label: str) -> str:
    return (
        f"SELECT '{label}' AS relation, count(*) AS orphan_count FROM {view}"
        f" WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {dim} WHERE {pk} IS NOT NULL)"
    )


@query(" UNION ALL ".join([
    _orphan_count("src_orders", "customer_id", "src_customers", "customer_id", "orders -> customers"),
    _orphan_count("src_items", "order_id", "silver_orders", "order_id", "order_items -> orders"),
    _orphan_count("src_payments", "order_id", "silver_orders", "order_id", "payments -> orders"),
]))
def foreign_key_counts(t: Tables):
    parts = [
        lookups.count_orphans(fact, dim, fk, pk, nulls_count=False).select(
            F.lit(label).alias("relation"), F.col("orphan_count")
        )
        for fact, dim, fk, pk, label in (
            (t.orders, t.customers, "customer_id", "customer_id", "orders -> customers"),
            (t.order_items, t.silver_orders, "order_id", "order_id", "order_items -> orders"),
            (t.payments, t.silver_orders, "order_id", "order_id", "payments -> orders"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT 'with nulls' AS rule, count(*) AS orphan_count FROM src_orders
    WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM src_customers WHERE is_active)
    UNION ALL SELECT 'without nulls', count(*) FROM src_orders
    WHERE customer_id NOT IN (SELECT customer_id FROM src_customers WHERE is_active)""")
def orphan_rules(t: Tables):
    """The Gold rule counts a NULL key as an orphan, the warehouse rule does not."""
    active = t.customers.where("is_active")
    strict, lenient = (
        lookups.count_orphans(t.orders, active, "customer_id", "customer_id", nulls)
        for nulls in (True, False)
    )
    return strict.select(F.lit("with nulls").alias("rule"), "orphan_count").unionByName(
        lenient.select(F.lit("without nulls").alias("rule"), "orphan_count")
    )


@query("""SELECT 'known' AS kind, count(*) AS payments FROM src_payments
    WHERE order_id IN (SELECT order_id FROM silver_orders) UNION ALL
    SELECT 'unknown', count(*) FROM src_payments
    WHERE order_id NOT IN (SELECT order_id FROM silver_orders)""")
def known_and_unknown_payments(t: Tables):
    hot, row = skew.hot_keys(t.payments, ["order_id"]), ["order_id", "payment_sequential"]
    known = lookups.only_known(t.payments, t.silver_orders, "order_id", hot, row)
    unknown = lookups.only_unknown(t.payments, t.silver_orders, "order_id", hot, row)
    parts = [
        df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("payments"))
        for kind, df in (("known", known), ("unknown", unknown))
    ]
    return parts[0].unionByName(parts[1])


@query("""SELECT * FROM (WITH grants AS (SELECT lower(c_mktsegment) || '@example.com' AS user_email, state
        FROM customer JOIN places ON c_nationkey = n_nationkey WHERE c_acctbal > 9500)
    SELECT store_id, store_code, state FROM src_stores WHERE state IN
        (SELECT state FROM grants WHERE user_email = 'building@example.com'))""")
def visible_stores(t: Tables):
    """Row-level visibility: the states granted to one user."""
    grants = (
        t.raw("customer")
        .where("c_acctbal > 9500")
        .join(t.places(), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.concat(F.lower("c_mktsegment"), F.lit("@example.com")).alias("user_email"), "state")
    )
    seen = lookups.visible_to(t.stores, grants, F.lit("building@example.com"), "state")
    return seen.select("store_id", "store_code", "state")


@query(f"""SELECT c.city, s.date_key, CAST(sum(revenue) AS {MONEY}) AS revenue,
    max(precipitation) AS max_precipitation FROM (
        SELECT customer_id, date_key, sum(unit_price * quantity) AS revenue
        FROM sales GROUP BY ALL) s
    JOIN dim_customer c ON s.customer_id = c.customer_id
    LEFT JOIN fact_weather w ON w.date_key = s.date_key AND w.city = c.normalized_city
        AND w.state = c.state
    GROUP BY ALL""")
def city_day_weather(t: Tables):
    """Per-row weather lookup done as one composite-key join after reducing sales to city and day."""
    places = t.dim_customer.select("customer_id", "city", "normalized_city", "state")
    per_customer = t.sales.groupBy("customer_id", "date_key").agg(
        F.sum("revenue").alias("revenue")
    )
    per_city = per_customer.join(places, "customer_id").groupBy(
        "city", "normalized_city", "state", "date_key"
    ).agg(money_sum(F.col("revenue")).alias("revenue"))
    weather = t.fact_weather.select(
        "date_key", F.col("city").alias("normalized_city"), "state", "precipitation"
    )
    return (
        per_city.join(weather, ["date_key", "normalized_city", "state"], "left")
        .groupBy("city", "date_key")
        .agg(
            F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
            F.max("precipitation").alias("max_precipitation"),
        )
    )


# Deduplication, keys, unions.


@query("""SELECT order_id, line_number, product_id FROM (SELECT l_orderkey AS order_id,
    l_linenumber AS line_number, l_partkey AS product_id, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
        l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
def latest_lines(t: Tables):
    """The last shipped line of every order and line number."""
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    last = dedup.keep_last(t.raw("lineitem"), ["l_orderkey", "l_linenumber"], order)
    return last.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
    )


@query("""SELECT row_number() OVER (ORDER BY order_date, order_id) + 999 AS order_key, order_id,
    order_date FROM silver_orders""")
def order_keys(t: Tables):
    """Dense keys in date order from a chosen start."""
    orders = t.silver_orders.select("order_id", "order_date")
    order = [F.col("order_date"), F.col("order_id")]
    return keys.assign_surrogate_keys(orders, "order_key", order, 1000)


_REJECTED_BY = {
    "checked_orders": ("orders", ["order_id"]),
    "checked_items": ("order_items", ["order_item_id"]),
    "checked_weather": ("weather", ["date", "city", "state"]),
    "checked_fx": ("fx", ["date", "base_currency", "quote_currency"]),
    "checked_payments": ("payments", ["order_id", "payment_sequential"]),
}


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS transform_name, concat_ws('|', {', '.join(ids)}) AS row_id, quarantine_reason"
    f" FROM {view} WHERE quarantine_reason IS NOT NULL"
    for view, (name, ids) in _REJECTED_BY.items()
))
def all_rejections(t: Tables):
    """Rejected rows of all transforms under each other."""
    parts = [
        getattr(t, view).where("quarantine_reason is not null").select(
            F.lit(name).alias("transform_name"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in ids]).alias("row_id"),
            "quarantine_reason",
        )
        for view, (name, ids) in _REJECTED_BY.items()
    ]
    return reduce(DataFrame.unionByName, parts)
