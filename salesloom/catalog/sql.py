"""The views of `tables.py` in SQL, and a helper that puts those a query uses in front of it."""

from __future__ import annotations

import re

from salesloom.catalog.tables import END, RUN_AT, SPREAD_DAYS, START
from salesloom.functions.fixed import CURRENCY_NAMES, MACRO_REGION_STATES, ORDER_STATUSES, PAYMENT_TYPES


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


REGION_CASE = (
    "CASE "
    + " ".join(
        f"WHEN upper(state) IN ({_quoted(states)}) THEN '{region}'"
        for region, states in MACRO_REGION_STATES.items()
    )
    + " ELSE 'Desconhecido' END"
)
CURRENCY_CASE = (
    "CASE currency_code "
    + " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in CURRENCY_NAMES.items())
    + " ELSE currency_code END"
)
RUN = f"TIMESTAMP '{RUN_AT}'"
RANGE = f"DATE '{START}' AND DATE '{END}'"
MONEY = "DECIMAL(28,2)"


def ratio(numerator: str, denominator: str, otherwise: str | None = None) -> str:
    """Quotient with six decimals, as `functions.numbers.ratio`."""
    value = (
        f"CAST(round(CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0), 6)"
        " AS DECIMAL(18,6))"
    )
    return value if otherwise is None else f"coalesce({value}, CAST({otherwise} AS DECIMAL(18,6)))"


def mean(value: str) -> str:
    return ratio(f"sum({value})", f"count({value})")


def day_key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


LINE_COLUMNS = f"""
    l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS store_id,
    l_linenumber AS line_number,
    CASE WHEN l_quantity < 50 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS unit_price,
    CASE WHEN l_tax > 0 THEN CAST(round(CAST(l_extendedprice AS DECIMAL(12,2))
        * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) END AS freight_value,
    CASE WHEN l_quantity > 1 THEN CAST(l_quantity AS INTEGER) END AS quantity,
    {RUN} AS ingested_at"""

EVENT_DAY = f"DATE '1995-01-01' + CAST(event_id * 7919 % {SPREAD_DAYS} AS INTEGER)"

VIEWS = {
    "places": """SELECT n_nationkey, n_name, substr(r_name, 1, 2) AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "src_customers": """SELECT c_custkey AS customer_id,
        CASE WHEN c_acctbal >= -900 THEN c_name END AS customer_code,
        lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code_prefix,
        n_name AS city, state, c_acctbal >= 0 AS is_active
        FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "src_stores": f"""SELECT s_suppkey AS store_id, s_name AS store_code,
        lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS zip_code_prefix,
        n_name AS city, state, {REGION_CASE} AS region, s_acctbal >= 0 AS is_active
        FROM supplier JOIN places ON s_nationkey = n_nationkey""",
    "src_products": """SELECT p_partkey AS product_id,
        'PRD-' || p_partkey AS product_code,
        CASE WHEN p_size > 3 THEN p_type || ' ' || p_brand END AS category_name_en,
        p_brand AS category_name_pt, CAST(p_size * 100 AS VARCHAR) AS weight_g,
        p_retailprice > 1000 AS is_active FROM part""",
    "src_orders_dated": """SELECT *, CASE WHEN o_totalprice <= 495000
        THEN CAST(o_orderdate AS DATE) END AS order_date FROM orders""",
    "src_orders": f"""SELECT o_orderkey AS order_id, 'ORD-' || o_orderkey AS order_code,
        CASE WHEN o_totalprice >= 5000 THEN o_custkey END AS customer_id,
        CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
             WHEN o_orderpriority = '1-URGENT' THEN 'lost' ELSE 'canceled' END AS order_status,
        order_date, o_orderdate AS order_timestamp,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS approved_at,
        order_date + CAST(10 + o_custkey % 15 AS INTEGER) AS estimated_delivery,
        CASE WHEN o_orderstatus = 'F'
             THEN order_date + CAST(o_orderkey * 7 % 41 - 1 AS INTEGER) END AS actual_delivery,
        'online' AS source_channel,
        CASE WHEN o_totalprice > 450000 THEN 'USD' ELSE 'BRL' END AS currency_code,
        {RUN} AS ingested_at FROM src_orders_dated""",
    "orders_with_days": """SELECT order_id, order_code, customer_id, order_status, order_date,
        order_timestamp, approved_at, estimated_delivery, actual_delivery,
        date_diff('day', order_date, actual_delivery) AS delivery_days_actual,
        date_diff('day', order_date, estimated_delivery) AS delivery_days_estimated,
        source_channel, currency_code, ingested_at FROM src_orders""",
    "checked_orders": f"""SELECT *, CASE
        WHEN order_status = 'canceled' THEN 'canceled order excluded from Silver'
        WHEN order_date IS NULL THEN 'null order_date'
        WHEN customer_id IS NULL THEN 'null customer_id'
        WHEN order_status NOT IN ({_quoted(ORDER_STATUSES)})
            THEN 'unknown order_status: ' || order_status
        WHEN delivery_days_actual < 0
            THEN 'delivery_days_actual[greater_than_or_equal_to(0)]=' || delivery_days_actual
        END AS quarantine_reason FROM orders_with_days""",
    "silver_orders": """SELECT * EXCLUDE (quarantine_reason) FROM checked_orders
        WHERE quarantine_reason IS NULL""",
    "src_items": f"""SELECT l_orderkey * 100 + l_linenumber AS order_item_id, {LINE_COLUMNS}
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
            l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
            l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",
    "checked_items": """SELECT order_item_id, i.order_id, product_id, store_id,
        CAST(line_number AS BIGINT) AS line_number, unit_price,
        coalesce(freight_value, 0) AS freight_value,
        CAST(coalesce(quantity, 1) AS BIGINT) AS quantity, i.ingested_at,
        CASE WHEN o.order_id IS NULL THEN 'order_id not in Silver orders'
             WHEN unit_price IS NULL THEN 'null unit_price' END AS quarantine_reason
        FROM src_items i LEFT JOIN silver_orders o ON i.order_id = o.order_id""",
    "silver_items": """SELECT * EXCLUDE (quarantine_reason) FROM checked_items
        WHERE quarantine_reason IS NULL""",
    "src_payments": f"""SELECT o_orderkey AS order_id, '1' AS payment_sequential,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
            WHEN '3-MEDIUM' THEN 'voucher' WHEN '5-LOW' THEN 'debit_card'
            ELSE 'not_defined' END AS payment_type,
        CAST(o_custkey % 12 AS VARCHAR) AS payment_installments,
        CASE WHEN o_totalprice < 3000 THEN 'unknown'
             ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS payment_value,
        {RUN} AS ingested_at FROM orders""",
    "checked_payments": f"""SELECT order_id, TRY_CAST(payment_sequential AS BIGINT)
            AS payment_sequential, payment_type,
        TRY_CAST(payment_installments AS BIGINT) AS payment_installments,
        TRY_CAST(payment_value AS DECIMAL(12,2)) AS payment_value, ingested_at,
        CASE WHEN payment_type = 'not_defined'
                THEN 'payment_type=''not_defined'' (missing payment method)'
             WHEN payment_type NOT IN ({_quoted(PAYMENT_TYPES)}) THEN 'unexpected'
             WHEN TRY_CAST(payment_value AS DECIMAL(12,2)) IS NULL
                THEN 'payment_value[not_nullable]=None' END AS quarantine_reason
        FROM src_payments""",
    "silver_payments": """SELECT * EXCLUDE (quarantine_reason) FROM checked_payments
        WHERE quarantine_reason IS NULL""",
    "weather_days": f"""SELECT {EVENT_DAY} AS date, CAST(user_id % 25 AS INTEGER) AS n_nationkey,
        max(value) AS high, min(value) AS low, max(event_id) AS last_event,
        max(CASE WHEN event_type <> 'error' THEN event_id % 104 END) AS code
        FROM events GROUP BY 1, 2""",
    "src_weather": """SELECT n_name AS city, CASE WHEN low < 200 THEN state END AS state, date,
        CAST(round(CAST(high AS DECIMAL(12,2)), 1) AS DOUBLE) - 20 AS temp_max,
        CAST(round(CAST(low AS DECIMAL(12,2)), 1) AS DOUBLE) - 25 AS temp_min,
        CAST(round(CAST(low / 3 AS DECIMAL(12,2)), 1) AS DOUBLE) AS precipitation,
        CAST(last_event % 90 AS DOUBLE) AS windspeed, CAST(code AS DOUBLE) AS weathercode
        FROM weather_days JOIN places USING (n_nationkey)""",
    "typed_weather": """SELECT lower(trim(city)) AS city, state, date,
        CAST(temp_max AS DECIMAL(5,1)) AS temp_max, CAST(temp_min AS DECIMAL(5,1)) AS temp_min,
        CAST(precipitation AS DECIMAL(7,1)) AS precipitation,
        CAST(windspeed AS DECIMAL(6,1)) AS windspeed, CAST(weathercode AS BIGINT) AS weathercode
        FROM src_weather""",
    "checked_weather": f"""SELECT *, CASE
        WHEN date NOT BETWEEN {RANGE} THEN 'date outside pipeline range'
        WHEN city IS NULL OR state IS NULL THEN 'null city or state'
        ELSE nullif(concat_ws(' | ',
            CASE WHEN temp_max < -50 THEN 'temp_max[greater_than_or_equal_to(-50)]=' || temp_max END,
            CASE WHEN temp_max > 60 THEN 'temp_max[less_than_or_equal_to(60)]=' || temp_max END,
            CASE WHEN temp_min < -50 THEN 'temp_min[greater_than_or_equal_to(-50)]=' || temp_min END,
            CASE WHEN temp_min > 60 THEN 'temp_min[less_than_or_equal_to(60)]=' || temp_min END,
            CASE WHEN weathercode > 99
                THEN 'weathercode[less_than_or_equal_to(99)]=' || weathercode END), '')
        END AS quarantine_reason FROM typed_weather""",
    "silver_weather": """SELECT * EXCLUDE (quarantine_reason) FROM checked_weather
        WHERE quarantine_reason IS NULL""",
    "src_fx": f"""SELECT {EVENT_DAY} AS date,
        CASE WHEN event_type = 'purchase' THEN 'USD' WHEN event_type IN ('click', 'view') THEN 'EUR'
             WHEN event_type = 'signup' THEN 'GBP' END AS base_currency,
        CASE WHEN event_type = 'view' THEN 'USD' ELSE 'BRL' END AS quote_currency,
        CAST(CASE WHEN v > 300 THEN NULL WHEN v < 1 THEN 0
             ELSE (v + 100) * CAST(0.01 AS DECIMAL(3,2)) END AS DECIMAL(16,6)) AS rate, event_id
        FROM (SELECT *, CAST(value AS DECIMAL(12,2)) AS v FROM events)""",
    "early_fx": f"""SELECT *, CASE WHEN date NOT BETWEEN {RANGE} THEN 'date outside pipeline range'
        WHEN base_currency IS NULL OR quote_currency IS NULL
            THEN 'null base_currency or quote_currency' END AS reason FROM src_fx""",
    "daily_fx": """SELECT date, base_currency, quote_currency, rate FROM (SELECT *,
        row_number() OVER (PARTITION BY date, base_currency, quote_currency
            ORDER BY event_id DESC) AS rn FROM early_fx WHERE reason IS NULL) WHERE rn = 1""",
    "days": f"""SELECT CAST(range AS DATE) AS date
        FROM range(DATE '{START}', DATE '{END}' + 1, INTERVAL 1 DAY)""",
    "all_days": f"""SELECT CAST(unnest(range(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP)
            + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT CAST(o_orderdate AS DATE) AS date FROM orders UNION ALL SELECT {EVENT_DAY} FROM events)""",
    "month_list": f"""SELECT CAST(range AS DATE) AS month
        FROM range(date_trunc('month', DATE '{START}'), DATE '{END}' + 1, INTERVAL 1 MONTH)""",
    "filled_fx": """SELECT s.date, s.base_currency, s.quote_currency, coalesce(
            last_value(rate IGNORE NULLS) OVER (PARTITION BY s.base_currency, s.quote_currency
                ORDER BY s.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value(rate IGNORE NULLS) OVER (PARTITION BY s.base_currency, s.quote_currency
                ORDER BY s.date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS rate
        FROM (SELECT * FROM days, (SELECT DISTINCT base_currency, quote_currency FROM daily_fx)) s
        LEFT JOIN daily_fx f USING (date, base_currency, quote_currency)""",
    "checked_fx": """SELECT date, base_currency, quote_currency, rate,
        CASE WHEN rate IS NULL THEN 'null exchange rate after ffill'
             WHEN rate <= 0 THEN 'rate[greater_than(0)]=' || rate END AS quarantine_reason
        FROM filled_fx UNION ALL
        SELECT date, base_currency, quote_currency, rate, reason FROM early_fx
        WHERE reason IS NOT NULL""",
    "silver_fx": """SELECT * EXCLUDE (quarantine_reason) FROM checked_fx
        WHERE quarantine_reason IS NULL""",
    "dim_date": f"""SELECT {day_key('date')} AS date_key, date,
        CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
        CAST(month(date) AS INTEGER) AS month, CAST(week(date) AS INTEGER) AS week,
        CAST(day(date) AS INTEGER) AS day_of_month, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
        dayname(date) AS day_name, monthname(date) AS month_name,
        'Q' || quarter(date) AS quarter_name, isodow(date) >= 6 AS is_weekend,
        date = last_day(date) AS is_month_end FROM all_days""",
    "dim_customer": """SELECT row_number() OVER (ORDER BY customer_code) AS customer_key,
        customer_id, customer_code, zip_code_prefix, city, state, is_active,
        lower(strip_accents(coalesce(city, ''))) AS normalized_city FROM src_customers
        WHERE customer_code IS NOT NULL""",
    "dim_product": """SELECT row_number() OVER (ORDER BY product_code) AS product_key, product_id,
        product_code, category_name_en, category_name_pt,
        CAST(weight_g AS DECIMAL(10,2)) AS weight_g, is_active FROM src_products""",
    "dim_store": """SELECT row_number() OVER (ORDER BY store_code) AS store_key, * FROM src_stores""",
    "currency_codes": """SELECT currency_code FROM silver_orders UNION
        SELECT base_currency FROM silver_fx UNION SELECT quote_currency FROM silver_fx""",
    "dim_currency": f"""SELECT row_number() OVER (ORDER BY currency_code) AS currency_key,
        currency_code, {CURRENCY_CASE} AS currency_name FROM currency_codes""",
    "fact_sales": f"""SELECT order_item_id, i.order_id, o.order_code, line_number,
        {day_key('order_date')} AS date_key, customer_key, product_key, store_key, currency_key,
        order_status, source_channel, unit_price, freight_value, quantity,
        delivery_days_actual, delivery_days_estimated
        FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id
        LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
        LEFT JOIN dim_product p ON i.product_id = p.product_id
        LEFT JOIN dim_store s ON i.store_id = s.store_id
        LEFT JOIN dim_currency k ON o.currency_code = k.currency_code""",
    "fact_weather": f"""SELECT {day_key('date')} AS date_key, city, state, temp_max, temp_min,
        precipitation, windspeed, weathercode FROM silver_weather""",
    "fact_fx": f"""SELECT {day_key('date')} AS date_key, b.currency_key AS base_currency_key,
        q.currency_key AS quote_currency_key, base_currency, quote_currency, rate
        FROM silver_fx f LEFT JOIN dim_currency b ON f.base_currency = b.currency_code
        LEFT JOIN dim_currency q ON f.quote_currency = q.currency_code""",
    "fact_payments": f"""SELECT p.order_id, order_code, payment_sequential,
        {day_key('order_date')} AS date_key, customer_key, currency_key, payment_type,
        payment_installments, payment_value
        FROM silver_payments p JOIN silver_orders o ON p.order_id = o.order_id
        LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
        LEFT JOIN dim_currency k ON o.currency_code = k.currency_code""",
    "sales": """SELECT f.*, o.customer_id, o.order_date FROM fact_sales f
        JOIN silver_orders o ON f.order_id = o.order_id""",
    "sales_by_customer": """SELECT s.*, city AS customer_city, state AS customer_state
        FROM sales s JOIN dim_customer c ON s.customer_key = c.customer_key""",
    "sales_by_product": """SELECT s.*, category_name_en AS category
        FROM sales s LEFT JOIN dim_product p ON s.product_key = p.product_key""",
    "sales_by_customer_product": """SELECT s.*, state AS customer_state
        FROM sales_by_product s JOIN dim_customer c ON s.customer_key = c.customer_key""",
    "sales_by_store": """SELECT s.*, store_id, state AS seller_state
        FROM sales s JOIN dim_store t ON s.store_key = t.store_key""",
    "raw_customers": """SELECT 'OC-' || o_orderkey AS customer_id, c_name AS customer_unique_id,
        lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
        n_name AS customer_city, state AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey
        WHERE o_totalprice >= 4000""",
    "raw_sellers": """SELECT s_name AS seller_id,
        lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
        n_name AS seller_city, state AS seller_state
        FROM supplier JOIN places ON s_nationkey = n_nationkey WHERE s_acctbal >= -500""",
    "raw_products": """SELECT 'PRD-' || p_partkey AS product_id,
        CASE WHEN p_size > 3 THEN p_brand END AS product_category_name,
        CASE WHEN p_type <> 'PROMO' THEN p_size * 100 END AS product_weight_g, p_size
        FROM part WHERE p_size >= 2""",
    "raw_translations": """SELECT DISTINCT p_brand AS product_category_name,
        'Group ' || p_brand AS product_category_name_english FROM part
        WHERE p_brand <> 'Brand#13'""",
    "raw_orders": """SELECT order_code AS order_id, 'OC-' || order_id AS customer_id, order_status,
        strftime(order_timestamp, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
        coalesce(strftime(approved_at, '%Y-%m-%d %H:%M:%S'), 'n/a') AS order_approved_at,
        strftime(actual_delivery, '%Y-%m-%d %H:%M:%S') AS order_delivered_customer_date,
        strftime(estimated_delivery, '%Y-%m-%d %H:%M:%S') AS order_estimated_delivery_date
        FROM src_orders""",
    "raw_order_items": """SELECT 'ORD-' || l_orderkey AS order_id, l_linenumber AS order_item_id,
        'PRD-' || l_partkey AS product_id,
        'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS seller_id,
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipping_limit_date,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
        CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
            AS DECIMAL(12,2)) AS freight_value FROM lineitem""",
    "raw_payments": """SELECT 'ORD-' || order_id AS order_id,
        CAST(payment_sequential AS INTEGER) AS payment_sequential, payment_type,
        CAST(payment_installments AS INTEGER) AS payment_installments,
        TRY_CAST(payment_value AS DECIMAL(12,2)) AS payment_value FROM src_payments""",
    "source_customers": f"""SELECT row_number() OVER (ORDER BY customer_unique_id) AS customer_id,
        customer_unique_id AS customer_code, customer_zip_code_prefix AS zip_code_prefix,
        customer_city AS city, customer_state AS state, true AS is_active,
        {RUN} AS created_at, {RUN} AS ingested_at, {RUN} AS updated_at
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id
            ORDER BY customer_id) AS rn FROM raw_customers) WHERE rn = 1""",
    "source_stores": f"""SELECT row_number() OVER (ORDER BY store_code) AS store_id, *,
        {REGION_CASE} AS region, true AS is_active, {RUN} AS created_at, {RUN} AS ingested_at
        FROM (SELECT seller_id AS store_code, seller_zip_code_prefix AS zip_code_prefix,
            seller_city AS city, seller_state AS state FROM raw_sellers)""",
    "source_products": f"""SELECT row_number() OVER (ORDER BY product_id) AS product_id,
        product_id AS product_code, product_category_name AS category_name_pt,
        coalesce(product_category_name_english, product_category_name, 'unknown')
            AS category_name_en,
        CAST(product_weight_g AS DECIMAL(10,2)) AS weight_g,
        CAST(p_size AS DECIMAL(10,2)) AS length_cm, CAST(p_size AS DECIMAL(10,2)) AS height_cm,
        CAST(p_size AS DECIMAL(10,2)) AS width_cm, true AS is_active,
        {RUN} AS created_at, {RUN} AS ingested_at
        FROM raw_products LEFT JOIN raw_translations USING (product_category_name)""",
    "source_orders": f"""SELECT row_number() OVER (ORDER BY o.order_id) AS order_id,
        o.order_id AS order_code, c.customer_id, order_status,
        CAST(order_purchase_timestamp AS DATE) AS order_date,
        CAST(order_purchase_timestamp AS TIMESTAMP) AS order_timestamp,
        TRY_CAST(order_approved_at AS TIMESTAMP) AS approved_at,
        CAST(order_estimated_delivery_date AS DATE) AS estimated_delivery,
        CAST(order_delivered_customer_date AS DATE) AS actual_delivery,
        date_diff('day', CAST(order_purchase_timestamp AS DATE),
            CAST(order_delivered_customer_date AS DATE)) AS delivery_days_actual,
        date_diff('day', CAST(order_purchase_timestamp AS DATE),
            CAST(order_estimated_delivery_date AS DATE)) AS delivery_days_estimated,
        'online' AS source_channel, 'BRL' AS currency_code,
        {RUN} AS created_at, {RUN} AS ingested_at
        FROM raw_orders o JOIN raw_customers r ON o.customer_id = r.customer_id
        JOIN source_customers c ON r.customer_unique_id = c.customer_code""",
    "reviews": """SELECT conv_id AS review_id, turn AS order_id, length(text) % 5 + 1 AS review_score,
        text AS review_comment_message FROM conversations""",
    "geolocation": """SELECT lpad(CAST(user_id % 25 AS VARCHAR), 5, '0') AS zip_code_prefix,
        value / 10 - 30 AS latitude, minute(ts) + second(ts) / 60 - 60 AS longitude FROM events""",
}


def _used(text: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"\b{v}\b", text)]


def with_views(body: str) -> str:
    """The query with every view it uses, directly or not, as a common table expression."""
    needed, open_ = set(), _used(body)
    while open_:
        view = open_.pop()
        if view not in needed:
            needed.add(view)
            open_ += [v for v in _used(VIEWS[view]) if v != view]
    parts = [f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in needed]
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return head + body.strip()
