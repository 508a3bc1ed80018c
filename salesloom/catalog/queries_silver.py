"""Cleaning, contracts, quarantine, expressions and profiles."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from salesloom.catalog.registry import query
from salesloom.catalog.sql import RUN
from salesloom.catalog.tables import END, RUN_AT, Tables
from salesloom.functions import dates, numbers, text
from salesloom.operators import cleaning, contracts, profiling
from salesloom.plans import source_tables


@query("SELECT order_id, order_code, customer_id, order_status, order_date, order_timestamp,"
       " approved_at, estimated_delivery, actual_delivery, delivery_days_actual,"
       " delivery_days_estimated, source_channel, currency_code, ingested_at, quarantine_reason"
       " FROM checked_orders")
def orders_cleaned(t: Tables):
    return t.checked_orders


@query("SELECT * FROM checked_items")
def order_items_cleaned(t: Tables):
    return t.checked_items


@query("SELECT * FROM checked_weather")
def weather_cleaned(t: Tables):
    return t.checked_weather


@query("SELECT * FROM checked_fx")
def fx_cleaned(t: Tables):
    return t.checked_fx


@query("SELECT * FROM checked_payments")
def payments_cleaned(t: Tables):
    return t.checked_payments


@query("SELECT * FROM silver_orders")
def orders_valid(t: Tables):
    return t.silver_orders


@query("SELECT * FROM checked_weather WHERE quarantine_reason IS NOT NULL")
def weather_rejected(t: Tables):
    return contracts.rejected(t.checked_weather)


# Contracts alone, over the rows before the ordered rules.


def _contract_sql(view: str, key: str, *reasons: str) -> str:
    return f"SELECT {key}, nullif(concat_ws(' | ', {', '.join(reasons)}), '') AS quarantine_reason FROM {view}"


@query(_contract_sql(
    "orders_with_days", "order_id",
    "CASE WHEN customer_id IS NULL THEN 'customer_id[not_nullable]=None' END",
    "CASE WHEN order_status IN ('lost', 'canceled') THEN 'order_status[isin]=''' || order_status || '''' END",
    "CASE WHEN order_date IS NULL THEN 'order_date[not_nullable]=None' END",
    "CASE WHEN order_status IS NOT NULL AND approved_at IS NULL"
    " THEN 'approved_at[coerce_dtype(''timestamp_ntz'')]=''n/a''' END",
    "CASE WHEN delivery_days_actual < 0"
    " THEN 'delivery_days_actual[greater_than_or_equal_to(0)]=' || delivery_days_actual END",
))
def orders_contract(t: Tables):
    return contracts.annotate(t.orders, contracts.ORDERS).select("order_id", contracts.REASON)


@query(_contract_sql(
    "src_items", "order_item_id",
    "CASE WHEN unit_price IS NULL THEN 'unit_price[not_nullable]=None' END",
    "CASE WHEN freight_value IS NULL THEN 'freight_value[not_nullable]=None' END",
    "CASE WHEN quantity IS NULL THEN 'quantity[not_nullable]=None' END",
))
def order_items_contract(t: Tables):
    checked = contracts.annotate(t.order_items, contracts.ORDER_ITEMS)
    return checked.select("order_item_id", contracts.REASON)


@query(_contract_sql(
    "src_payments", "order_id",
    "CASE WHEN payment_type = 'not_defined' THEN 'payment_type[isin]=''not_defined''' END",
    "CASE WHEN payment_value = 'unknown'"
    " THEN 'payment_value[coerce_dtype(''decimal(12,2)'')]=''unknown''' END",
))
def payments_contract(t: Tables):
    return contracts.annotate(t.payments, contracts.PAYMENTS).select("order_id", contracts.REASON)


@query(_contract_sql(
    "src_fx", "event_id",
    "CASE WHEN base_currency IS NULL THEN 'base_currency[not_nullable]=None' END",
    "CASE WHEN rate IS NULL THEN 'rate[not_nullable]=None' END",
    "CASE WHEN rate <= 0 THEN 'rate[greater_than(0)]=' || rate END",
))
def fx_contract(t: Tables):
    return contracts.annotate(t.fx, contracts.FX).select("event_id", contracts.REASON)


@query(_contract_sql(
    "typed_weather", "city, date",
    "CASE WHEN state IS NULL THEN 'state[not_nullable]=None' END",
    "CASE WHEN temp_max > 60 THEN 'temp_max[less_than_or_equal_to(60)]=' || temp_max END",
    "CASE WHEN temp_min > 60 THEN 'temp_min[less_than_or_equal_to(60)]=' || temp_min END",
    "CASE WHEN weathercode > 99 THEN 'weathercode[less_than_or_equal_to(99)]=' || weathercode END",
))
def weather_contract(t: Tables):
    lower = t.weather.withColumn("city", text.lower_trim(F.col("city")))
    return contracts.annotate(lower, contracts.WEATHER).select("city", "date", contracts.REASON)


# Summaries of all transforms.

TRANSFORMS = [
    ("checked_orders", "orders"), ("checked_items", "order_items"), ("checked_weather", "weather"),
    ("checked_fx", "fx"), ("checked_payments", "payments"),
]

def _summary_sql(view: str, name: str) -> str:
    rejected = "count(*) FILTER (quarantine_reason IS NOT NULL)"
    pct = f"{rejected} * 100.0 / count(*)"
    return f"""SELECT '{name}' AS transform_name, count(*) AS rows_in,
        count(*) FILTER (quarantine_reason IS NULL) AS rows_kept, {rejected} AS rows_quarantined,
        CAST(round(CAST({pct} AS DOUBLE), 6) AS DECIMAL(9,6)) AS drop_pct,
        CASE WHEN {pct} >= 10 THEN 'WARNING' ELSE 'INFO' END AS level FROM {view}"""


@query(" UNION ALL ".join(
    _summary_sql(v, n)
    for v, n in TRANSFORMS
))
def transform_summaries(t: Tables):
    return reduce(DataFrame.unionByName, [cleaning.summarize(getattr(t, v), n) for v, n in TRANSFORMS])


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS transform_name, quarantine_reason, count(*) AS row_count FROM {v}"
    " WHERE quarantine_reason IS NOT NULL GROUP BY quarantine_reason"
    for v, n in TRANSFORMS
))
def quarantine_reasons(t: Tables):
    return reduce(DataFrame.unionByName, [cleaning.reasons(getattr(t, v), n) for v, n in TRANSFORMS])


# Scalar expressions over whole tables.


@query(f"""SELECT order_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
    order_date AS date_from_key, delivery_days_actual, delivery_days_estimated,
    delivery_days_actual <= delivery_days_estimated AS is_on_time,
    approved_at AS approved_at_parsed,
    CAST(approved_at AS DATE) AS parsed_date,
    coalesce(order_status NOT IN ('delivered', 'shipped'), true) AS not_in_set,
    customer_id IS NULL OR order_date IS NULL AS lacks_key,
    CASE WHEN delivery_days_actual > delivery_days_estimated
         THEN 'LATE: ' || delivery_days_actual || ' days'
         ELSE coalesce(CAST(delivery_days_actual AS VARCHAR), '—') END AS delivery_label
    FROM orders_with_days""")
def order_expressions(t: Tables):
    actual, estimated = F.col("delivery_days_actual"), F.col("delivery_days_estimated")
    key = dates.date_key(F.col("order_date"))
    return t.orders.select(
        "order_id",
        key.alias("date_key"),
        dates.key_to_date(key).alias("date_from_key"),
        actual,
        estimated,
        dates.is_on_time(actual, estimated).alias("is_on_time"),
        dates.parse_timestamp(F.col("approved_at")).alias("approved_at_parsed"),
        dates.parse_date(F.col("approved_at")).alias("parsed_date"),
        numbers.is_false_or_null(F.col("order_status").isin("delivered", "shipped")).alias("not_in_set"),
        (F.col("customer_id").isNull() | F.col("order_date").isNull()).alias("lacks_key"),
        text.late_label(actual, estimated).alias("delivery_label"),
    )


@query("""SELECT order_item_id, coalesce(freight_value, 0) AS freight_value,
    coalesce(quantity, 1) AS quantity,
    CAST(unit_price * coalesce(quantity, 1) AS DECIMAL(24,2)) AS line_revenue FROM src_items""")
def item_defaults(t: Tables):
    quantity = F.coalesce("quantity", F.lit(1))
    return t.order_items.select(
        "order_item_id",
        F.coalesce("freight_value", F.lit(0).cast("decimal(12,2)")).alias("freight_value"),
        quantity.alias("quantity"),
        numbers.line_revenue(F.col("unit_price"), quantity).cast("decimal(24,2)").alias("line_revenue"),
    )


@query("""SELECT order_id, TRY_CAST(payment_value AS DECIMAL(12,2)) AS payment_value,
    TRY_CAST(payment_installments AS BIGINT) AS payment_installments FROM src_payments""")
def number_parsing(t: Tables):
    return t.payments.select(
        "order_id",
        numbers.parse_number(F.col("payment_value"), "decimal(12,2)").alias("payment_value"),
        numbers.parse_number(F.col("payment_installments"), "bigint").alias("payment_installments"),
    )


@query("""SELECT city, date, CAST(weathercode AS BIGINT) AS weathercode,
    CASE WHEN weathercode IS NULL THEN NULL WHEN weathercode BETWEEN 0 AND 1 THEN 'clear'
         WHEN weathercode BETWEEN 2 AND 3 THEN 'cloudy'
         WHEN weathercode BETWEEN 51 AND 67 OR weathercode BETWEEN 80 AND 82 THEN 'rainy'
         WHEN weathercode BETWEEN 95 AND 99 THEN 'stormy' ELSE 'other' END AS weather_category,
    lower(trim(city)) AS city_lower,
    CASE WHEN precipitation > 10 THEN CAST(precipitation AS DECIMAL(7,1)) || ' (High)'
         ELSE coalesce(CAST(CAST(precipitation AS DECIMAL(7,1)) AS VARCHAR), '—') END AS rain_label
    FROM src_weather""")
def weather_expressions(t: Tables):
    code = numbers.whole_or_null(F.col("weathercode"))
    return t.weather.select(
        "city",
        "date",
        code.alias("weathercode"),
        text.weather_category(code).alias("weather_category"),
        text.lower_trim(F.col("city")).alias("city_lower"),
        text.rain_label(F.col("precipitation").cast("decimal(7,1)")).alias("rain_label"),
    )


_TRIMMED = " || ".join(f"chr({ord(c)})" for c in map(chr, range(0x110000)) if c.isspace())


@query(f"""SELECT doc_id, md5(trim(lower(strip_accents(coalesce(text, ''))), {_TRIMMED})) AS text_key
    FROM documents""")
def name_normalization(t: Tables):
    """The city normalizer over accented text: whole documents, shown as a digest."""
    return t.raw("documents").select(
        "doc_id", F.md5(text.normalize_city(F.col("text"))).alias("text_key")
    )


@query(f"""SELECT doc_id, trim(lower(strip_accents(chr(12288) || 'Épéegaが ' || doc_id || chr(8195))), {_TRIMMED})
    AS city_key FROM documents""")
def wide_name_normalization(t: Tables):
    """Names with wide spaces around them and accented letters beyond the Latin ones."""
    name = F.concat(F.lit("\u3000Épéega\u304c "), F.col("doc_id").cast("string"), F.lit("\u2003"))
    return t.raw("documents").select("doc_id", text.normalize_city(name).alias("city_key"))


@query("SELECT store_id, state, region FROM src_stores")
def macro_regions(t: Tables):
    return t.stores.select("store_id", "state", text.macro_region(F.col("state")).alias("region"))


@query("SELECT DISTINCT state FROM src_stores WHERE region = 'Desconhecido'")
def unmapped_states(t: Tables):
    return source_tables.unmapped_states(t.stores)


@query("""SELECT product_id,
    coalesce(category_name_en, CASE WHEN weight_g <> '100' THEN category_name_pt END, 'unknown')
    AS category FROM src_products""")
def category_fallback(t: Tables):
    portuguese = F.when(F.col("weight_g") != "100", F.col("category_name_pt"))
    category = text.category_fallback(F.col("category_name_en"), portuguese)
    return t.products.select("product_id", category.alias("category"))


@query("""SELECT base_currency || '/' || quote_currency AS pair, count(*) AS quotes
    FROM src_fx WHERE base_currency IS NOT NULL GROUP BY 1""")
def currency_pairs(t: Tables):
    pair = text.pair_label(F.col("base_currency"), F.col("quote_currency"))
    known = t.fx.where("base_currency is not null")
    return known.groupBy(pair.alias("pair")).agg(F.count(F.lit(1)).alias("quotes"))


@query(f"""SELECT c_custkey AS customer_id, c_name AS customer_code, c_mktsegment AS segment,
    true AS is_active, {RUN} AS created_at, {RUN} AS ingested_at,
    'online' AS source_channel, 'BRL' AS currency_code FROM customer""")
def canonical_columns(t: Tables):
    """Renaming to canonical columns, audit columns and constants."""
    stamp = F.lit(RUN_AT).cast("timestamp_ntz")
    named = t.raw("customer").withColumnsRenamed(
        {"c_custkey": "customer_id", "c_name": "customer_code", "c_mktsegment": "segment"}
    )
    return named.select(
        "customer_id", "customer_code", "segment", F.lit(True).alias("is_active"),
        stamp.alias("created_at"), stamp.alias("ingested_at"),
        F.lit("online").alias("source_channel"), F.lit("BRL").alias("currency_code"),
    )


@query("""SELECT event_id, '{"user":' || user_id || ',"kind":"' || event_type || '"}' AS metadata
    FROM events""")
def metadata_json(t: Tables):
    return t.raw("events").select(
        "event_id", text.json_text(user=F.col("user_id"), kind=F.col("event_type")).alias("metadata")
    )


@query("""SELECT c_custkey AS customer_id, coalesce(customer_code, 'Unknown') AS customer_code,
    customer_code IS NOT NULL AS has_code
    FROM customer JOIN src_customers ON c_custkey = customer_id""")
def unknown_members(t: Tables):
    return t.customers.select(
        "customer_id",
        text.unknown_member(F.col("customer_code")).alias("customer_code"),
        F.col("customer_code").isNotNull().alias("has_code"),
    )


# Profiles.

_PROFILED = {
    "o_orderkey": True, "o_custkey": True, "o_orderstatus": False, "o_totalprice": True,
    "o_orderdate": False, "o_orderpriority": False,
}


def _metric(column: str | None, metric: str, value: str) -> str:
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT 'orders' AS table_name, {name} AS column_name, '{metric}' AS metric,"
        f" CAST({value} AS DOUBLE) AS value FROM orders"
    )


@query(" UNION ALL ".join(
    [_metric(None, "row_count", "count(*)"), _metric(None, "col_count", str(len(_PROFILED)))[: -len(" FROM orders")]]
    + [_metric(c, "null_pct", f"round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 2)") for c in _PROFILED]
    + [_metric(c, m, f"{m}({c})") for c, numeric in _PROFILED.items() if numeric for m in ("min", "max")]
    + [_metric(None, "duplicate_rows", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders))")]
))
def table_profile(t: Tables):
    return profiling.profile(t.raw("orders"), "orders")


@query("""SELECT 'Missing columns: [''order_total'']' AS issue UNION ALL
    SELECT 'Column ''order_date'': expected dtype category ''int'', got ''date''' UNION ALL
    SELECT format('Column ''actual_delivery'': null rate {:.1f}% exceeds threshold 50.0%', rate)
    FROM (SELECT avg(CASE WHEN actual_delivery IS NULL THEN 1 ELSE 0 END) * 100 AS rate
          FROM src_orders) WHERE rate > 50""")
def schema_issues(t: Tables):
    expected = {
        "order_id": "int", "order_total": "float", "order_date": "int", "actual_delivery": "datetime",
        "order_status": "object",
    }
    return profiling.schema_issues(t.orders, expected)
