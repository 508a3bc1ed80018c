"""Readers, writers, landed feeds, loads and manifests. Files go below the cluster's shared folder."""

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from salesloom.catalog.registry import query
from salesloom.catalog.sql import RUN
from salesloom.catalog.tables import END, RUN_AT, START, Tables
from salesloom.functions.dates import date_key
from salesloom.operators import cleaning, contracts
from salesloom.operators.dedup import keep_first
from salesloom.session import scratch_path
from salesloom.sources import feeds, history, lake, manifests, schemas, warehouse
from salesloom.sources.versions import Store
from salesloom.streaming import incremental

DAY = RUN_AT.date()


@query("SELECT * FROM raw_orders")
def csv_scan(t: Tables):
    """Raw orders written as CSV and read under the declared schema."""
    path = scratch_path(t.spark, "csv")
    t.raw_orders.write.csv(path, header=True)
    return lake.read_csv(t.spark, path, schemas.RAW_ORDERS)


_FILES = {
    "customers": ("raw_customers", schemas.RAW_CUSTOMERS), "sellers": ("raw_sellers", schemas.RAW_SELLERS),
    "products": ("raw_products", schemas.RAW_PRODUCTS), "translations": ("raw_translations", schemas.RAW_TRANSLATIONS),
    "orders": ("raw_orders", schemas.RAW_ORDERS), "order_items": ("raw_order_items", schemas.RAW_ORDER_ITEMS),
    "payments": ("raw_payments", schemas.RAW_PAYMENTS), "reviews": ("reviews", schemas.RAW_REVIEWS),
    "geolocation": (None, schemas.RAW_GEOLOCATION),
}


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {view}" if view else f"SELECT '{name}', 0"
    for name, (view, _) in _FILES.items()
))
def csv_snapshots(t: Tables):
    """All landed CSV files snapshotted as Parquet; the one that is absent counts 0."""
    files, lake_path = scratch_path(t.spark, "files"), scratch_path(t.spark, "bronze")
    for name, (attribute, _) in _FILES.items():
        if attribute:
            # Comments hold line breaks, which stay inside their quotes.
            getattr(t, attribute).write.csv(f"{files}/{name}", header=True, escape='"', quoteAll=name == "reviews")
    declared = {name: schema for name, (_, schema) in _FILES.items()}
    return lake.snapshot_csv_files(t.spark, files, declared, lake_path, DAY)


@query("""SELECT customer_id, customer_code, city, state, is_active FROM src_customers
    WHERE is_active""")
def latest_snapshot(t: Tables):
    """Two daily snapshots; the later one is read, and an existing one is not written again."""
    path = scratch_path(t.spark, "snapshots")
    customers = t.customers.select("customer_id", "customer_code", "city", "state", "is_active")
    lake.write_snapshot(customers, path, DAY - timedelta(days=1))
    lake.write_snapshot(customers.where("is_active"), path, DAY)
    lake.write_snapshot(customers, path, DAY)
    return lake.latest_snapshot(t.spark, path)


_SOURCES = {
    "customers": "src_customers", "stores": "src_stores", "products": "src_products", "orders": "src_orders",
    "order_items": "src_items", "payments": "src_payments",
}


@query(" UNION ALL ".join([
    *(f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST(NULL AS VARCHAR) AS error FROM {view}"
      for name, view in _SOURCES.items()),
    "SELECT 'broken', 0, 'unreadable'"]))
def table_snapshots(t: Tables):
    """All source tables snapshotted at once, each on its own: one that cannot be read does not stop the others."""
    path = scratch_path(t.spark, "tables")
    unreadable = t.stores.select(F.raise_error(F.lit("unreadable")).alias("broken"))
    outcomes = lake.snapshot_tables(
        {**{name: getattr(t, name) for name in _SOURCES}, "broken": unreadable}, path, DAY)
    counts = [
        (t.spark.range(0) if error else lake.latest_snapshot(t.spark, f"{path}/{name}")).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
            F.lit(error).cast("string").alias("error"))
        for name, error in outcomes.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query("""SELECT order_id, order_code, order_date, customer_id FROM silver_orders""")
def silver_round_trip(t: Tables):
    """Orders split into Silver and quarantine in one pass; Silver read back."""
    silver, quarantine = scratch_path(t.spark, "silver"), scratch_path(t.spark, "quarantine")
    lake.publish_silver(t.checked_orders, silver, quarantine, "orders", DAY, RUN_AT)
    return lake.latest_snapshot(t.spark, silver).select(
        "order_id", "order_code", "order_date", "customer_id"
    )


@query(f"""SELECT order_id, quarantine_reason, '{RUN_AT.isoformat()}' AS quarantined_at,
    'orders' AS transform_name FROM checked_orders WHERE quarantine_reason IS NOT NULL""")
def quarantine_round_trip(t: Tables):
    """The quarantine side of the same split."""
    silver, quarantine = scratch_path(t.spark, "silver"), scratch_path(t.spark, "quarantine")
    lake.publish_silver(t.checked_orders, silver, quarantine, "orders", DAY, RUN_AT)
    return lake.read_quarantine(t.spark, quarantine, "orders").select(
        "order_id", "quarantine_reason", "quarantined_at", "transform_name"
    )


@query("SELECT * FROM dim_product")
def gold_publish(t: Tables):
    """A Gold table replaced by a new version."""
    path = scratch_path(t.spark, "gold")
    lake.write_gold({"dim_product": t.products}, path, RUN_AT - timedelta(days=1))
    lake.write_gold({"dim_product": t.dim_product}, path, RUN_AT)
    return lake.read_gold(t.spark, path, "dim_product")


@query(f"SELECT *, {RUN} AS _loaded_at FROM dim_store")
def dimension_reload(t: Tables):
    """A dimension reloaded with a load time."""
    path = f"{scratch_path(t.spark, 'warehouse')}/dim_store"
    warehouse.reload_dimension(t.dim_store.where("is_active"), path, RUN_AT - timedelta(days=1))
    warehouse.reload_dimension(t.dim_store, path, RUN_AT)
    return _utc(warehouse.read_table(t.spark, path))


@query("""SELECT CASE WHEN customer_id % 3 = 0 THEN (SELECT count(*) FROM dim_customer WHERE customer_id % 3 <> 0)
        + row_number() OVER w ELSE row_number() OVER w END AS customer_key,
    customer_id, customer_code, city, state FROM dim_customer
    WINDOW w AS (PARTITION BY customer_id % 3 = 0 ORDER BY customer_code)""")
def dimension_keys(t: Tables):
    """A dimension loaded without a third of its members, then with all: old keys stay, new ones follow."""
    store = Store(t.spark, scratch_path(t.spark, "warehouse"))
    members = t.dim_customer.drop("customer_key")
    for at, part in zip(LOADS, (members.where("customer_id % 3 <> 0"), members), strict=False):
        load = store.load(at)
        warehouse.reload_members(load, "dim_customer", part, "customer_code", "customer_key")
        load.commit()
    return store.read("dim_customer").select("customer_key", "customer_id", "customer_code", "city", "state")


def _utc(df):
    """Load times without zone, as DuckDB reads them."""
    return df.withColumn("_loaded_at", F.to_timestamp_ntz(F.date_format("_loaded_at", "yyyy-MM-dd HH:mm:ss")))


_PAID = f"""(SELECT o_orderkey AS order_id, CAST(1 AS BIGINT) AS payment_sequential,
    CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value FROM orders)"""


@query(f"""SELECT order_id, payment_sequential,
    CASE WHEN date_key < 19980101 OR order_id % 7 <> 0 THEN date_key END AS date_key,
    CAST(CASE WHEN date_key >= 19980101 THEN payment_value * 2 ELSE payment_value END AS DECIMAL(12,2))
        AS payment_value,
    CASE WHEN date_key >= 19980101 THEN {RUN} ELSE {RUN} - INTERVAL 1 DAY END AS _loaded_at
    FROM {_PAID}""")
def fact_upsert(t: Tables):
    """A first load up to 1999, then a batch from 1998 on with changed, new, repeated and undated rows."""
    paid = t.raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).cast("long").alias("payment_sequential"),
        date_key(F.col("o_orderdate")).alias("date_key"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("payment_value"),
    )
    keyless = paid.where("order_id <= 40").withColumn("order_id", F.lit(None).cast("long"))
    later = paid.where("date_key >= 19980101").withColumn(
        "date_key", F.when(F.col("order_id") % 7 != 0, F.col("date_key"))
    )
    # Every key comes twice; the larger value is the last one.
    batch = later.unionByName(later.withColumn(
        "payment_value", (F.col("payment_value") * 2).cast("decimal(12,2)")
    ))
    path, key = f"{scratch_path(t.spark, 'warehouse')}/fact_payments", ["order_id", "payment_sequential"]
    warehouse.upsert_fact(paid.where("date_key < 20000101"), path, key, RUN_AT - timedelta(days=1))
    warehouse.upsert_fact(batch.unionByName(keyless), path, key, RUN_AT, [F.col("payment_value")])
    return _utc(warehouse.read_fact(t.spark, path))


# Table, attribute of the tables, view in SQL, and the column that its contents are compared by.
_WAREHOUSE = [
    ("dim_date", "dim_date", "dim_date", "date_key"), ("dim_customer", "dim_customer", "dim_customer", "customer_key"),
    ("dim_product", "dim_product", "dim_product", "product_key"), ("dim_store", "dim_store", "dim_store", "store_key"),
    ("dim_currency", "dim_currency", "dim_currency", "currency_key"),
    ("fact_sales", "fact_sales", "fact_sales", "unit_price"),
    ("fact_weather_daily", "fact_weather", "fact_weather", "temp_max"),
    ("fact_fx_rates", "fact_fx", "fact_fx", "rate"),
    ("fact_payments", "fact_payments", "fact_payments", "payment_value"),
]


@query(" UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, count(*) AS row_count, {RUN} AS loaded_at,
    CAST(sum({column}) AS DECIMAL(28,6)) AS total FROM {view}""" for name, _, view, column in _WAREHOUSE
))
def warehouse_load(t: Tables):
    """All registered tables, loaded with one load time, counted and summed from the warehouse."""
    gold, target = scratch_path(t.spark, "gold"), scratch_path(t.spark, "warehouse")
    columns = {name: column for name, _, _, column in _WAREHOUSE}
    lake.write_gold({name: getattr(t, attribute) for name, attribute, _, _ in _WAREHOUSE}, gold, RUN_AT)
    loaded = warehouse.load_all(t.spark, gold, target, RUN_AT)
    tables = Store(t.spark, target).snapshot()
    parts = [
        _utc(tables.read(name)).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.max("_loaded_at").alias("loaded_at"),
            F.sum(columns[name]).cast("decimal(28,6)").alias("total"),
        )
        for name in loaded
    ]
    return reduce(DataFrame.unionByName, parts)


# Three loads: up to 1996, the next two years with changes of 1996, the rest with changes of 1998.
LOADS = [RUN_AT - timedelta(days=60), RUN_AT - timedelta(days=30), RUN_AT]
LOAD_TIMES = f"""CASE WHEN date_key >= 19980701 THEN {RUN} WHEN date_key >= 19960701 THEN {RUN} - INTERVAL 30 DAY
    ELSE {RUN} - INTERVAL 60 DAY END"""


def three_loads(t: Tables, facts: dict[str, str]) -> Store:
    """A warehouse of facts, given with their attribute of the tables, after the three loads."""
    store = Store(t.spark, scratch_path(t.spark, "loads"))
    for at, first, last in zip(LOADS, (0, 19960701, 19980701), (19970101, 19990101, 99999999), strict=True):
        load = store.load(at)
        for name, attribute in facts.items():
            dated = t.stored(attribute).where(F.col("date_key").between(first, last - 1))
            load.upsert(name, dated, warehouse.FACT_KEYS[name])
        load.commit()
    return store


def loaded_payments(t: Tables) -> Store:
    return three_loads(t, {"fact_payments": "fact_payments"})


@query(f"""SELECT order_id, payment_sequential, date_key, {LOAD_TIMES} AS _loaded_at FROM fact_payments
    WHERE date_key IS NOT NULL AND {LOAD_TIMES} >= {RUN} - INTERVAL 40 DAY AND {LOAD_TIMES} < {RUN}""")
def load_time_range(t: Tables):
    """Rows that one of three loads left; files of the other load days are pruned while planning."""
    loaded = loaded_payments(t).read("fact_payments")
    part = warehouse.loaded_between(loaded, RUN_AT - timedelta(days=40), RUN_AT)
    return _utc(part.select("order_id", "payment_sequential", "date_key", "_loaded_at"))


@query(f"""SELECT 1 AS number, {RUN} - INTERVAL 60 DAY AS loaded_at, 'fact_payments' AS table_name,
    count(*) AS rows_in, 0 AS rows_replaced, count(*) AS rows_total FROM fact_payments WHERE date_key < 19970101
    UNION ALL SELECT 2, {RUN} - INTERVAL 30 DAY, 'fact_payments', count(*) FILTER (date_key >= 19960701),
    count(*) FILTER (date_key >= 19960701 AND date_key < 19970101), count(*) FROM fact_payments WHERE date_key < 19990101
    UNION ALL SELECT 3, {RUN}, 'fact_payments', count(*) FILTER (date_key >= 19980701),
    count(*) FILTER (date_key >= 19980701 AND date_key < 19990101), count(*) FROM fact_payments
    WHERE date_key IS NOT NULL""")
def load_history(t: Tables):
    """What each load brought, replaced and left, from the manifests alone."""
    return loaded_payments(t).history().select(
        F.col("number").cast("int").alias("number"),
        F.to_timestamp_ntz(F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss")).alias("loaded_at"), "table_name",
        "rows_in", "rows_replaced", "rows_total")


@query("""SELECT order_id, payment_sequential, date_key, payment_value FROM fact_payments
    WHERE date_key BETWEEN 19960101 AND 19961231""")
def dated_files(t: Tables):
    """A year of a loaded fact; only files whose range of dates meets it are opened."""
    return loaded_payments(t).read("fact_payments", date_key=(19960101, 19961231)).select(
        "order_id", "payment_sequential", "date_key", "payment_value")


_STAGES = {
    "orders": ("checked_orders", "silver_orders"), "order_items": ("checked_items", "silver_items"),
    "payments": ("checked_payments", "silver_payments"), "weather": ("checked_weather", "silver_weather"),
    "fx": ("checked_fx", "silver_fx"),
}


@query(" UNION ALL ".join([
    *(f"""SELECT '{stage}' AS stage, 'success' AS status, (SELECT count(*) FROM {silver}) AS rows_processed,
    CAST(NULL AS VARCHAR) AS error, true AS took_time""" for stage, (_, silver) in _STAGES.items()),
    """SELECT 'broken', 'failed', (SELECT count(*) FROM silver_orders), 'order 1 cannot be read', true"""]))
def run_history(t: Tables):
    """The five transforms written and one stage that fails, kept as run history."""
    path = scratch_path(t.spark, "history")

    def keep(stage):
        return lambda df: lake.write_gold({stage: df}, scratch_path(t.spark, stage), RUN_AT)

    for stage, (checked, _) in _STAGES.items():
        history.run_stage(getattr(t, checked), contracts.accepted, keep(stage), path, "run-1", stage)
    broken = F.when(F.col("order_id") >= 0, F.raise_error(F.lit("order 1 cannot be read")).cast("long"))
    history.run_stage(
        t.silver_orders, lambda df: df.withColumn("order_id", broken), keep("broken"), path, "run-1", "broken")
    return history.read_history(t.spark, path).select(
        "stage", "status", "rows_processed", "error", (F.col("duration_seconds") > 0).alias("took_time"))


@query("""SELECT 'readable' AS stage, 'success' AS status, count(*) AS rows_processed, CAST(NULL AS VARCHAR) AS error
    FROM checked_payments WHERE order_id % 2 = 1
    UNION ALL SELECT 'unreadable', 'failed', count(*), 'not a timestamp: soon' FROM checked_payments
    WHERE order_id % 2 = 0""")
def strict_dates(t: Tables):
    """Two batches of payments with load times as text; the strict rule fails the one with a text that is none."""
    path = scratch_path(t.spark, "history")
    text = t.payments.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"))
    least = text.where("order_id % 2 = 0").agg(F.min("order_id")).first()[0]
    spoilt = F.when(F.col("order_id") == least, F.lit("soon")).otherwise(F.col("ingested_at"))
    batches = {
        "readable": text.where("order_id % 2 = 1"),
        "unreadable": text.where("order_id % 2 = 0").withColumn("ingested_at", spoilt)}
    for stage, batch in batches.items():
        history.run_stage(
            batch, cleaning.clean_payments,
            lambda df, stage=stage: lake.write_gold({stage: df}, scratch_path(t.spark, stage), RUN_AT),
            path, "run-1", stage)
    return history.read_history(t.spark, path).select("stage", "status", "rows_processed", "error")


# Landed feeds: responses are made of the events, written as files, and read back by the name of the file.

# A second file of every feed and city or pair, which the service broke off.
BROKEN_OFF = "1990-01-01"


def landed(t: Tables, feed: str, responses: DataFrame, quarantine: str) -> DataFrame:
    """The readable files of a feed; the others go to the quarantine."""
    path = scratch_path(t.spark, feed)
    feeds.land(responses, path)
    first = keep_first(
        responses.withColumn("_of", F.regexp_replace("file_name", "_[^_]*$", "")), ["_of"], [F.col("file_name")])
    feeds.land(first.select(
        F.concat_ws("_", "_of", F.lit(BROKEN_OFF)).alias("file_name"),
        F.expr("substring(payload, 1, length(payload) - 1)").alias("payload")), path)
    good, bad = feeds.split_corrupt(feeds.read_responses(t.spark, path))
    lake.write_quarantine(bad, quarantine, feed, RUN_AT)
    return good


def _pair(part: int):
    return F.split("file_name", "_")[part]


_CITIES = "SELECT DISTINCT city FROM src_weather WHERE state IS NOT NULL"
_FEED_PAIRS = "SELECT DISTINCT base_currency, quote_currency FROM daily_fx WHERE rate IS NOT NULL"


@query(f"""SELECT 'weather' AS transform_name, replace(city, ' ', '_') || '_{BROKEN_OFF}' AS file_name,
    'unreadable JSON' AS quarantine_reason, true AS located FROM ({_CITIES})
    UNION ALL SELECT 'fx_flat', base_currency || '_' || quote_currency || '_{BROKEN_OFF}', 'unreadable JSON', true
    FROM ({_FEED_PAIRS})""")
def corrupt_responses(t: Tables):
    """The quarantine of two feeds after their files were read."""
    quarantine = scratch_path(t.spark, "quarantine")
    landed(t, "weather", _weather_responses(t), quarantine)
    landed(t, "fx_flat", _flat_responses(t), quarantine)
    parts = [lake.read_quarantine(t.spark, quarantine, feed) for feed in ("weather", "fx_flat")]
    located = F.col("file_path").contains("file_name=") & (F.col("block_start") == 0) & (F.col("block_length") > 0)
    return parts[0].unionByName(parts[1]).select(
        "transform_name", "file_name", "quarantine_reason", located.alias("located"))


@query("SELECT city, state, date, temp_max, temp_min, precipitation, windspeed, weathercode"
       " FROM src_weather WHERE state IS NOT NULL")
def weather_json(t: Tables):
    """Files of one response per city with parallel daily arrays; the city comes from the name."""
    good = landed(t, "weather", _weather_responses(t), scratch_path(t.spark, "quarantine"))
    # Names of files have underscores for spaces; the cities of these tables have underscores only.
    cities = t.weather.where("state is not null").select(F.translate("city", "_", " ").alias("city"), "state").distinct()
    return feeds.parse_weather(feeds.with_city(good, cities)).withColumn("city", F.translate("city", " ", "_"))


def _weather_responses(t: Tables) -> DataFrame:
    day = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("time"),
        F.col("temp_max").alias("temperature_2m_max"),
        F.col("temp_min").alias("temperature_2m_min"),
        F.col("precipitation").alias("precipitation_sum"),
        F.col("windspeed").alias("windspeed_10m_max"),
        F.col("weathercode").alias("weather_code"),
    )
    # At most one entry per calendar day.
    days = t.weather.where("state is not null").groupBy("city", "state").agg(
        F.sort_array(F.collect_list(day)).alias("days")
    )
    names = [
        "time", "temperature_2m_max", "temperature_2m_min", "precipitation_sum", "windspeed_10m_max",
        "weather_code",
    ]
    daily = F.struct(*[F.col(f"days.{n}").alias(n) for n in names])
    return days.select(
        F.concat_ws("_", F.translate("city", " ", "_"), F.lit(str(START))).alias("file_name"),
        F.to_json(F.struct(daily.alias("daily")), {"ignoreNullFields": "false"}).alias("payload"),
    )


_QUOTES = "SELECT date, base_currency, quote_currency, rate FROM daily_fx WHERE rate IS NOT NULL"


def _daily_quotes(t: Tables):
    return cleaning.keep_last(
        t.fx.where(F.col("date").between(F.lit(START), F.lit(END))).where("base_currency is not null"),
        ["base_currency", "quote_currency", "date"], [F.col("event_id")],
    )


def _by_pair_and_year(t: Tables, payload) -> DataFrame:
    """Responses named `<base>_<quote>_<year>`; a year has 366 entries at most."""
    return _daily_quotes(t).groupBy("base_currency", "quote_currency", F.year("date").alias("year")).agg(
        payload.alias("payload")).select(
        F.concat_ws("_", "base_currency", "quote_currency", "year").alias("file_name"), "payload")


@query(_QUOTES)
def fx_json_nested(t: Tables):
    """`rates` by date and currency, one response per pair and year."""
    entry = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("day"),
        F.create_map("quote_currency", F.col("rate").cast("double")).alias("rates"),
    )
    responses = _by_pair_and_year(t, F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias("rates"))))
    good = landed(t, "fx_nested", responses, scratch_path(t.spark, "quarantine"))
    return feeds.parse_fx_nested(good, _pair(0), _pair(1))


@query(_QUOTES)
def fx_json_list(t: Tables):
    """A list of daily objects, one response per pair and year."""
    entry = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("base_currency").alias("base"),
        F.col("quote_currency").alias("quote"),
        F.col("rate").cast("double").alias("rate"),
    )
    responses = _by_pair_and_year(t, F.to_json(F.collect_list(entry)))
    return feeds.parse_fx_list(landed(t, "fx_list", responses, scratch_path(t.spark, "quarantine")))


@query(_QUOTES)
def fx_json_flat(t: Tables):
    """A flat date map, one response per pair and year."""
    good = landed(t, "fx_flat", _flat_responses(t), scratch_path(t.spark, "quarantine"))
    return feeds.parse_fx_flat(good, _pair(0), _pair(1))


def _flat_responses(t: Tables) -> DataFrame:
    entry = F.struct(F.date_format("date", "yyyy-MM-dd"), F.col("rate").cast("double"))
    return _by_pair_and_year(t, F.to_json(F.map_from_entries(F.collect_list(entry))))


_PAIRS = """(SELECT DISTINCT base_currency, quote_currency FROM silver_fx UNION
    SELECT DISTINCT quote_currency, base_currency FROM silver_fx WHERE quote_currency = 'BRL')"""


@query(f"""SELECT 'weather' AS source, DATE '{START}' AS start_date, DATE '{END}' AS end_date,
    CAST(26 AS BIGINT) AS requested, count(DISTINCT city) AS delivered, count(*) AS total_records,
    'partial' AS status FROM silver_weather UNION ALL
    SELECT 'fx ' || base_currency || '/' || quote_currency, DATE '{START}', DATE '{END}',
    CAST({(END - START).days + 1} AS BIGINT), count(*) FILTER (rate IS NOT NULL AND (p IS NULL OR p <> rate)),
    count(rate), CASE WHEN count(rate) = 0 THEN 'failed' ELSE 'success' END
    FROM {_PAIRS} LEFT JOIN (SELECT *, lag(rate) OVER (
        PARTITION BY base_currency, quote_currency ORDER BY date) AS p FROM silver_fx)
        USING (base_currency, quote_currency)
    GROUP BY base_currency, quote_currency""")
def extraction_manifests(t: Tables):
    """Manifests of what was asked for; the rates of BRL in other currencies were never delivered."""
    pairs = t.silver_fx.select("base_currency", "quote_currency").distinct()
    turned = pairs.where("quote_currency = 'BRL'").selectExpr(
        "quote_currency AS base_currency", "base_currency AS quote_currency")
    return manifests.all_manifests(
        t.silver_weather, t.silver_fx, START, END, requested_cities=26, requested_pairs=pairs.union(turned))


@query("""SELECT order_id, order_date, quarantine_reason FROM checked_orders""")
def incremental_orders(t: Tables):
    """Orders cleaned as a stream of arriving files; accepted and rejected rows read back."""
    silver, quarantine, state = (scratch_path(t.spark, n) for n in ("silver", "quarantine", "state"))
    arriving = incremental.stream_parquet(t.spark, t.folder, "orders.parquet")
    incremental.clean_new_files(
        arriving,
        lambda batch: cleaning.clean_orders(t.orders_of(batch)),
        silver, quarantine, state,
    )
    kept = t.spark.read.parquet(silver).withColumn("quarantine_reason", F.lit(None).cast("string"))
    lost = t.spark.read.parquet(quarantine)
    columns = ["order_id", "order_date", "quarantine_reason"]
    return kept.select(*columns).unionByName(lost.select(*columns))
