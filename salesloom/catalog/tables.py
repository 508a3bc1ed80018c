"""The commerce tables of the library as views over the driver's tables.

Some values are made missing or invalid on purpose, by conditions on the values themselves, so that
every rule of the library has rows to act on. `sql.py` states the same views for DuckDB.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from salesloom.functions.dates import days_between, date_key
from salesloom.functions.text import macro_region, normalize_city
from salesloom.operators import cleaning, contracts, skew
from salesloom.operators.dedup import keep_first
from salesloom.operators.lookups import lookup
from salesloom.plans import dimensions, facts, measures, source_tables
from salesloom.session import scratch_path

# Processing range, a little narrower than the data so that both ends reject rows.
START, END = date(1995, 3, 1), date(2001, 6, 30)
RUN_AT = datetime(2024, 2, 1, 6, 0, 0)
# Days over which the events are spread: 1995-01-01 to 2001-07-31.
SPREAD_DAYS = 2404
RUN_AT_NTZ = f"TIMESTAMP_NTZ '{RUN_AT}'"


class Tables:
    """DataFrames over one data folder, built when first asked for.

    Building one reads schemas, and a table with surrogate keys runs the jobs that number its rows.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._stored: dict[str, DataFrame] = {}
        self._schemas: dict[str, StructType] = {}

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    # Source tables -------------------------------------------------------------------------

    def places(self) -> DataFrame:
        """Nation and two-letter region code per nation key."""
        region = self.raw("region").selectExpr(
            "r_regionkey AS n_regionkey", "substring(r_name, 1, 2) AS state"
        )
        return self.raw("nation").join(region, "n_regionkey").select("n_nationkey", "n_name", "state")

    @cached_property
    def customers(self) -> DataFrame:
        placed = self.raw("customer").withColumnRenamed("c_nationkey", "n_nationkey")
        return placed.join(self.places(), "n_nationkey").selectExpr(
            "c_custkey AS customer_id",
            "CASE WHEN c_acctbal >= -900 THEN c_name END AS customer_code",
            "lpad(string(n_nationkey), 5, '0') AS zip_code_prefix",
            "n_name AS city",
            "state",
            "c_acctbal >= 0 AS is_active",
        )

    @cached_property
    def stores(self) -> DataFrame:
        placed = self.raw("supplier").withColumnRenamed("s_nationkey", "n_nationkey")
        named = placed.join(self.places(), "n_nationkey").selectExpr(
            "s_suppkey AS store_id",
            "s_name AS store_code",
            "lpad(string(n_nationkey), 5, '0') AS zip_code_prefix",
            "n_name AS city",
            "state",
            "s_acctbal >= 0 AS is_active",
        )
        return named.withColumn("region", macro_region(F.col("state")))

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS product_id",
            "concat('PRD-', p_partkey) AS product_code",
            "CASE WHEN p_size > 3 THEN concat(p_type, ' ', p_brand) END AS category_name_en",
            "p_brand AS category_name_pt",
            "string(p_size * 100) AS weight_g",
            "p_retailprice > 1000 AS is_active",
        )

    @cached_property
    def orders(self) -> DataFrame:
        """Orders before cleaning."""
        return self.orders_of(self.raw("orders"))

    def orders_of(self, rows: DataFrame) -> DataFrame:
        """The order view over any rows of the raw table, such as a batch of a stream."""
        dated = rows.selectExpr(
            "*", "CASE WHEN o_totalprice <= 495000 THEN to_date(o_orderdate) END AS order_date"
        )
        named = dated.selectExpr(
            "o_orderkey AS order_id",
            "concat('ORD-', o_orderkey) AS order_code",
            "CASE WHEN o_totalprice >= 5000 THEN o_custkey END AS customer_id",
            """CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
                WHEN o_orderpriority = '1-URGENT' THEN 'lost' ELSE 'canceled' END AS order_status""",
            "order_date",
            "o_orderdate AS order_timestamp",
            """CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a'
                ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END AS approved_at""",
            "date_add(order_date, int(10 + o_custkey % 15)) AS estimated_delivery",
            """CASE WHEN o_orderstatus = 'F'
                THEN date_add(order_date, int(o_orderkey * 7 % 41 - 1)) END AS actual_delivery""",
            "'online' AS source_channel",
            "CASE WHEN o_totalprice > 450000 THEN 'USD' ELSE 'BRL' END AS currency_code",
            f"{RUN_AT_NTZ} AS ingested_at",
        )
        day = F.col("order_date")
        return named.withColumns(
            {
                "delivery_days_actual": days_between(F.col("actual_delivery"), day),
                "delivery_days_estimated": days_between(F.col("estimated_delivery"), day),
            }
        )

    LINE_COLUMNS = [
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "l_suppkey AS store_id",
        "l_linenumber AS line_number",
        "CASE WHEN l_quantity < 50 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS unit_price",
        """CASE WHEN l_tax > 0 THEN CAST(round(CAST(l_extendedprice AS DECIMAL(12,2))
            * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) END AS freight_value""",
        "CASE WHEN l_quantity > 1 THEN int(l_quantity) END AS quantity",
    ]

    @cached_property
    def order_items(self) -> DataFrame:
        """Items before cleaning, one row per order and line number."""
        ties = [
            F.col(c)
            for c in (
                "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate",
            )
        ]
        lines = keep_first(self.raw("lineitem"), ["l_orderkey", "l_linenumber"], ties)
        return lines.selectExpr(
            "l_orderkey * 100 + l_linenumber AS order_item_id",
            *self.LINE_COLUMNS,
            f"{RUN_AT_NTZ} AS ingested_at",
        )

    @cached_property
    def payments(self) -> DataFrame:
        """Payments before cleaning, numbers as text."""
        return self.raw("orders").selectExpr(
            "o_orderkey AS order_id",
            "'1' AS payment_sequential",
            """CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
                WHEN '3-MEDIUM' THEN 'voucher' WHEN '5-LOW' THEN 'debit_card'
                ELSE 'not_defined' END AS payment_type""",
            "string(o_custkey % 12) AS payment_installments",
            """CASE WHEN o_totalprice < 3000 THEN 'unknown'
                ELSE string(CAST(o_totalprice AS DECIMAL(12,2))) END AS payment_value""",
            f"{RUN_AT_NTZ} AS ingested_at",
        )

    EVENT_DAY = f"date_add(DATE '1995-01-01', int(event_id * 7919 % {SPREAD_DAYS})) AS date"

    @cached_property
    def weather(self) -> DataFrame:
        """Daily weather per city before cleaning, as floats."""
        days = (
            self.raw("events")
            .selectExpr("*", "int(user_id % 25) AS n_nationkey", self.EVENT_DAY)
            .groupBy("date", "n_nationkey")
            .agg(
                F.max("value").alias("high"),
                F.min("value").alias("low"),
                F.max("event_id").alias("last_event"),
                F.expr("max(CASE WHEN event_type <> 'error' THEN event_id % 104 END) AS code"),
            )
        )
        return days.join(self.places(), "n_nationkey").selectExpr(
            "n_name AS city",
            "CASE WHEN low < 200 THEN state END AS state",
            "date",
            "double(round(CAST(high AS DECIMAL(12,2)), 1)) - 20 AS temp_max",
            "double(round(CAST(low AS DECIMAL(12,2)), 1)) - 25 AS temp_min",
            "double(round(CAST(low / 3 AS DECIMAL(12,2)), 1)) AS precipitation",
            "double(last_event % 90) AS windspeed",
            "double(code) AS weathercode",
        )

    @cached_property
    def fx(self) -> DataFrame:
        """Rate quotes before cleaning, several per pair and day."""
        return self.raw("events").selectExpr(
            self.EVENT_DAY,
            """CASE WHEN event_type = 'purchase' THEN 'USD'
                WHEN event_type IN ('click', 'view') THEN 'EUR'
                WHEN event_type = 'signup' THEN 'GBP' END AS base_currency""",
            "CASE WHEN event_type = 'view' THEN 'USD' ELSE 'BRL' END AS quote_currency",
            """CAST(CASE WHEN CAST(value AS DECIMAL(12,2)) > 300 THEN NULL
                WHEN CAST(value AS DECIMAL(12,2)) < 1 THEN 0
                ELSE (CAST(value AS DECIMAL(12,2)) + 100) * 0.01 END AS DECIMAL(16,6)) AS rate""",
            "event_id",
        )

    @cached_property
    def reviews(self) -> DataFrame:
        return self.raw("conversations").selectExpr(
            "conv_id AS review_id",
            "turn AS order_id",
            "length(text) % 5 + 1 AS review_score",
            "text AS review_comment_message",
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        """Points per zip prefix."""
        return self.raw("events").selectExpr(
            "lpad(string(user_id % 25), 5, '0') AS zip_code_prefix",
            "value / 10 - 30 AS latitude",
            "minute(ts) + second(ts) / 60 - 60 AS longitude",
        )

    # Raw commerce files -----------------------------------------------------------------------

    @cached_property
    def raw_customers(self) -> DataFrame:
        """One row per order with the person behind it; cheap orders have none."""
        people = self.raw("customer").join(
            self.places(), F.col("c_nationkey") == F.col("n_nationkey")
        )
        buyers = self.raw("orders").where("o_totalprice >= 4000").select("o_orderkey", "o_custkey")
        return buyers.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
            F.concat(F.lit("OC-"), F.col("o_orderkey").cast("string")).alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
            F.col("n_name").alias("customer_city"),
            F.col("state").alias("customer_state"),
        )

    @cached_property
    def raw_sellers(self) -> DataFrame:
        """Sellers in good standing."""
        placed = self.raw("supplier").join(
            self.places(), F.col("s_nationkey") == F.col("n_nationkey")
        )
        return placed.where("s_acctbal >= -500").select(
            F.col("s_name").alias("seller_id"),
            F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.col("state").alias("seller_state"),
        )

    @cached_property
    def raw_products(self) -> DataFrame:
        size = (F.col("p_size") * 100).cast("string")
        return self.raw("part").where("p_size >= 2").select(
            F.concat(F.lit("PRD-"), F.col("p_partkey").cast("string")).alias("product_id"),
            F.when(F.col("p_size") > 3, F.col("p_brand")).alias("product_category_name"),
            F.when(F.col("p_type") == "PROMO", "n/a").otherwise(size).alias("product_weight_g"),
            F.col("p_size").cast("string").alias("product_length_cm"),
            F.col("p_size").cast("string").alias("product_height_cm"),
            F.col("p_size").cast("string").alias("product_width_cm"),
        )

    @cached_property
    def raw_translations(self) -> DataFrame:
        """English names of all brands but one."""
        brands = self.raw("part").select("p_brand").distinct().where("p_brand <> 'Brand#13'")
        return brands.select(
            F.col("p_brand").alias("product_category_name"),
            F.concat(F.lit("Group "), F.col("p_brand")).alias("product_category_name_english"),
        )

    @cached_property
    def raw_orders(self) -> DataFrame:
        text = "yyyy-MM-dd HH:mm:ss"
        return self.orders.select(
            F.col("order_code").alias("order_id"),
            F.concat(F.lit("OC-"), F.col("order_id").cast("string")).alias("customer_id"),
            "order_status",
            F.date_format("order_timestamp", text).alias("order_purchase_timestamp"),
            F.col("approved_at").alias("order_approved_at"),
            F.date_format("actual_delivery", text).alias("order_delivered_customer_date"),
            F.date_format("estimated_delivery", text).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def raw_order_items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        freight = F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(12,2)")
        supplier = F.lpad(F.col("l_suppkey").cast("string"), 9, "0")
        return self.raw("lineitem").select(
            F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")).alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.concat(F.lit("PRD-"), F.col("l_partkey").cast("string")).alias("product_id"),
            F.concat(F.lit("Supplier#"), supplier).alias("seller_id"),
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipping_limit_date"),
            price.alias("price"),
            freight.alias("freight_value"),
        )

    @cached_property
    def raw_payments(self) -> DataFrame:
        p = F.col
        return self.payments.select(
            F.concat(F.lit("ORD-"), p("order_id").cast("string")).alias("order_id"),
            p("payment_sequential").cast("int").alias("payment_sequential"),
            "payment_type",
            p("payment_installments").cast("int").alias("payment_installments"),
            p("payment_value").try_cast("decimal(12,2)").alias("payment_value"),
        )

    @cached_property
    def source_customers(self) -> DataFrame:
        return source_tables.customers(self.raw_customers, RUN_AT)

    @cached_property
    def source_stores(self) -> DataFrame:
        return source_tables.stores(self.raw_sellers, RUN_AT)

    @cached_property
    def source_products(self) -> DataFrame:
        return source_tables.products(
            self.raw_products, self.raw_translations, RUN_AT
        )

    @cached_property
    def source_orders(self) -> tuple[DataFrame, DataFrame]:
        return source_tables.orders(
            self.raw_orders, self.raw_customers, self.source_customers, RUN_AT
        )

    # Annotated and Silver tables ------------------------------------------------------------

    @cached_property
    def checked_orders(self) -> DataFrame:
        return cleaning.clean_orders(self.orders)

    @cached_property
    def silver_orders(self) -> DataFrame:
        return contracts.accepted(self.checked_orders)

    @cached_property
    def checked_items(self) -> DataFrame:
        return cleaning.clean_order_items(self.order_items, self.silver_orders)

    @cached_property
    def silver_items(self) -> DataFrame:
        return contracts.accepted(self.checked_items)

    @cached_property
    def checked_weather(self) -> DataFrame:
        return cleaning.clean_weather(self.weather, START, END)

    @cached_property
    def silver_weather(self) -> DataFrame:
        """Valid weather; city names get the form of `normalized_city`."""
        return contracts.accepted(self.checked_weather).withColumn(
            "city", normalize_city(F.col("city"))
        )

    @cached_property
    def checked_fx(self) -> DataFrame:
        return cleaning.clean_fx(self.fx, START, END, [F.col("event_id")])

    @cached_property
    def silver_fx(self) -> DataFrame:
        return contracts.accepted(cleaning.daily_fx(self.fx, START, END, [F.col("event_id")]))

    @cached_property
    def checked_payments(self) -> DataFrame:
        return cleaning.clean_payments(self.payments)

    @cached_property
    def silver_payments(self) -> DataFrame:
        return contracts.accepted(self.checked_payments)

    # Gold tables ----------------------------------------------------------------------------

    @cached_property
    def dim_date(self) -> DataFrame:
        """Every day from the first to the last day of the orders and events."""
        orders = self.raw("orders").selectExpr("to_date(o_orderdate) AS date")
        days = orders.unionByName(self.raw("events").selectExpr(self.EVENT_DAY))
        first, last = days.agg(F.min("date"), F.max("date")).first()
        return dimensions.dim_date(self.spark, first or START, last or END)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dimensions.dim_customer(
            self.customers, [F.col("customer_id")]
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.products, [F.col("product_id")])

    @cached_property
    def dim_store(self) -> DataFrame:
        return dimensions.dim_store(self.stores, [F.col("store_id")])

    @cached_property
    def dim_currency(self) -> DataFrame:
        return dimensions.dim_currency(self.silver_orders, self.silver_fx)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return facts.fact_sales(
            self.silver_items, self.silver_orders, self.dim_customer, self.dim_product,
            self.dim_store, self.dim_currency, self.hot_orders,
        )

    @cached_property
    def hot_orders(self) -> dict[int, int]:
        """Orders with very many lines, counted over the order keys alone."""
        return skew.hot_keys(self.raw("lineitem").select(F.col("l_orderkey").alias("order_id")), ["order_id"])

    @cached_property
    def fact_weather(self) -> DataFrame:
        return facts.fact_weather_daily(self.silver_weather)

    @cached_property
    def fact_fx(self) -> DataFrame:
        return facts.fact_fx_rates(self.silver_fx, self.dim_currency)

    @cached_property
    def fact_payments(self) -> DataFrame:
        return facts.fact_payments(
            self.silver_payments, self.silver_orders, self.dim_customer, self.dim_currency,
            skew.hot_keys(self.payments, ["order_id"]),
        )

    def stored(self, name: str) -> DataFrame:
        """A table written to the shared folder and read back, so that many readers build it once.

        Tables that are built after this read it from there as well, with the statistics of its files.
        """
        if name not in self._stored:
            path = f"{scratch_path(self.spark, 'gold')}/{name}"
            built = getattr(self, name)
            built.write.parquet(path)
            self._stored[name] = self.spark.read.schema(built.schema).parquet(path)
            self.__dict__[name] = self._stored[name]
        return self._stored[name]

    # Sales for measures ---------------------------------------------------------------------

    @cached_property
    def lines(self) -> DataFrame:
        """The rows of the sales fact before its key lookups.

        Items of Silver orders, one per order and line number, checked by their contract. Members are
        looked up per order, product or seller afterwards, which gives what the fact's keys give.
        """
        return self.silver_items.select(
            "order_id", "product_id", "store_id", "line_number", "unit_price", "freight_value", "quantity"
        )

    @cached_property
    def order_headers(self) -> DataFrame:
        """Silver orders with their customer's key and place, NULL where the dimension has no member."""
        headers = self.silver_orders.select(
            "order_id", "order_code", "customer_id", "order_status", "order_date",
            date_key(F.col("order_date")).alias("date_key"), "delivery_days_actual",
            "delivery_days_estimated",
        )
        members = self.dim_customer.select(
            "customer_id", "customer_key", F.col("city").alias("customer_city"),
            F.col("state").alias("customer_state"),
        )
        return lookup(headers, members, {"customer_id": "customer_id"}, ["order_id"])

    @cached_property
    def sales(self) -> DataFrame:
        """Totals of every Silver order that has lines."""
        return measures.order_totals(self.lines, self.order_headers)

    @cached_property
    def sales_by_customer(self) -> DataFrame:
        """Order totals of known customers."""
        return self.sales.where("customer_key is not null")

    @cached_property
    def sale_lines(self) -> DataFrame:
        """Lines with the attributes of their order."""
        return self.lines.join(self.order_headers, "order_id")

    @cached_property
    def lines_of_customers(self) -> DataFrame:
        """Lines of known customers."""
        return self.sale_lines.where("customer_key is not null")

    def sales_by(self, attribute: str) -> DataFrame:
        """Totals of every order and value of a line attribute: `category` or `seller_state`."""
        if attribute == "category":
            members = self.dim_product.select("product_id", F.col("category_name_en").alias(attribute))
            lines = lookup(self.lines, members, {"product_id": "product_id"}, ["order_id", "line_number"])
        else:
            members = self.dim_store.select("store_id", F.col("state").alias(attribute))
            lines = lookup(self.lines, members, {"store_id": "store_id"}, ["order_id", "line_number"])
        return measures.order_totals(lines, self.order_headers, [attribute])
