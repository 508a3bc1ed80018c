"""Shape of the plans: what must not appear at scale, and what must."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesloom.catalog.queries import QUERIES
from salesloom.catalog.tables import Tables
from salesloom.operators import skew
from salesloom.plans import dimensions, marts, measures, source_tables
from salesloom.session import shared_folder

FOLDER = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", [
    "fact_sales", "fact_payments", "sales_enriched", "sales_with_weather", "source_detail",
    "source_order_items", "unresolved_customers", "seller_scorecard", "weather_revenue",
    "categories_and_others", "revenue_growth", "join_coverage", "fx_cleaned", "dim_geolocation",
])
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@needs_tables
def test_lines_are_summed_before_the_join(spark):
    text = plan(measures.measure(Tables(spark, FOLDER).sales, ["order_status"], ["total_revenue"]))
    join = text.index("Join")
    assert "partial_sum" in text[join:], "the sum per order is below the join"


@needs_tables
def test_reports_of_lookups_read_the_stored_rows(spark):
    text = plan(QUERIES["unresolved_source_keys"](spark, FOLDER))
    assert "l_orderkey" not in text and "Join" not in text, "the lookups are not made again for their reports"


@pytest.mark.parametrize("dealt", [True, False])
def test_items_are_numbered_while_they_are_stored(spark, rows, monkeypatch, dealt):
    """Once, and without gaps, although rows that missed a key are stored among them; with hot orders or without."""
    hot = []
    monkeypatch.setattr(source_tables, "hot_keys", lambda df, keys: hot.append(skew.hot_keys(df, keys)) or (not dealt and hot[0]))
    raw = spark.createDataFrame(
        [("o2", 1, "p1", "s1", 1), ("o1", 2, "p1", "s1", 2), ("o1", 1, "p9", "s1", 3), ("o1", 3, "p1", "s1", 5),
         ("o1", 3, "p1", "s1", 4), ("o8", 1, "p1", "s1", 6), (None, 1, "p1", "s9", 7), ("o2", None, "p1", "s9", 8),
         ("o2", 2, "p1", "s1", 9)],
        "order_id string, order_item_id int, product_id string, seller_id string, price int",
    ).withColumns({"freight_value": F.lit(0), "shipping_limit_date": F.lit("2018-01-02 03:04:05")})
    tables = [
        spark.createDataFrame(values, f"{kind}_id long, {kind}_code string")
        for kind, values in (("order", [(1, "o1"), (2, "o2"), (3, "o2"), (4, None)]), ("product", [(7, "p1")]), ("store", [(5, "s1")]))]
    folder = Path(shared_folder(spark))
    before = set(folder.iterdir())
    items, reports = source_tables.order_items(raw, *tables, dt.datetime(2024, 2, 1))
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["numbered"]
    assert len(hot[0]) > 0
    assert rows(items.select("order_item_id", "order_id", "line_number", "unit_price")) == [
        (1, 1, 2, 2), (2, 1, 3, 4), (3, 2, 1, 1), (4, 2, 2, 9), (5, 3, 1, 1), (6, 3, 2, 9)]
    assert [tuple(r.first()) for r in reports] == [
        ("order_code", 2, ["o8"]), ("product_code", 1, ["p9"]), ("store_code", 2, ["s9"])]


@needs_tables
@pytest.mark.parametrize("name", ["quality_gate", "quality_summary", "quality_pass_rate"])
def test_checks_of_items_read_the_stored_items(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "l_shipdate" not in text, "repeated lines are not dropped once more for a check"


@needs_tables
def test_stored_tables_serve_what_is_built_later(spark):
    t = Tables(spark, FOLDER)
    items, orders = t.stored("order_items"), t.stored("silver_orders")
    assert t.order_items is items and t.silver_orders is orders
    text = plan(t.silver_items)
    assert "l_shipdate" not in text and "o_orderkey" not in text


@needs_tables
def test_customers_are_looked_up_once_for_each_order(spark):
    text = Tables(spark, FOLDER).fact_sales._jdf.queryExecution().analyzed().toString()
    spread = re.findall(r"isnull\(customer_id#\d+L?\) THEN xxhash64\((\w+)#", text)
    assert spread == ["order_id"], "rows of lines are not dealt out by customer"


@needs_tables
def test_scan_reads_only_needed_columns(spark):
    text = plan(measures.measure(Tables(spark, FOLDER).sales, [], ["units_sold"]))
    schema = next(s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "l_orderkey" in s)
    assert "l_shipdate" not in schema and "l_returnflag" not in schema


@needs_tables
def test_load_time_range_reaches_the_scan(spark, tmp_path):
    from salesloom.sources import warehouse

    path = str(tmp_path / "f")
    df = spark.createDataFrame([(1, 20240115)], "id int, date_key int")
    warehouse.upsert_fact(df, path, ["id"], dt.datetime(2024, 2, 1))
    part = warehouse.loaded_between(
        warehouse.read_fact(spark, path), dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)
    )
    assert "GreaterThanOrEqual(_loaded_at" in plan(part)


@needs_tables
def test_full_rebuild_is_stable(spark, rows):
    """Two builds of a dimension from differently ordered rows give the same keys."""
    t = Tables(spark, FOLDER)
    builds = [
        dimensions.dim_customer(t.customers.repartition(n), [F.col("customer_id")]) for n in (1, 5)
    ]
    assert rows(builds[0]) == rows(builds[1])


def test_usd_is_null_only_without_a_rate(spark, rows):
    sales = spark.createDataFrame(
        [(1, "o1", 20170101, "10.00", "2.00"), (2, "o2", 20170102, "10.00", None)],
        "order_item_id int, order_code string, date_key int, unit_price string, freight_value string",
    ).withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("unit_price", "freight_value")})
    fx = spark.createDataFrame(
        [(20170101, "USD", "BRL", 3.0), (20170102, "EUR", "BRL", 4.0)],
        "date_key int, base_currency string, quote_currency string, rate double",
    ).withColumn("rate", F.col("rate").cast("decimal(16,6)"))
    usd = marts.sales_usd(sales, fx).select("order_item_id", F.col("unit_price_usd").cast("string"))
    assert rows(usd) == [(1, "3.3333"), (2, None)]


def test_revenue_in_usd_counts_zero_without_a_rate(spark):
    sales = spark.createDataFrame([(20170101, 30), (20170102, 99)], "date_key int, revenue int")
    rates = spark.createDataFrame([(20170101, 3.0)], "date_key int, rate double").withColumn(
        "rate", F.col("rate").cast("decimal(16,6)")
    )
    assert float(measures.revenue_in_usd(sales, rates).first()[0]) == 10.0


@pytest.mark.parametrize("rates, deviation_off, state", [
    ((0.0, 0.0, 0.0, 0), 0, "NOMINAL"), ((0.0, 0.06, 0.0, 0), 0, "REVIEW NEEDED"), ((0.0, 0.0, 0.0, 4), 0, "REVIEW NEEDED"),
    ((0.0, 0.0, 0.0, 0), 9, "REVIEW NEEDED"), ((0.06, 0.0, 0.0, 0), 0, "PIPELINE FAULT"),
    ((0.0, 0.0, 0.2, 0), 0, "PIPELINE FAULT"), ((0.0, 0.0, 0.0, 0), 100, "PIPELINE FAULT"),
])
def test_pipeline_states(spark, rates, deviation_off, state):
    from salesloom.plans import health

    counts = spark.createDataFrame([("a", 100 - deviation_off)], "table_name string, row_count long")
    one = spark.createDataFrame([rates], "order_id_null_rate double, join_key_null_rate double, undocumented_drop double, missing_days int")
    assert health.pipeline_status(counts, {"a": 100}, one).first()["pipeline_status"] == state
