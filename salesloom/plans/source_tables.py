"""Source tables built from the raw commerce files.

Ids are dense numbers in the order of the business code, so that a rebuild gives the same ids.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.functions.dates import days_between, parse_date, parse_timestamp
from salesloom.functions.numbers import parse_number
from salesloom.functions.text import category_fallback, macro_region
from salesloom.functions.fixed import UNKNOWN_MACRO_REGION
from salesloom.operators.dedup import keep_first
from salesloom.operators.keys import assign_surrogate_keys, number_stored, store_in_order
from salesloom.operators.lookups import lookup, resolve, resolve_all
from salesloom.operators.skew import hot_keys


def _audit(at: datetime) -> dict[str, Column]:
    """Audit columns with one time per run."""
    stamp = F.lit(at).cast("timestamp_ntz")
    return {"is_active": F.lit(True), "created_at": stamp, "ingested_at": stamp}


def customers(raw: DataFrame, at: datetime) -> DataFrame:
    """One row per person; the raw file has one customer id per order."""
    first = keep_first(raw, ["customer_unique_id"], [F.col("customer_id")])
    named = first.select(
        F.col("customer_unique_id").alias("customer_code"),
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
    ).withColumns({**_audit(at), "updated_at": F.lit(at).cast("timestamp_ntz")})
    return assign_surrogate_keys(named, "customer_id", [F.col("customer_code")])


def stores(raw: DataFrame, at: datetime) -> DataFrame:
    """One row per seller with the macro-region of its state."""
    order = [F.col("seller_zip_code_prefix"), F.col("seller_city"), F.col("seller_state")]
    first = keep_first(raw, ["seller_id"], order)
    named = first.select(
        F.col("seller_id").alias("store_code"),
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
        macro_region(F.col("seller_state")).alias("region"),
    ).withColumns(_audit(at))
    return assign_surrogate_keys(named, "store_id", [F.col("store_code")])


def unmapped_states(stores: DataFrame) -> DataFrame:
    """States of stores that no macro-region holds."""
    return stores.where(F.col("region") == UNKNOWN_MACRO_REGION).select("state").distinct()


def products(
    raw: DataFrame, translations: DataFrame, at: datetime
) -> DataFrame:
    """One row per product; the category falls back to Portuguese, then to 'unknown'."""
    first = keep_first(raw, ["product_id"], [F.col("product_category_name")])
    english = translations.withColumnRenamed("product_category_name", "name")
    translated = lookup(first, english, {"product_category_name": "name"}, ["product_id"])
    named = translated.select(
        F.col("product_id").alias("product_code"),
        F.col("product_category_name").alias("category_name_pt"),
        category_fallback(
            F.col("product_category_name_english"), F.col("product_category_name")
        ).alias("category_name_en"),
        parse_number(F.col("product_weight_g"), "decimal(10,2)").alias("weight_g"),
        parse_number(F.col("product_length_cm"), "decimal(10,2)").alias("length_cm"),
        parse_number(F.col("product_height_cm"), "decimal(10,2)").alias("height_cm"),
        parse_number(F.col("product_width_cm"), "decimal(10,2)").alias("width_cm"),
    ).withColumns(_audit(at))
    return assign_surrogate_keys(named, "product_id", [F.col("product_code")])


def orders(
    raw: DataFrame,
    raw_customers: DataFrame,
    customers: DataFrame,
    at: datetime,
) -> tuple[DataFrame, DataFrame]:
    """Orders of known persons, and a report of the dropped ones with one row per lookup.

    The raw order names a customer id of its own, which the raw customer file maps to the person.
    """
    bridge = keep_first(
        raw_customers.select("customer_id", "customer_unique_id"),
        ["customer_id"],
        [F.col("customer_unique_id")],
    )
    named_bridge = bridge.withColumnRenamed("customer_id", "raw_id")
    # Narrower than their texts, before the rows travel.
    dated = raw.withColumns({
        "order_purchase_timestamp": parse_timestamp(F.col("order_purchase_timestamp")),
        "order_approved_at": parse_timestamp(F.col("order_approved_at")),
        "order_estimated_delivery_date": parse_date(F.col("order_estimated_delivery_date")),
        "order_delivered_customer_date": parse_date(F.col("order_delivered_customer_date")),
    })
    linked, unlinked = resolve(
        dated, named_bridge, {"customer_id": "raw_id"}, ["order_id"], "customer_unique_id"
    )
    codes = customers.select("customer_id", F.col("customer_code").alias("code"))
    found, unknown = resolve(
        linked.drop("customer_id"), codes, {"customer_unique_id": "code"}, ["order_id"], "customer_id"
    )
    purchased = F.col("order_purchase_timestamp")
    day = F.to_date(purchased)
    estimated, delivered = F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date")
    stamp = F.lit(at).cast("timestamp_ntz")
    named = found.select(
        F.col("order_id").alias("order_code"),
        "customer_id",
        "order_status",
        day.alias("order_date"),
        purchased.alias("order_timestamp"),
        F.col("order_approved_at").alias("approved_at"),
        estimated.alias("estimated_delivery"),
        delivered.alias("actual_delivery"),
        days_between(delivered, day).alias("delivery_days_actual"),
        days_between(estimated, day).alias("delivery_days_estimated"),
        F.lit("online").alias("source_channel"),
        F.lit("BRL").alias("currency_code"),
        stamp.alias("created_at"),
        stamp.alias("ingested_at"),
    )
    keyed = assign_surrogate_keys(named, "order_id", [F.col("order_code")])
    return keyed, unlinked.unionByName(unknown)


def _in_order(missed: Column, order: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Stores looked-up rows in the order of their numbers, so that they are not stored twice.

    Rows that missed a key come behind all others, whose numbers are dense therefore. The code that an order
    was not found by tells them apart; it is NULL in the others.
    """
    return lambda joined: store_in_order(joined, [missed, *[F.col(c) for c in order], F.col("order_code")])


def order_items(
    raw: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    at: datetime,
) -> tuple[DataFrame, list[DataFrame]]:
    """Items whose order, product and store are known, and one report per lookup."""
    ties = [F.col(c) for c in ("product_id", "seller_id", "price", "freight_value", "shipping_limit_date")]
    # Without hot orders the rows are dealt out once by order, to be reduced and to be looked up.
    dealt = not hot_keys(raw.select(F.coalesce(F.col("order_id"), F.lit("")).alias("code")), ["code"])
    rows = raw.repartition("order_id") if dealt else raw
    items = keep_first(rows, ["order_id", "order_item_id"], ties).withColumnsRenamed({
        "order_id": "order_code", "order_item_id": "line_number", "product_id": "product_code",
        "seller_id": "store_code",
    })
    # Narrower than its text, before the rows travel.
    items = items.withColumn("shipping_limit_date", parse_timestamp(F.col("shipping_limit_date")))
    lookups = [
        (table.select(F.col(id_), F.col(code).alias("code")), {code: "code"}, id_)
        for table, code, id_ in (
            (orders, "order_code", "order_id"),
            (products, "product_code", "product_id"),
            (stores, "store_code", "store_id"),
        )
    ]
    missed = F.col("order_id").isNull() | F.col("product_id").isNull() | F.col("store_id").isNull()
    items, reports = resolve_all(
        items, lookups, ["order_code", "line_number"],
        _in_order(missed, ["order_id", "line_number"]), dealt,
    )
    stamp = F.lit(at).cast("timestamp_ntz")
    named = number_stored(items, "order_item_id").select(
        "order_item_id",
        "order_id",
        "product_id",
        "store_id",
        "line_number",
        F.col("price").alias("unit_price"),
        "freight_value",
        "shipping_limit_date",
        F.lit(1).alias("quantity"),
        stamp.alias("created_at"),
        stamp.alias("ingested_at"),
    )
    return named, reports


def payments(
    raw: DataFrame, orders: DataFrame, at: datetime
) -> tuple[DataFrame, DataFrame]:
    """Payments whose order is known, and the report of the others."""
    ties = [F.col(c) for c in ("payment_type", "payment_installments", "payment_value")]
    first = keep_first(raw, ["order_id", "payment_sequential"], ties).withColumnRenamed(
        "order_id", "order_code"
    )
    codes = orders.select("order_id", F.col("order_code").alias("code"))
    found, (report,) = resolve_all(
        first, [(codes, {"order_code": "code"}, "order_id")], ["order_code", "payment_sequential"],
        _in_order(F.col("order_id").isNull(), ["order_id", "payment_sequential"]),
    )
    stamp = F.lit(at).cast("timestamp_ntz")
    named = number_stored(found, "payment_id").select(
        "payment_id",
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
        stamp.alias("created_at"),
        stamp.alias("ingested_at"),
    )
    return named, report
