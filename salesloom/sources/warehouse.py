"""Loading Gold tables into the warehouse: reload of dimensions, upsert of facts, logs."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from salesloom.operators import keys
from salesloom.sources.schemas import QUALITY_LOG
from salesloom.sources.versions import LOAD_DAY, Load, Store

log = logging.getLogger(__name__)

DIMENSIONS = ["dim_date", "dim_customer", "dim_product", "dim_store", "dim_currency"]
FACT_KEYS = {
    "fact_sales": ["order_item_id"],
    "fact_weather_daily": ["date_key", "city", "state"],
    "fact_fx_rates": ["date_key", "base_currency_key", "quote_currency_key"],
    "fact_payments": ["order_id", "payment_sequential"],
}


def _place(spark: SparkSession, path: str) -> tuple[Store, str]:
    """Store and table of a path."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return Store(spark, folder), name


def reload_dimension(df: DataFrame, path: str, loaded_at: datetime) -> None:
    """Replace a dimension in a load of its own. Facts are not touched."""
    store, name = _place(df.sparkSession, path)
    load = store.load(loaded_at)
    load.replace(name, df)
    load.commit()


def reload_members(load: Load, name: str, members: DataFrame, business: str, surrogate: str) -> None:
    """Replace a dimension whose members keep the keys of all earlier loads.

    The keys are a table of the store, `<name>_keys`, which grows by the new members in the same load;
    members that leave the dimension stay in it, and get their old key when they come back.
    """
    keys_name = f"{name}_keys"
    if keys_name in load.tables:
        known = load.view().read(keys_name).select(business, surrogate)
    else:
        kind = members.schema[business].dataType
        known = load.spark.createDataFrame([], StructType().add(business, kind).add(surrogate, "long"))
    load.replace(name, keys.continue_surrogate_keys(members, known, surrogate, business, [F.col(business)]))
    new = load.view().read(name).select(business, surrogate).join(known, business, "left_anti")
    load.upsert(keys_name, new, [business])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A dimension or a fact as the latest load left it."""
    store, name = _place(spark, path)
    return store.read(name)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path).drop(LOAD_DAY)


def upsert_fact(
    source: DataFrame, path: str, keys: list[str], loaded_at: datetime, recency: list[Column] | None = None
) -> None:
    """Upsert one fact in a load of its own; see `versions.Load.upsert`."""
    store, name = _place(source.sparkSession, path)
    load = store.load(loaded_at)
    load.upsert(name, source, keys, recency)
    load.commit()


def load_all(
    spark: SparkSession, gold_path: str, warehouse_path: str, loaded_at: datetime
) -> list[str]:
    """Load every registered table that Gold has, in one load: readers see all of it or nothing.

    Gold is resolved once, so that the tables of one load belong together.
    """
    gold = Store(spark, gold_path).snapshot()
    load = Store(spark, warehouse_path).load(loaded_at)
    loaded = []
    for name in [*DIMENSIONS, *FACT_KEYS]:
        if name not in gold.tables:
            log.warning("skipping %s: not in Gold", name)
            continue
        if name in FACT_KEYS:
            load.upsert(name, gold.read(name), FACT_KEYS[name])
        else:
            load.replace(name, gold.read(name))
        loaded.append(name)
    if loaded:
        load.commit()
    return loaded


def loaded_between(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows of the load time range [start, end). Of a versioned fact, files of other days are not listed for reading."""
    if LOAD_DAY in df.columns:
        df = df.where(F.col(LOAD_DAY).between(F.lit(start.date()), F.lit(end.date())))
    return df.where((F.col("_loaded_at") >= F.lit(start)) & (F.col("_loaded_at") < F.lit(end)))


def as_log_rows(results: DataFrame, run_at: Column) -> DataFrame:
    """Check results in the shape of the quality log; one run has one `run_at`."""
    return results.select(
        F.uuid().alias("check_id"),
        run_at.cast("timestamp").alias("run_at"),
        "check_name",
        "table_name",
        F.col("category").alias("check_category"),
        "severity",
        "status",
        "expected_value",
        "actual_value",
        "rows_affected",
        "message",
        F.col("metadata").alias("check_metadata"),
    )


def append_quality_log(results: DataFrame, path: str, run_at: datetime) -> None:
    as_log_rows(results, F.lit(run_at)).write.mode("append").parquet(path)


def read_quality_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUALITY_LOG).parquet(path)
