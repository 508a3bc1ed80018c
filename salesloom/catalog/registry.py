"""Registry of queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesloom.catalog.sql import with_views
from salesloom.catalog.tables import Tables
from salesloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of `Tables` under its own name, with the equivalent SQL if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return build

    return register
