"""Keeping one row per key in a stated order.

`row_number() = 1` is planned with a group limit before the shuffle, so each task sends at most
one row per key and a key with very many copies does not pile up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. `order` must leave no ties."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key. `order` is ascending and must leave no ties."""
    return keep_first(df, keys, [c.desc_nulls_last() for c in order])
