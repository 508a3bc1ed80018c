"""Putting one-row results beside each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def side_by_side(*parts: DataFrame) -> DataFrame:
    """One row with the columns of several one-row results, by a union instead of a join."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    columns = [c for part in parts for c in part.columns]
    return union.agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])
