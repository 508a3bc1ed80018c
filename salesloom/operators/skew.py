"""Joins in which a few keys hold a large part of the rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

TRACKED = 32  # counters for each shuffle partition


def _mark(columns: list[str]) -> Column:
    return F.xxhash64(*columns)


def hot_keys(df: DataFrame, keys: list[str]) -> dict[int, int]:
    """Hashes of the keys with more rows than half a shuffle partition, and how many salts each needs.

    One pass over the key columns: tasks keep a bounded number of counters, which are merged. At most two
    keys for each partition can have so many rows, whatever the size of the table. A counter may
    overstate, and two keys may share a hash; then a key gets salts that it did not need.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = df.dropna(subset=keys).select(_mark(keys).alias("_mark"))
    row = marked.agg(
        F.count(F.lit(1)).alias("total"),
        F.call_function("approx_top_k", "_mark", F.lit(2 * parts), F.lit(TRACKED * parts)).alias("top")).first()
    share = max(1.0, row["total"] / (2 * parts))
    return {item["item"]: min(2 * parts, ceil(item["count"] / share)) + 1
            for item in row["top"] or [] if item["count"] > share}


def join(
    rows: DataFrame, table: DataFrame, keys: list[str], hot: dict[int, int], spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """Join of `rows` to `table` on equal keys; rows of hot keys are spread, and only their partners copied.

    `hot` comes from `hot_keys` over `rows` or over the table they were made of; without hot keys this is
    a plain join. `spread_by` tells the rows of one key apart. `how` is inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread the rows of a {how} join")
    if not hot:
        return rows.join(table, keys, how)
    # Two entries for each shuffle partition at most.
    salts = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    count = F.coalesce(F.element_at(salts, _mark(keys)), F.lit(1))
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), count).cast("int"))
    right = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), count - 1)))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
