"""Dense surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesloom.session import stored

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the lower 33 bits


def assign_surrogate_keys(df: DataFrame, name: str, order: list[Column], start: int = 1) -> DataFrame:
    """Number the rows start, start+1, ... in a total `order`, as the first column.

    The rows are range-partitioned by the order, each partition is numbered on its own and shifted by
    the sizes of those before it; `spark.sql.shuffle.partitions` says how many there are, and adaptive
    execution merges small ones. The partitioned rows are stored in the shared folder, so that all reads of
    them see the same partitions even after an executor is lost, and read the columns that they need.
    """
    return number_stored(store_in_order(df, order), name, start)


def store_in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows stored for `number_stored`, which may leave out those at the end of the order."""
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranges.withColumns({"_row": position, "_part": F.spark_partition_id()}), "numbered")


def number_stored(placed: DataFrame, name: str, start: int = 1) -> DataFrame:
    """Rows of `store_in_order` with their numbers as the first column."""
    # One row per partition: bounded by the partition count.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    # Also keeps the size of the compressed files from Spark, which would broadcast tables far too large for it.
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select(
        (F.col("_row") + F.col("_offset") + F.lit(start)).alias(name),
        *[c for c in placed.columns if c not in ("_row", "_part")],
    )


def continue_surrogate_keys(
    df: DataFrame, known: DataFrame, name: str, business: str, order: list[Column], start: int = 1
) -> DataFrame:
    """Rows with the key they had in `known` (`business`, `name`), and new ones numbered behind the largest key.

    `known` has one row for each business key. Known rows are neither sorted nor numbered: only new ones
    are, in a total `order`, so that a key never changes, whatever sorts in before it. A key whose row has
    gone is not given away again while `known` holds it. Rows without a business key are new each time.
    """
    found = df.join(known.select(business, name), business, "left")
    last = known.agg(F.max(name)).first()[0]
    fresh = found.where(F.col(name).isNull()).select(df.columns)
    numbered = assign_surrogate_keys(fresh, name, order, start if last is None else last + 1)
    return found.where(F.col(name).isNotNull()).select(name, *df.columns).unionByName(numbered)
