"""Database tables through Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Full table, read by parallel ranges of a numeric, date or timestamp column."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        lower, upper = bounds
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=partitions,
        )
    return reader.load()


def reload_table(df: DataFrame, url: str, table: str, batch_rows: int = 10_000, **options: str):
    """Empty a table and load it again, keeping its definition."""
    df.write.format("jdbc").mode("overwrite").options(
        url=url, dbtable=table, truncate="true", batchsize=batch_rows, **options
    ).save()


def append_table(df: DataFrame, url: str, table: str, batch_rows: int = 10_000, **options: str):
    """Append rows to a table."""
    df.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=batch_rows, **options
    ).save()
