"""Process only the files that arrived since the last run, with the same rules as a full load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesloom.operators.contracts import accepted, rejected


def stream_parquet(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Stream of the Parquet files of a folder, with the schema of those already there."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def clean_new_files(
    arriving: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    silver_path: str,
    quarantine_path: str,
    checkpoint_path: str,
) -> None:
    """Clean everything that has arrived and stop. A batch that is repeated replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        annotated = clean(batch).persist()  # cleaned once for both outcomes
        for rows, path in ((accepted(annotated), silver_path), (rejected(annotated), quarantine_path)):
            rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        annotated.unpersist()

    query = (
        arriving.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
