"""Bronze, Silver, quarantine and Gold tables as Parquet folders."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from salesloom.sources import paths
from salesloom.sources.history import reason_of
from salesloom.sources.schemas import LINE_BREAKS
from salesloom.sources.versions import Store

log = logging.getLogger(__name__)

SNAPSHOT = "snapshot_date="


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files with a header under a declared schema; a missing path raises.

    Only files whose schema declares line breaks inside values are read whole by one task each.
    """
    return spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=schema in LINE_BREAKS)


def write_snapshot(df: DataFrame, path: str, day: date, force: bool = False) -> str:
    """Write the snapshot of one day; an existing complete one is kept unless `force`."""
    target = f"{path}/{SNAPSHOT}{day.isoformat()}"
    if not force and paths.exists(df.sparkSession, f"{target}/_SUCCESS"):
        return target
    paths.publish(df, target)
    return target


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot below `path`; only its own files are listed and read."""
    complete = [
        name
        for name in paths.child_folders(spark, path)
        if name.startswith(SNAPSHOT)
        and ".staging-" not in name
        and ".previous-" not in name
        and paths.exists(spark, f"{path}/{name}/_SUCCESS")
    ]
    if not complete:
        raise FileNotFoundError(f"no snapshot below {path}")
    return spark.read.parquet(f"{path}/{complete[-1]}")


def snapshot_csv_files(
    spark: SparkSession, csv_folder: str, schemas: dict[str, str], path: str, day: date
) -> DataFrame:
    """Snapshot CSV files by name; an absent file counts 0 rows and writes nothing."""
    counts = None
    for name, schema in schemas.items():
        source = f"{csv_folder}/{name}"
        if paths.exists(spark, source):
            write_snapshot(read_csv(spark, source, schema), f"{path}/{name}", day, force=True)
            counted = latest_snapshot(spark, f"{path}/{name}")
        else:
            counted = spark.createDataFrame([], schema)
        row = counted.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        counts = row if counts is None else counts.unionByName(row)
    return counts


def snapshot_tables(
    tables: dict[str, DataFrame], path: str, day: date, force: bool = False, at_once: int = 4
) -> dict[str, str | None]:
    """Snapshot every table, some at once; NULL for each that succeeded, else why it failed.

    Each table is written by a driver thread with a job group and a scheduler pool of its own, so that
    its jobs can be told apart and cancelled, share the cluster fairly where `spark.scheduler.mode` is
    FAIR, and fail alone.
    """
    def write(name: str) -> str | None:
        context = tables[name].sparkSession.sparkContext
        context.setJobGroup(f"snapshot {name}", f"snapshot of {name}", interruptOnCancel=True)
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            write_snapshot(tables[name], f"{path}/{name}", day, force)
        except Exception as error:
            log.exception("snapshot of %s failed", name)
            return reason_of(error)
        finally:
            for key in ("spark.jobGroup.id", "spark.job.description", "spark.scheduler.pool"):
                context.setLocalProperty(key, None)
        return None

    if not tables:
        return {}
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        # Each thread starts with a copy of the caller's local properties; threads must not share one copy.
        running = {name: pool.submit(inheritable_thread_target(df.sparkSession)(write), name) for name, df in tables.items()}
        return {name: future.result() for name, future in running.items()}


def write_silver(df: DataFrame, path: str, day: date) -> None:
    """Write the Silver table of one day, replacing that day only."""
    write_snapshot(df, path, day, force=True)


def write_quarantine(rejected: DataFrame, path: str, transform_name: str, at: datetime) -> None:
    """Append rejected rows with the time of rejection, one folder per transform.

    Rejections keep their own columns, so each transform has a table of its own. Without a
    rejected row nothing is written.
    """
    if rejected.isEmpty():
        return
    (
        rejected.withColumn("quarantined_at", F.lit(at.isoformat()))
        .write.mode("append")
        .parquet(f"{path}/transform_name={transform_name}")
    )


def read_quarantine(spark: SparkSession, path: str, transform_name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/transform_name={transform_name}").withColumn(
        "transform_name", F.lit(transform_name)
    )


def write_gold(tables: dict[str, DataFrame], path: str, at: datetime) -> None:
    """Replace the current state of Gold tables, all in one step; readers see the old or the new ones."""
    if not tables:
        return
    load = Store(next(iter(tables.values())).sparkSession, path).load(at)
    for name, df in tables.items():
        load.replace(name, df, stamp=False)
    load.commit()


def read_gold(spark: SparkSession, path: str, name: str) -> DataFrame:
    return Store(spark, path).read(name)


def publish_silver(
    annotated: DataFrame,
    silver_path: str,
    quarantine_path: str,
    name: str,
    day: date,
    at: datetime,
    skip_empty: bool = False,
) -> None:
    """Split an annotated table into the Silver table of the day and the quarantine.

    The annotated rows are written once, split by outcome, so the joins behind them run once. With
    `skip_empty`, as for feeds that delivered nothing, no rows at all write nothing; a table whose
    rows are all rejected is written empty.
    """
    spark = annotated.sparkSession
    staging = f"{silver_path}/_annotated-{day.isoformat()}"
    paths.delete(spark, staging)
    annotated.withColumn("_rejected", F.col("quarantine_reason").isNotNull()).write.partitionBy(
        "_rejected"
    ).parquet(staging)
    outcome = StructField("_rejected", BooleanType())
    rows = spark.read.schema(StructType([*annotated.schema.fields, outcome])).parquet(staging)
    if not (skip_empty and rows.isEmpty()):
        accepted = rows.where(~F.col("_rejected")).drop("_rejected", "quarantine_reason")
        write_silver(accepted, silver_path, day)
        write_quarantine(rows.where("_rejected").drop("_rejected"), quarantine_path, name, at)
    paths.delete(spark, staging)
