"""Session defaults and the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Planning settings that change no result; `tune` applies them to a running session.
PLANNING = {
    # Split skewed join partitions even if that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile methods beyond this size; such stages run faster without fused code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

DEFAULTS = {
    **PLANNING,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python call site of every Column costs more than building the plan itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> None:
    """Apply the planning settings to a session that was built elsewhere."""
    for key, value in PLANNING.items():
        spark.conf.set(key, value)


def build_session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the defaults of this library. `master` is for local runs and tests only."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor reaches: `spark.checkpoint.dir`, else the context's checkpoint folder.

    Only a local master gets a temporary folder of its own; on a cluster the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="salesloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a new path of the shared folder and read from there: many readers build them once.

    The shuffle files that made them are removed as soon as they are written, not when the driver happens
    to collect its garbage. Columns without a type, which files cannot hold, are NULL again.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    untyped = {c: F.lit(None) for c, kind in df.dtypes if kind == "void"}
    held = df.drop(*untyped)
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        # The second version of the format writes numbers as differences, which take few bits in sorted rows.
        held.write.options(**{"compression": "zstd", "parquet.writer.version": "v2"}).parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before) if before else spark.conf.unset(_FREE_SHUFFLES)
    return spark.read.schema(held.schema).parquet(path).withColumns(untyped).select(df.columns)
