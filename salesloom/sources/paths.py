"""Small helpers over the Hadoop file system, so that paths work on any store Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.exists(hadoop_path)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders below `path`, sorted; empty if the path is absent."""
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files in `path`, sorted; empty if the path is absent."""
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isFile()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hadoop_path = _path(spark, path)
    out = fs.create(hadoop_path, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def name_once(spark: SparkSession, source: str, target: str) -> bool:
    """Give a file its final name in one step; False if the name is taken, which leaves both as they are."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    origin = hadoop.Path(source)
    context = hadoop.FileContext.getFileContext(origin.toUri(), spark._jsc.hadoopConfiguration()) \
        if origin.toUri().getScheme() else hadoop.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    try:
        context.rename(origin, hadoop.Path(target), options)
    except Exception as error:
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _path(spark, path)
    fs.delete(hadoop_path, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, hadoop_source = _path(spark, source)
    if not fs.rename(hadoop_source, _path(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a complete new version beside `path`, then swap it in.

    A failed write leaves the old version; a failed swap leaves the new one beside the old one.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    staging, previous = f"{path}.staging-{mark}", f"{path}.previous-{mark}"
    df.write.partitionBy(*(partition_by or [])).parquet(staging)
    replaced = exists(spark, path)
    if replaced:
        rename(spark, path, previous)
    rename(spark, staging, path)
    if replaced:
        delete(spark, previous)
