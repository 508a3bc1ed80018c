"""Stages of a run, each recorded with its outcome, rows and wall clock, whether it ends well or not."""

from __future__ import annotations

import logging
import re
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesloom.sources.schemas import RUN_HISTORY

log = logging.getLogger(__name__)

_RAISED = re.compile(r"\[USER_RAISED_EXCEPTION\] (.*?)(?: SQLSTATE: \w+)?$", re.MULTILINE)


def reason_of(error: Exception) -> str:
    """The message of a rule that failed the stage, or the first line of any other error."""
    text = str(error)
    raised = _RAISED.search(text)
    return raised[1] if raised else (text.splitlines() or [type(error).__name__])[0][:500]


def run_stage(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None],
    path: str, run_id: str, stage: str,
) -> str:
    """Write `transform(source)` and append one row to the run history at `path`; 'success' or 'failed'.

    rows_processed are the rows written, observed while they were, or for a stage that failed the rows of
    its source, as what single tasks had seen differs from run to run (NULL if the source cannot be read
    either). A failure is logged and recorded, not raised: the caller decides what depends on the stage.
    """
    spark = source.sparkSession
    started, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.perf_counter()
    status, error = "success", None
    try:
        seen = Observation()
        write(transform(source).observe(seen, F.count(F.lit(1)).alias("rows")))
        rows = seen.get["rows"]
    except Exception as failure:
        log.exception("stage %s failed", stage)
        status, error = "failed", reason_of(failure)
        try:
            rows = source.count()
        except Exception:
            rows = None
    row = (run_id, stage, status, rows, time.perf_counter() - clock, started, error)
    spark.createDataFrame([row], RUN_HISTORY).coalesce(1).write.mode("append").parquet(path)
    return status


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_HISTORY).parquet(path)
