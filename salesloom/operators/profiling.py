"""Schema comparison and table profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, DateType, FractionalType, IntegralType, NumericType, StringType, TimestampNTZType,
    TimestampType,
)

# Type categories of an expected schema.
CATEGORIES = {
    "object": (StringType,),
    "int": (IntegralType,),
    "float": (FractionalType,),
    "bool": (BooleanType,),
    "datetime": (DateType, TimestampType, TimestampNTZType),
}


def schema_issues(df: DataFrame, expected: dict[str, str], max_null_rate: float = 0.5) -> DataFrame:
    """Issue texts: missing columns, wrong type categories, null rates above the maximum."""
    spark = df.sparkSession
    missing = [c for c in expected if c not in df.columns]
    present = {c: t for c, t in expected.items() if c in df.columns}
    static = [f"Missing columns: {missing}"] if missing else []
    for column, category in present.items():
        dtype = df.schema[column].dataType
        if not isinstance(dtype, CATEGORIES[category]):
            static.append(
                f"Column '{column}': expected dtype category '{category}', got '{dtype.simpleString()}'"
            )
    issues = spark.createDataFrame([(s,) for s in static], "issue string")
    if not present:
        return issues
    rates = df.agg(
        *[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in present]
    )
    limit = f"{max_null_rate:.1%}"
    texts = [
        F.when(
            F.col(c) > max_null_rate,
            F.format_string(f"Column '{c}': null rate %.1f%% exceeds threshold {limit.replace('%', '%%')}", F.col(c) * 100),
        )
        for c in present
    ]
    high = rates.select(F.explode(F.array_compact(F.array(*texts))).alias("issue"))
    return issues.unionByName(high)


def profile(df: DataFrame, name: str) -> DataFrame:
    """Long table of metrics: rows, columns, duplicate rows, null percentage, numeric minimum and maximum."""
    rows = F.count(F.lit(1)).alias("rows")
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    bounds = [
        f(c).cast("double").alias(f"{n}_{c}") for c in numeric for n, f in (("min", F.min), ("max", F.max))
    ]
    measured = df.agg(rows, *nulls, *bounds)

    def metric(column: str | None, label: str, value: Column) -> Column:
        return F.struct(
            F.lit(name).alias("table_name"),
            F.lit(column).cast("string").alias("column_name"),
            F.lit(label).alias("metric"),
            value.cast("double").alias("value"),
        )

    entries = [metric(None, "row_count", F.col("rows")), metric(None, "col_count", F.lit(len(df.columns)))]
    for c in df.columns:
        percent = F.round(F.try_divide(F.col(f"nulls_{c}") * 100.0, F.col("rows")), 2)
        entries.append(metric(c, "null_pct", F.coalesce(percent, F.lit(0.0))))
    for c in numeric:
        entries += [metric(c, n, F.col(f"{n}_{c}")) for n in ("min", "max")]
    long = measured.select(F.inline(F.array(*entries)))

    # Equal rows are counted per distinct row, which is aggregated before the shuffle.
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    duplicates = distinct.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n"))
    return reduce(
        DataFrame.unionByName,
        [long, duplicates.select(F.inline(F.array(metric(None, "duplicate_rows", F.col("n")))))],
    )
