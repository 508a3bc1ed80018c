"""Quality checks over fact tables: declared once per table, computed with as few scans as possible.

All scalar checks of a table (row count, nulls, ranges, column order) are one aggregate. Uniqueness
and referential integrity shuffle on their own keys. Every check yields one result row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.functions.fixed import SEVERITY_RANK
from salesloom.functions.text import json_text
from salesloom.operators.lookups import count_orphans
from salesloom.sources.warehouse import append_quality_log, read_quality_log

RESULT = [
    "check_name", "table_name", "category", "severity", "status", "expected_value",
    "actual_value", "rows_affected", "message", "metadata",
]


def _thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def _number(value) -> str:
    return f"{value:,}" if isinstance(value, int) else str(value)


@dataclass(frozen=True)
class RowCount:
    """At least `min_rows` rows."""

    min_rows: int
    severity: str = "CRITICAL"
    label: str = "row_count_threshold"
    category = "row_count"

    def name(self) -> str:
        return self.label

    def violations(self) -> Column:
        return F.greatest(F.lit(0), F.lit(self.min_rows) - F.count(F.lit(1)))

    def observed(self) -> Column:
        return F.count(F.lit(1))

    def texts(self, seen: Column, bad: Column) -> tuple[Column, Column, Column]:
        low = _number(self.min_rows)
        return (
            F.lit(f">= {low}"),
            seen.cast("string"),
            F.when(bad == 0, F.concat(_thousands(seen), F.lit(f" rows, at least {low} expected")))
            .otherwise(F.concat(_thousands(seen), F.lit(f" rows, fewer than {low}"))),
        )

    def details(self) -> dict[str, Column]:
        return {"min_rows": F.lit(self.min_rows)}


@dataclass(frozen=True)
class NotNull:
    """No NULL in a column."""

    column: str
    severity: str = "CRITICAL"
    category = "null_check"

    def name(self) -> str:
        return f"no_nulls.{self.column}"

    def violations(self) -> Column:
        return F.count_if(F.col(self.column).isNull())

    observed = violations

    def texts(self, seen: Column, bad: Column) -> tuple[Column, Column, Column]:
        return (
            F.lit("0 NULLs"),
            F.concat(seen.cast("string"), F.lit(" NULL(s)")),
            F.when(bad == 0, F.lit(f"'{self.column}' is always filled"))
            .otherwise(F.concat(_thousands(bad), F.lit(f" rows lack '{self.column}'"))),
        )

    def details(self) -> dict[str, Column]:
        return {"column": F.lit(self.column)}


@dataclass(frozen=True)
class InRange:
    """Values within bounds; a bound is inclusive unless `strict`. NULLs pass if `allow_null`."""

    column: str
    low: float | None = None
    high: float | None = None
    severity: str = "CRITICAL"
    strict: bool = False
    allow_null: bool = True
    label: str | None = None
    category = "range"

    def name(self) -> str:
        return self.label or f"value_range.{self.column}"

    def _bounds(self) -> str:
        more, less = (">", "<") if self.strict else (">=", "<=")
        shown = [f"{more} {self.low}"] if self.low is not None else []
        shown += [f"{less} {self.high}"] if self.high is not None else []
        return " and ".join(shown) or "unbounded"

    def violations(self) -> Column:
        value = F.col(self.column)
        outside = value.isNull() if not self.allow_null else F.lit(False)
        if self.low is not None:
            outside = outside | (value <= self.low if self.strict else value < self.low)
        if self.high is not None:
            outside = outside | (value >= self.high if self.strict else value > self.high)
        return F.count_if(outside)

    observed = violations

    def texts(self, seen: Column, bad: Column) -> tuple[Column, Column, Column]:
        bounds = self._bounds()
        return (
            F.lit(bounds),
            F.concat(seen.cast("string"), F.lit(" out-of-range")),
            F.when(bad == 0, F.lit(f"'{self.column}' stays in [{bounds}]"))
            .otherwise(
                F.concat(
                    F.lit(f"'{self.column}' leaves [{bounds}] in "),
                    _thousands(bad),
                    F.lit(" rows"),
                )
            ),
        )

    def details(self) -> dict[str, Column]:
        return {"column": F.lit(self.column), "bounds": F.lit(self._bounds())}


@dataclass(frozen=True)
class NotBelow:
    """`upper` is never below `lower`. Rows with a NULL pass if `allow_null`."""

    upper: str
    lower: str
    severity: str = "WARNING"
    allow_null: bool = True
    category = "range"

    def name(self) -> str:
        return f"col_order.{self.upper}>={self.lower}"

    def violations(self) -> Column:
        upper, lower = F.col(self.upper), F.col(self.lower)
        bad = upper < lower
        return F.count_if(bad if self.allow_null else F.coalesce(bad, F.lit(True)))

    observed = violations

    def texts(self, seen: Column, bad: Column) -> tuple[Column, Column, Column]:
        a, b = self.upper, self.lower
        return (
            F.lit(f"{a} >= {b}"),
            F.concat(seen.cast("string"), F.lit(" violation(s)")),
            F.when(bad == 0, F.lit(f"'{b}' never exceeds '{a}'"))
            .otherwise(F.concat(_thousands(bad), F.lit(f" row(s) where '{a}' < '{b}'"))),
        )

    def details(self) -> dict[str, Column]:
        return {"col_a": F.lit(self.upper), "col_b": F.lit(self.lower)}


@dataclass(frozen=True)
class Unique:
    """No key combination occurs twice; NULLs of a key are equal to each other."""

    columns: tuple[str, ...]
    severity: str = "CRITICAL"
    category = "uniqueness"

    def name(self) -> str:
        return f"uniqueness.{'+'.join(self.columns)}"

    def texts(self, seen: Column, bad: Column) -> tuple[Column, Column, Column]:
        keys = ", ".join(self.columns)
        return (
            F.lit("0 duplicate groups"),
            F.concat(seen.cast("string"), F.lit(" duplicate group(s)")),
            F.when(bad == 0, F.lit(f"each ({keys}) comes once"))
            .otherwise(F.concat(_thousands(bad), F.lit(f" values of ({keys}) come more than once"))),
        )

    def details(self) -> dict[str, Column]:
        return {"key_columns": F.array(*[F.lit(c) for c in self.columns])}


@dataclass(frozen=True)
class References:
    """Every non-null foreign key has a dimension row."""

    fk: str
    dim: DataFrame = field(compare=False)
    dim_name: str
    pk: str
    severity: str = "WARNING"
    category = "referential_integrity"

    def name(self) -> str:
        return f"ri.{self.fk}->{self.dim_name}"

    def texts(self, seen: Column, bad: Column) -> tuple[Column, Column, Column]:
        target = f"{self.dim_name}.{self.pk}"
        return (
            F.lit("0 orphan FK values"),
            F.concat(seen.cast("string"), F.lit(" orphan(s)")),
            F.when(bad == 0, F.lit(f"every '{self.fk}' is found in '{target}'"))
            .otherwise(
                F.concat(
                    _thousands(bad), F.lit(f" rows hold a '{self.fk}' unknown to '{target}'")
                )
            ),
        )

    def details(self) -> dict[str, Column]:
        return {"fk_column": F.lit(self.fk), "dim_table": F.lit(self.dim_name)}


def _result(table: str, check, seen: Column, bad: Column) -> Column:
    expected, actual, message = check.texts(seen, bad)
    values = [
        F.lit(f"{table}.{check.name()}"),
        F.lit(table),
        F.lit(check.category),
        F.lit(check.severity),
        F.when(bad == 0, "PASS").otherwise("FAIL"),
        expected,
        actual,
        bad.cast("long"),
        message,
        json_text(**check.details(), violations=bad.cast("long")),
    ]
    return F.struct(*[v.alias(n) for v, n in zip(values, RESULT)])


def run_checks(df: DataFrame, table: str, checks: list) -> DataFrame:
    """One result row per check."""
    scalar = [c for c in checks if hasattr(c, "violations")]
    parts = []
    if scalar:
        measured = df.agg(
            *[c.violations().alias(f"bad_{i}") for i, c in enumerate(scalar)],
            *[c.observed().alias(f"seen_{i}") for i, c in enumerate(scalar)],
        )
        rows = [
            _result(table, c, F.col(f"seen_{i}"), F.col(f"bad_{i}")) for i, c in enumerate(scalar)
        ]
        parts.append(measured.select(F.inline(F.array(*rows))))
    for check in checks:
        if isinstance(check, Unique):
            groups = df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_rows"))
            measured = groups.where("_rows > 1").agg(F.count(F.lit(1)).alias("bad"))
        elif isinstance(check, References):
            measured = count_orphans(df, check.dim, check.fk, check.pk, nulls_count=False)
            measured = measured.withColumnRenamed("orphan_count", "bad")
        else:
            continue
        parts.append(
            measured.select(F.inline(F.array(_result(table, check, F.col("bad"), F.col("bad")))))
        )
    return reduce(DataFrame.unionByName, parts)


def fact_sales_checks(dim_date: DataFrame, dim_customer: DataFrame, min_rows=100_000) -> list:
    return [
        RowCount(min_rows),
        *[NotNull(c) for c in ("order_item_id", "order_id", "date_key")],
        Unique(("order_item_id",)),
        InRange("unit_price", low=0, strict=True, label="range.unit_price_gt_0"),
        InRange("freight_value", low=0, severity="WARNING", label="range.freight_value_gte_0"),
        InRange("quantity", low=1, severity="WARNING", label="range.quantity_gte_1"),
        References("date_key", dim_date, "dim_date", "date_key"),
        References("customer_key", dim_customer, "dim_customer", "customer_key", severity="INFO"),
    ]


def fact_weather_checks(dim_date: DataFrame, min_rows=1_000) -> list:
    return [
        RowCount(min_rows),
        *[NotNull(c) for c in ("date_key", "city", "state")],
        Unique(("date_key", "city", "state")),
        NotBelow("temp_max", "temp_min"),
        InRange("weathercode", low=0, high=99, severity="WARNING", label="range.weathercode_0_99"),
        References("date_key", dim_date, "dim_date", "date_key"),
    ]


def fact_fx_checks(dim_date: DataFrame, min_rows=500) -> list:
    return [
        RowCount(min_rows),
        *[NotNull(c) for c in ("date_key", "base_currency", "quote_currency", "rate")],
        Unique(("date_key", "base_currency", "quote_currency")),
        InRange("rate", low=0, strict=True, label="range.rate_gt_0"),
        References("date_key", dim_date, "dim_date", "date_key"),
    ]


def fact_payments_checks(dim_date: DataFrame, dim_customer: DataFrame, min_rows=1) -> list:
    return [
        RowCount(min_rows),
        *[NotNull(c) for c in ("order_id", "payment_sequential")],
        Unique(("order_id", "payment_sequential")),
        InRange("payment_value", low=0, strict=True, label="range.payment_value_gt_0"),
        References("date_key", dim_date, "dim_date", "date_key"),
        References("customer_key", dim_customer, "dim_customer", "customer_key", severity="INFO"),
    ]


def summarize_results(results: DataFrame) -> DataFrame:
    """Passed, failed, and failed by severity."""
    failed = F.col("status") == "FAIL"
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~failed).alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count_if(failed & (F.col("severity") == "WARNING")).alias("failed_warning"),
        F.count_if(failed & (F.col("severity") == "CRITICAL")).alias("failed_critical"),
    )


def halt_decision(results: DataFrame, halt_on: str = "CRITICAL") -> DataFrame:
    """One row: whether any failed check is at or above the threshold severity."""
    threshold = SEVERITY_RANK[halt_on]
    rank = F.coalesce(
        *[F.when(F.col("severity") == s, F.lit(r)) for s, r in SEVERITY_RANK.items()], F.lit(0)
    )
    blocking = (F.col("status") == "FAIL") & (rank >= threshold)
    return results.agg(
        F.lit(halt_on).alias("halt_on"),
        F.count_if(blocking).alias("blocking_failures"),
        (F.count_if(blocking) > 0).alias("should_halt"),
    )


def latest_run(quality_log: DataFrame) -> DataFrame:
    """Results of the latest run by severity and status."""
    last = quality_log.agg(F.max("run_at").alias("run_at"))
    # One row.
    return (
        quality_log.join(F.broadcast(last), "run_at")
        .groupBy("severity", "status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def run_lifecycle(results: DataFrame, log_path: str, run_at: datetime, halt_on: str = "CRITICAL") -> bool:
    """Append the results to the log, then decide whether to halt; a halting run is logged too.

    The decision reads the logged rows, so the checks are computed once.
    """
    append_quality_log(results, log_path, run_at)
    logged = read_quality_log(results.sparkSession, log_path).where(F.col("run_at") == F.lit(run_at))
    return halt_decision(logged, halt_on).first()["should_halt"]
