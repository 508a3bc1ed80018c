"""Column contracts: declared types, nullability and checks, tested in one pass over the rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, FractionalType, StringType

from salesloom.functions.fixed import ORDER_STATUSES, PAYMENT_TYPES
from salesloom.functions.numbers import MONEY

REASON = "quarantine_reason"


@dataclass(frozen=True)
class Check:
    """A named test of a non-null value."""

    name: str
    test: Callable[[Column], Column]


@dataclass(frozen=True)
class Field:
    """A contract column. Values are cast to `dtype`; one that cannot be cast, or only to another value, breaks the contract."""

    name: str
    dtype: str
    nullable: bool = False
    checks: tuple[Check, ...] = ()


Contract = list[Field]


def greater_than(bound) -> Check:
    return Check(f"greater_than({bound})", lambda c: c > bound)


def at_least(bound) -> Check:
    return Check(f"greater_than_or_equal_to({bound})", lambda c: c >= bound)


def at_most(bound) -> Check:
    return Check(f"less_than_or_equal_to({bound})", lambda c: c <= bound)


def one_of(values: list[str]) -> Check:
    return Check("isin", lambda c: c.isin(values))


def length_is(n: int) -> Check:
    return Check(f"length({n})", lambda c: F.length(c) == n)


NOT_EMPTY = Check("not_empty", lambda c: F.length(c) > 0)

ORDERS: Contract = [
    Field("order_id", "bigint"),
    Field("order_code", "string", checks=(NOT_EMPTY,)),
    Field("customer_id", "bigint"),
    Field("order_status", "string", checks=(one_of(ORDER_STATUSES),)),
    Field("order_date", "date"),
    Field("order_timestamp", "timestamp_ntz", nullable=True),
    Field("approved_at", "timestamp_ntz", nullable=True),
    Field("estimated_delivery", "date", nullable=True),
    Field("actual_delivery", "date", nullable=True),
    Field("delivery_days_actual", "bigint", nullable=True, checks=(at_least(0),)),
    Field("delivery_days_estimated", "bigint", nullable=True, checks=(at_least(0),)),
    Field("source_channel", "string", checks=(NOT_EMPTY,)),
    Field("currency_code", "string", checks=(length_is(3),)),
    Field("ingested_at", "timestamp_ntz"),
]

ORDER_ITEMS: Contract = [
    Field("order_item_id", "bigint"),
    Field("order_id", "bigint"),
    Field("product_id", "bigint"),
    Field("store_id", "bigint"),
    Field("line_number", "bigint", checks=(at_least(1),)),
    Field("unit_price", MONEY, checks=(greater_than(0),)),
    Field("freight_value", MONEY, checks=(at_least(0),)),
    Field("quantity", "bigint", checks=(at_least(1),)),
    Field("ingested_at", "timestamp_ntz"),
]

WEATHER: Contract = [
    Field("city", "string", checks=(NOT_EMPTY,)),
    Field("state", "string", checks=(length_is(2),)),
    Field("date", "date"),
    Field("temp_max", "decimal(5,1)", nullable=True, checks=(at_least(-50), at_most(60))),
    Field("temp_min", "decimal(5,1)", nullable=True, checks=(at_least(-50), at_most(60))),
    Field("precipitation", "decimal(7,1)", nullable=True, checks=(at_least(0),)),
    Field("windspeed", "decimal(6,1)", nullable=True, checks=(at_least(0),)),
    Field("weathercode", "bigint", nullable=True, checks=(at_least(0), at_most(99))),
]

PAYMENTS: Contract = [
    Field("order_id", "bigint"),
    Field("payment_sequential", "bigint", checks=(at_least(1),)),
    Field("payment_type", "string", checks=(one_of(PAYMENT_TYPES),)),
    Field("payment_installments", "bigint", checks=(at_least(0),)),
    Field("payment_value", MONEY, checks=(greater_than(0),)),
    Field("ingested_at", "timestamp_ntz"),
]

FX: Contract = [
    Field("date", "date"),
    Field("base_currency", "string", checks=(length_is(3),)),
    Field("quote_currency", "string", checks=(length_is(3),)),
    Field("rate", "decimal(16,6)", checks=(greater_than(0),)),
]


def _text(rule: str, value: Column, quoted: bool) -> Column:
    """Text of a broken rule and the value that breaks it, which is never NULL."""
    if quoted:
        return F.concat(F.lit(f"{rule}'"), value, F.lit("'"))
    return F.concat(F.lit(rule), value.cast("string"))


@dataclass
class _Rule:
    """Where a contract rule is broken, and the text that says so."""

    broken: Column
    text: Column


def _rules(field: Field, raw: Column, value: Column, raw_type: DataType) -> list[_Rule]:
    found = []
    if not _always_casts(raw_type, field.dtype):
        text = _text(f"{field.name}[coerce_dtype('{field.dtype}')]=", raw, isinstance(raw_type, StringType))
        found.append(_Rule(raw.isNotNull() & (value.isNull() | _changed(field, raw, raw_type)), text))
    if not field.nullable:
        found.append(_Rule(raw.isNull(), F.lit(f"{field.name}[not_nullable]=None")))
    for check in field.checks:
        # A NULL value makes the test unknown, and an unknown test does not break the rule.
        broken = F.coalesce(~check.test(value), F.lit(False))
        text = _text(f"{field.name}[{check.name}]=", value, field.dtype == "string")
        found.append(_Rule(broken, text))
    return found


def _changed(field: Field, raw: Column, raw_type: DataType) -> Column:
    """Whether a cast to a whole number cuts a fraction off."""
    if field.dtype != "bigint" or not isinstance(raw_type, FractionalType):
        return F.lit(False)
    return F.coalesce(raw != F.floor(raw), F.lit(False))


def _always_casts(have: DataType, want: str) -> bool:
    """Whether every value of a type has one in the wanted type."""
    name = have.simpleString()
    return want == "string" or name == want or (want == "bigint" and name in ("int", "smallint"))


def annotate(df: DataFrame, contract: Contract, first_reason: Column | None = None) -> DataFrame:
    """Contract columns with their declared types plus `quarantine_reason`, NULL for a valid row.

    `first_reason` is the outcome of rules that run before the contract: where it is not NULL it
    is the only reason. Otherwise every broken contract rule is listed. Columns outside the
    contract are kept. A missing contract column raises. Texts are only built for broken rows.
    """
    missing = [f.name for f in contract if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing contract columns: {missing}")
    rules, typed = [], {}
    for field in contract:
        raw, raw_type = F.col(field.name), df.schema[field.name].dataType
        same = raw_type.simpleString() == field.dtype
        typed[field.name] = raw if same else raw.try_cast(field.dtype)
        rules += _rules(field, raw, typed[field.name], raw_type)
    any_broken = reduce(Column.__or__, [r.broken for r in rules])
    texts = F.concat_ws(" | ", *[F.when(r.broken, r.text) for r in rules])
    reason = F.when(any_broken, texts)
    if first_reason is not None:
        reason = F.coalesce(first_reason, reason)
    columns = [typed[c].alias(c) if c in typed else F.col(c) for c in df.columns if c != REASON]
    return df.select(*columns, reason.alias(REASON))


def accepted(annotated: DataFrame) -> DataFrame:
    """Valid rows."""
    return annotated.where(F.col(REASON).isNull()).drop(REASON)


def rejected(annotated: DataFrame) -> DataFrame:
    """Invalid rows with their reason."""
    return annotated.where(F.col(REASON).isNotNull())
