"""Bronze to Silver: ordered rules, the first broken one being the reason, then the contract.

Every function returns all rows, annotated with `quarantine_reason`. Split them with
`contracts.accepted` and `contracts.rejected`, or write both with `lake.publish_silver`.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.functions.dates import parse_date, parse_timestamp, strict_timestamp
from salesloom.functions.fixed import DROP_WARNING_PCT, ORDER_STATUSES
from salesloom.functions.numbers import is_fractional, is_false_or_null, parse_number, whole_or_null
from salesloom.functions.text import lower_trim
from salesloom.operators import contracts
from salesloom.operators.contracts import REASON
from salesloom.operators.dedup import keep_last
from salesloom.operators.timeseries import fill_calendar

# Order columns parsed tolerantly when they arrive as text.
TIMESTAMPS = ["order_timestamp", "approved_at", "estimated_delivery", "actual_delivery", "ingested_at"]


def _first_of(*rules: tuple[Column, str | Column]) -> Column:
    """Reason of the first rule that holds, NULL when none does. An unknown predicate does not hold."""
    return F.coalesce(
        *[F.when(broken, F.lit(text) if isinstance(text, str) else text) for broken, text in rules]
    )


def clean_orders(orders: DataFrame) -> DataFrame:
    """Canceled, undated, customerless and unknown-status orders are rejected, then the contract.

    Text dates are parsed tolerantly but for `order_date`: one that does not parse fails the job.
    """
    status = F.col("order_status")
    reason = _first_of(
        (status == "canceled", "canceled order excluded from Silver"),
        (F.col("order_date").isNull(), "null order_date"),
        (F.col("customer_id").isNull(), "null customer_id"),
        (
            is_false_or_null(status.isin(ORDER_STATUSES)),
            F.concat(F.lit("unknown order_status: "), F.coalesce(status, F.lit("None"))),
        ),
    )
    types = dict(orders.dtypes)
    parsed = {c: parse_timestamp(F.col(c)) for c in TIMESTAMPS if types.get(c) == "string"}
    if types.get("order_date") == "string":
        parsed["order_date"] = strict_timestamp(F.col("order_date")).cast("date")
    return contracts.annotate(orders.withColumns(parsed), contracts.ORDERS, reason)


def clean_order_items(items: DataFrame, silver_orders: DataFrame) -> DataFrame:
    """Items without a Silver order or price are rejected; freight and quantity get defaults.

    The order lookup is a join, so the set of order ids never leaves the executors.
    """
    known = silver_orders.select("order_id", F.lit(True).alias("_known"))
    filled = items.join(known, "order_id", "left").withColumns(
        {
            "freight_value": F.coalesce("freight_value", F.lit(0).cast("decimal(12,2)")),
            "quantity": F.coalesce("quantity", F.lit(1)),
        }
    )
    reason = _first_of(
        (F.col("_known").isNull(), "order_id not in Silver orders"),
        (F.col("unit_price").isNull(), "null unit_price"),
    )
    return contracts.annotate(filled, contracts.ORDER_ITEMS, reason).drop("_known")


def clean_weather(weather: DataFrame, start: date, end: date) -> DataFrame:
    """Undated, out-of-range and placeless days are rejected; a fractional code rejects its row."""
    code = F.col("weathercode")
    reason = _first_of(
        (F.col("date").isNull(), "null date"),
        (~F.col("date").between(F.lit(start), F.lit(end)), "date outside pipeline range"),
        (F.col("city").isNull() | F.col("state").isNull(), "null city or state"),
        (is_fractional(code), "fractional weathercode"),
    )
    is_text = dict(weather.dtypes)["date"] == "string"
    dated = weather.withColumn("date", parse_date(F.col("date")) if is_text else F.to_date("date"))
    ready = dated.withColumn("_reason", reason).withColumns(
        {"weathercode": whole_or_null(code), "city": lower_trim(F.col("city"))}
    )
    return contracts.annotate(ready, contracts.WEATHER, F.col("_reason")).drop("_reason")


FX_COLUMNS = [f.name for f in contracts.FX]
PAIR = ["base_currency", "quote_currency"]


def _early_fx_reason(start: date, end: date) -> Column:
    base, quote, day = F.col("base_currency"), F.col("quote_currency"), F.col("date")
    return _first_of(
        (day.isNull(), "null date"),
        (~day.between(F.lit(start), F.lit(end)), "date outside pipeline range"),
        (base.isNull() | quote.isNull(), "null base_currency or quote_currency"),
    )


def rejected_quotes(rates: DataFrame, start: date, end: date) -> DataFrame:
    """Rates rejected before filling: without a date or currency, or outside the range."""
    typed = [F.col(f.name).try_cast(f.dtype).alias(f.name) for f in contracts.FX]
    reasoned = rates.select(*typed, _early_fx_reason(start, end).alias(REASON))
    return reasoned.where(F.col(REASON).isNotNull())


def daily_fx(rates: DataFrame, start: date, end: date, recency: list[Column]) -> DataFrame:
    """Daily series of every currency pair over [start, end], gaps filled, invalid days annotated.

    `recency` orders rates of the same pair and day; the last one counts.
    """
    usable = rates.where(_early_fx_reason(start, end).isNull())
    daily = keep_last(usable, [*PAIR, "date"], recency).select(*FX_COLUMNS)
    filled = fill_calendar(daily, PAIR, "date", "rate", start, end).select(*FX_COLUMNS)
    unfilled = _first_of((F.col("rate").isNull(), "null exchange rate after ffill"))
    return contracts.annotate(filled, contracts.FX, unfilled)


def clean_fx(rates: DataFrame, start: date, end: date, recency: list[Column]) -> DataFrame:
    """The filled daily series and the rows rejected before filling."""
    return daily_fx(rates, start, end, recency).unionByName(rejected_quotes(rates, start, end))


def clean_payments(payments: DataFrame) -> DataFrame:
    """Numbers are parsed tolerantly, the load time strictly; payments without an instrument are rejected; then the contract."""
    names = [f.name for f in contracts.PAYMENTS]
    parsed = payments.select(*names).withColumns(
        {
            "payment_value": parse_number(F.col("payment_value"), "decimal(18,2)"),
            "payment_sequential": parse_number(F.col("payment_sequential")),
            "payment_installments": parse_number(F.col("payment_installments")),
            "ingested_at": strict_timestamp(F.col("ingested_at")),
        }
    )
    reason = _first_of(
        (
            F.col("payment_type") == "not_defined",
            "payment_type='not_defined' (missing payment method)",
        )
    )
    return contracts.annotate(parsed, contracts.PAYMENTS, reason)


def summarize(annotated: DataFrame, name: str) -> DataFrame:
    """Rows in, kept and rejected, the share rejected, and WARNING from ten percent on."""
    rejected = F.count_if(F.col(REASON).isNotNull())
    pct = F.coalesce(F.try_divide(rejected * 100.0, F.count(F.lit(1))), F.lit(0.0))
    return annotated.agg(
        F.lit(name).alias("transform_name"),
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col(REASON).isNull()).alias("rows_kept"),
        rejected.alias("rows_quarantined"),
        F.round(pct, 6).cast("decimal(9,6)").alias("drop_pct"),
        F.when(pct >= DROP_WARNING_PCT, "WARNING").otherwise("INFO").alias("level"),
    )


def reasons(annotated: DataFrame, name: str) -> DataFrame:
    """Rejected rows by reason."""
    return (
        contracts.rejected(annotated)
        .groupBy(F.lit(name).alias("transform_name"), REASON)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
