"""Number expressions: tolerant parsing, money sums, ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(12,2)"
MONEY_TOTAL = "decimal(28,2)"
RATIO = "decimal(18,6)"


def parse_number(text: Column, dtype: str = "double") -> Column:
    """Number of a text, NULL when it does not parse."""
    return text.try_cast(dtype)


def is_false_or_null(predicate: Column) -> Column:
    """Negation that treats an unknown predicate as not met."""
    return ~F.coalesce(predicate, F.lit(False))


def holds(predicate: Column) -> Column:
    """Predicate with unknown read as False, so that a comparison with NULL never holds."""
    return F.coalesce(predicate, F.lit(False))


def whole_or_null(value: Column) -> Column:
    """Whole number of a float: NaN and NULL become NULL, never 0. A fraction becomes NULL too."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (number == F.floor(number)), number.cast("long"))


def is_fractional(value: Column) -> Column:
    """True for a number with a fraction, which `whole_or_null` cannot keep."""
    number = value.cast("double")
    return holds(~F.isnan(number) & (number != F.floor(number)))


def line_revenue(unit_price: Column, quantity: Column) -> Column:
    """Revenue of a line without freight."""
    return unit_price * quantity


def money_sum(value: Column) -> Column:
    """Exact sum of a money expression."""
    return F.sum(value).cast(MONEY_TOTAL)


def ratio(numerator: Column, denominator: Column, otherwise: float | None = None) -> Column:
    """Quotient with six decimals; `otherwise` (NULL by default) when the divisor is zero or missing."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    rounded = F.round(quotient, 6).cast(RATIO)
    return rounded if otherwise is None else F.coalesce(rounded, F.lit(otherwise).cast(RATIO))


def mean(value: Column) -> Column:
    """Average of the non-null values with six decimals, summed exactly for decimals."""
    return ratio(F.sum(value), F.count(value))


def share(predicate: Column) -> Column:
    """Share of rows for which a never-null predicate holds, with six decimals."""
    return ratio(F.count_if(predicate), F.count(F.lit(1)))


def to_usd(amount: Column, rate: Column) -> Column:
    """Amount divided by a units-per-dollar rate with four decimals, NULL without a rate.

    The amount is narrowed first: a wider dividend would leave the quotient too few decimals to be
    rounded once.
    """
    return F.round(amount.cast("decimal(20,2)") / rate, 4).cast("decimal(18,4)")
