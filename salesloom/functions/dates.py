"""Date and timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_timestamp(text: Column) -> Column:
    """Timestamp without zone of a text, NULL when it does not parse."""
    return text.try_cast("timestamp_ntz")


def parse_date(text: Column) -> Column:
    """Date part of a text timestamp, NULL when it does not parse."""
    return F.to_date(parse_timestamp(text))


def strict_timestamp(text: Column) -> Column:
    """Timestamp without zone of a text; one that does not parse fails the job."""
    parsed = parse_timestamp(text)
    failure = F.raise_error(F.concat(F.lit("not a timestamp: "), text.cast("string")))
    return F.when(text.isNotNull() & parsed.isNull(), failure.cast("timestamp_ntz")).otherwise(parsed)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from `earlier` to `later`, NULL if either is missing."""
    return F.datediff(later, earlier).cast("long")


def date_key(day: Column) -> Column:
    """Integer YYYYMMDD of a date, by arithmetic so that it stays inside generated code."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def key_to_date(key: Column) -> Column:
    """Date of a YYYYMMDD integer."""
    whole = key.cast("int")
    month = F.floor(whole / 100).cast("int")
    return F.make_date(F.floor(whole / 10000).cast("int"), month % 100, whole % 100)


def month_start(day: Column) -> Column:
    """First day of the month of a date."""
    return F.trunc(day, "month")


def is_on_time(actual: Column, estimated: Column) -> Column:
    """Delivered within the promised days; NULL while either is missing."""
    return actual <= estimated


def calendar_columns(day: Column) -> dict[str, Column]:
    """Calendar attributes of a date, Monday being weekday 0 and weeks being ISO weeks."""
    weekday = F.weekday(day)
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "week": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "month_name": F.date_format(day, "MMMM"),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "is_weekend": weekday >= 5,
        "is_month_end": day == F.last_day(day),
    }
