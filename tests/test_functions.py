import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesloom.functions import dates, numbers, text


def one(spark, column, value, schema):
    return spark.createDataFrame([(value,)], f"v {schema}").select(column(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize("city, key", [
    ("São Paulo", "sao paulo"), ("RECIFE", "recife"), ("  Belém  ", "belem"), (None, ""),
    ("\tMaceió\n", "maceio"), ("São Luís", "sao luis"), ("Ñandú", "nandu"), ("Ầ", "a"),
])
def test_normalize_city(spark, city, key):
    assert one(spark, text.normalize_city, city, "string") == key


def test_lower_trim_keeps_accents(spark):
    assert one(spark, text.lower_trim, "  São Luís ", "string") == "são luís"


@pytest.mark.parametrize("state, region", [
    ("SP", "Sudeste"), ("sp", "Sudeste"), ("RS", "Sul"), ("DF", "Centro-Oeste"), ("AM", "Norte"),
    ("CE", "Nordeste"), ("XX", "Desconhecido"), (None, "Desconhecido"),
])
def test_macro_region(spark, state, region):
    assert one(spark, text.macro_region, state, "string") == region


def test_all_states_have_a_region():
    from salesloom.functions.fixed import MACRO_REGION_STATES, WEATHER_CITIES

    states = [s for group in MACRO_REGION_STATES.values() for s in group]
    assert len(states) == len(set(states)) == 27
    assert len(WEATHER_CITIES) == 20 and {c[1] for c in WEATHER_CITIES} <= set(states)


@pytest.mark.parametrize("code, name", [("BRL", "Brazilian Real"), ("USD", "US Dollar"), ("XAU", "XAU")])
def test_currency_name(spark, code, name):
    assert one(spark, text.currency_name, code, "string") == name


@pytest.mark.parametrize("code, category", [
    (0, "clear"), (1, "clear"), (2, "cloudy"), (3, "cloudy"), (51, "rainy"), (67, "rainy"), (82, "rainy"),
    (95, "stormy"), (45, "other"), (71, "other"), (None, None),
])
def test_weather_category(spark, code, category):
    assert one(spark, text.weather_category, code, "long") == category


@pytest.mark.parametrize("change, label", [
    (0.083, "▲ +8.3% (UP)"), (-0.5, "▼ -50.0% (DOWN)"), (0.0, "▬ 0.0% (FLAT)"), (None, "▬ 0.0% (FLAT)"),
])
def test_change_label(spark, change, label):
    assert one(spark, lambda c: text.change_label(c.cast("decimal(18,6)")), change, "double") == label


@pytest.mark.parametrize("value, whole", [(3.0, 3), (0.0, 0), (float("nan"), None), (None, None), (2.5, None)])
def test_whole_or_null(spark, value, whole):
    assert one(spark, numbers.whole_or_null, value, "double") == whole


def test_fraction_is_seen(spark):
    assert one(spark, numbers.is_fractional, 2.5, "double") is True
    assert one(spark, numbers.is_fractional, float("nan"), "double") is False


def test_ratio_of_zero(spark):
    df = spark.range(1).select(
        numbers.ratio(F.lit(1), F.lit(0)).alias("blank"), numbers.ratio(F.lit(1), F.lit(0), 0).alias("zero"),
        numbers.ratio(F.lit(1), F.lit(3)).alias("third"),
    )
    assert [str(x) for x in df.first()] == ["None", "0.000000", "0.333333"]


def test_strict_timestamp_fails(spark):
    assert one(spark, dates.strict_timestamp, "2017-03-01 08:00:00", "string") == dt.datetime(2017, 3, 1, 8)
    assert one(spark, dates.strict_timestamp, None, "string") is None
    with pytest.raises(Exception, match="not a timestamp"):
        one(spark, dates.strict_timestamp, "soon", "string")


def test_tolerant_timestamp(spark):
    assert one(spark, dates.parse_timestamp, "soon", "string") is None
    assert one(spark, dates.parse_date, "2017-03-01 23:59:59", "string") == dt.date(2017, 3, 1)


@pytest.mark.parametrize("day, key", [(dt.date(2017, 6, 1), 20170601), (dt.date(1999, 12, 31), 19991231)])
def test_date_key_round_trip(spark, day, key):
    assert one(spark, dates.date_key, day, "date") == key
    assert one(spark, lambda c: dates.key_to_date(dates.date_key(c)), day, "date") == day


def test_calendar_of_new_year(spark):
    day = spark.createDataFrame([(dt.date(2017, 1, 1),)], "d date")
    row = day.select(*[c.alias(n) for n, c in dates.calendar_columns(F.col("d")).items()]).first()
    assert row.asDict() == {
        "year": 2017, "quarter": 1, "month": 1, "week": 52, "day_of_month": 1, "day_of_week": 6,
        "day_name": "Sunday", "month_name": "January", "quarter_name": "Q1", "is_weekend": True,
        "is_month_end": False,
    }
