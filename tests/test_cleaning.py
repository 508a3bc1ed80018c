import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesloom.operators import cleaning, contracts

D, T = dt.date, dt.datetime
ORDER = {
    "order_id": 1, "order_code": "aaa-111", "customer_id": 10, "order_status": "delivered",
    "order_date": D(2017, 3, 1), "order_timestamp": "2017-03-01 08:00:00", "approved_at": "bad",
    "estimated_delivery": D(2017, 3, 10), "actual_delivery": D(2017, 3, 9), "delivery_days_actual": 8,
    "delivery_days_estimated": 9, "source_channel": "online", "currency_code": "BRL",
    "ingested_at": T(2017, 3, 2),
}
ORDER_SCHEMA = (
    "order_id long, order_code string, customer_id long, order_status string, order_date date, "
    "order_timestamp string, approved_at string, estimated_delivery date, actual_delivery date, "
    "delivery_days_actual long, delivery_days_estimated long, source_channel string, "
    "currency_code string, ingested_at timestamp_ntz"
)


def orders(spark, *changes):
    return spark.createDataFrame([{**ORDER, **c} for c in changes], ORDER_SCHEMA)


def reason(df):
    return df.first()[contracts.REASON]


@pytest.mark.parametrize("change, expected", [
    ({}, None),
    ({"order_status": "canceled", "order_date": None}, "canceled order excluded from Silver"),
    ({"order_date": None, "customer_id": None}, "null order_date"),
    ({"customer_id": None, "order_status": "lost"}, "null customer_id"),
    ({"order_status": "lost", "delivery_days_actual": -1}, "unknown order_status: lost"),
    ({"order_status": None}, "unknown order_status: None"),
    ({"delivery_days_actual": None, "delivery_days_estimated": None, "actual_delivery": None}, None),
    ({"delivery_days_actual": -1}, "delivery_days_actual[greater_than_or_equal_to(0)]=-1"),
    ({"order_code": ""}, "order_code[not_empty]=''"),
    ({"currency_code": "BR", "order_code": None}, "order_code[not_nullable]=None | currency_code[length(3)]='BR'"),
])
def test_order_rules(spark, change, expected):
    assert reason(cleaning.clean_orders(orders(spark, change))) == expected


def test_orders_are_typed_and_bad_timestamps_null(spark):
    row = cleaning.clean_orders(orders(spark, {})).first()
    assert row["order_timestamp"] == T(2017, 3, 1, 8) and row["approved_at"] is None


def test_valid_rows_are_typed_even_beside_invalid_ones(spark):
    """Valid rows keep the declared types whether or not another row is rejected."""
    raw = spark.createDataFrame([("1", "USD", "BRL", "3.25"), ("2", "USD", "BRL", "0")], "n string, base_currency string, quote_currency string, rate string")
    raw = raw.withColumn("date", F.lit("2017-01-02"))
    done = contracts.accepted(contracts.annotate(raw, contracts.FX))
    assert dict(done.dtypes)["rate"] == "decimal(16,6)" and dict(done.dtypes)["date"] == "date"
    assert done.count() == 1


def test_missing_contract_column_raises(spark):
    with pytest.raises(ValueError, match="rate"):
        contracts.annotate(spark.createDataFrame([("BRL",)], "base_currency string"), contracts.FX)


def test_uncastable_value_is_a_reason(spark):
    df = orders(spark, {}).withColumn("delivery_days_actual", F.lit("soon"))
    assert reason(cleaning.clean_orders(df)) == "delivery_days_actual[coerce_dtype('bigint')]='soon'"


ITEM = (1, 1, 5, 7, 1, "10.00", None, None, T(2017, 3, 2))
ITEM_SCHEMA = (
    "order_item_id long, order_id long, product_id long, store_id long, line_number int, "
    "unit_price string, freight_value string, quantity int, ingested_at timestamp_ntz"
)


def items(spark, *rows):
    df = spark.createDataFrame(rows, ITEM_SCHEMA)
    return df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("unit_price", "freight_value")})


def test_item_defaults_and_orphans(spark):
    silver = spark.createDataFrame([(1,)], "order_id long")
    df = items(
        spark, ITEM, (2, 99, *ITEM[2:]), (3, None, *ITEM[2:]), (4, 1, 5, 7, 1, None, None, None, ITEM[8]),
        (5, 1, 5, 7, 0, "0.00", "-1.00", 0, ITEM[8]),
    )
    got = {r["order_item_id"]: r for r in cleaning.clean_order_items(df, silver).collect()}
    assert got[1][contracts.REASON] is None
    assert got[1]["quantity"] == 1 and got[1]["freight_value"] == 0
    assert got[2][contracts.REASON] == got[3][contracts.REASON] == "order_id not in Silver orders"
    assert got[4][contracts.REASON] == "null unit_price"
    assert got[5][contracts.REASON] == (
        "line_number[greater_than_or_equal_to(1)]=0 | unit_price[greater_than(0)]=0.00 | "
        "freight_value[greater_than_or_equal_to(0)]=-1.00 | quantity[greater_than_or_equal_to(1)]=0"
    )


WEATHER_SCHEMA = (
    "city string, state string, date date, temp_max double, temp_min double, precipitation double, "
    "windspeed double, weathercode double"
)


@pytest.mark.parametrize("row, expected", [
    (("São Luís ", "MA", D(2017, 1, 5), 30.0, 18.0, 5.0, 10.0, 3.0), None),
    (("x", "SP", D(2017, 1, 5), None, None, None, None, None), None),
    (("x", "SP", D(2017, 1, 5), None, None, None, None, float("nan")), None),
    ((None, None, None, None, None, None, None, None), "null date"),
    (("x", "SP", D(2018, 1, 5), 30.0, 18.0, 5.0, 10.0, 3.0), "date outside pipeline range"),
    (("x", None, D(2017, 1, 5), 30.0, 18.0, 5.0, 10.0, 3.0), "null city or state"),
    (("x", "SP", D(2017, 1, 5), 30.0, 18.0, 5.0, 10.0, 2.5), "fractional weathercode"),
    (("x", "SPX", D(2017, 1, 5), 61.0, 18.0, -1.0, 10.0, 100.0),
     "state[length(2)]='SPX' | temp_max[less_than_or_equal_to(60)]=61.0 | "
     "precipitation[greater_than_or_equal_to(0)]=-1.0 | weathercode[less_than_or_equal_to(99)]=100"),
])
def test_weather_rules(spark, row, expected):
    df = spark.createDataFrame([row], WEATHER_SCHEMA)
    assert reason(cleaning.clean_weather(df, D(2017, 1, 1), D(2017, 12, 31))) == expected


def test_weather_city_keeps_accents(spark):
    df = spark.createDataFrame([("São Luís ", "MA", D(2017, 1, 5), 30.0, 18.0, 5.0, 10.0, 3.0)], WEATHER_SCHEMA)
    assert cleaning.clean_weather(df, D(2017, 1, 1), D(2017, 12, 31)).first()["city"] == "são luís"


FX_SCHEMA = "date date, base_currency string, quote_currency string, rate decimal(16,6), seen int"


def fx(spark, *rows):
    from decimal import Decimal

    return spark.createDataFrame([(d, b, q, None if r is None else Decimal(str(r)), n) for d, b, q, r, n in rows], FX_SCHEMA)


def test_fx_weekend_is_filled(spark):
    week = [(D(2017, 1, 2 + i), "USD", "BRL", 3.25 + i / 10, 0) for i in range(5)]
    done = cleaning.clean_fx(fx(spark, *week), D(2017, 1, 2), D(2017, 1, 8), [F.col("seen")])
    rates = {r["date"]: float(r["rate"]) for r in done.collect()}
    assert len(rates) == 7
    assert rates[D(2017, 1, 7)] == rates[D(2017, 1, 8)] == rates[D(2017, 1, 6)] == 3.65


def test_fx_leading_gap_takes_first_rate_and_last_duplicate_wins(spark):
    df = fx(spark, (D(2017, 1, 3), "USD", "BRL", 3.1, 1), (D(2017, 1, 3), "USD", "BRL", 3.2, 2))
    done = cleaning.clean_fx(df, D(2017, 1, 1), D(2017, 1, 4), [F.col("seen")])
    assert [float(r["rate"]) for r in done.collect()] == [3.2] * 4


def test_fx_pairs_are_filled_apart(spark):
    df = fx(spark, (D(2017, 1, 1), "USD", "BRL", 3.1, 1), (D(2017, 1, 2), "EUR", "BRL", 4.0, 1))
    done = cleaning.clean_fx(df, D(2017, 1, 1), D(2017, 1, 3), [F.col("seen")])
    assert {(r["base_currency"], float(r["rate"])) for r in done.collect()} == {("USD", 3.1), ("EUR", 4.0)}
    assert done.count() == 6


def test_fx_rejections(spark, rows):
    df = fx(
        spark, (None, "USD", "BRL", 3.0, 1), (D(2016, 1, 1), "USD", "BRL", 3.0, 1),
        (D(2017, 1, 1), None, "BRL", 3.0, 1), (D(2017, 1, 1), "GBP", "BRL", None, 1),
        (D(2017, 1, 1), "USD", "BRL", 0, 1),
    )
    done = cleaning.clean_fx(df, D(2017, 1, 1), D(2017, 1, 1), [F.col("seen")])
    assert rows(done.select(contracts.REASON)) == sorted([
        ("null date",), ("date outside pipeline range",), ("null base_currency or quote_currency",),
        ("null exchange rate after ffill",), ("rate[greater_than(0)]=0.000000",),
    ], key=repr)


def test_payments(spark):
    schema = (
        "order_id long, payment_sequential string, payment_type string, payment_installments string, "
        "payment_value string, ingested_at timestamp_ntz, extra int"
    )
    df = spark.createDataFrame([
        (1, "1", "boleto", "0", "10.50", T(2017, 3, 2), 1), (2, "1", "not_defined", "0", "0", T(2017, 3, 2), 1),
        (3, "0", "cash", "x", "0", T(2017, 3, 2), 1),
    ], schema)
    got = {r["order_id"]: r for r in cleaning.clean_payments(df).collect()}
    assert got[1][contracts.REASON] is None and float(got[1]["payment_value"]) == 10.5
    assert got[2][contracts.REASON] == "payment_type='not_defined' (missing payment method)"
    assert got[3][contracts.REASON] == (
        "payment_sequential[greater_than_or_equal_to(1)]=0 | payment_type[isin]='cash' | "
        "payment_installments[not_nullable]=None | payment_value[greater_than(0)]=0.00"
    )
    assert "extra" not in cleaning.clean_payments(df).columns


@pytest.mark.parametrize("bad, level", [(0, "INFO"), (9, "INFO"), (10, "WARNING"), (100, "WARNING")])
def test_summary_warns_from_ten_percent(spark, bad, level):
    df = spark.range(100).withColumn(contracts.REASON, F.when(F.col("id") < bad, "x"))
    row = cleaning.summarize(df, "orders").first()
    assert (row["rows_in"], row["rows_kept"], row["rows_quarantined"], row["level"]) == (100, 100 - bad, bad, level)


def test_summary_of_nothing(spark):
    df = spark.range(0).withColumn(contracts.REASON, F.lit(None).cast("string"))
    row = cleaning.summarize(df, "orders").first()
    assert (row["rows_in"], float(row["drop_pct"]), row["level"]) == (0, 0.0, "INFO")


def test_fractions_break_whole_number_columns(spark):
    from salesloom.operators import contracts

    rows = [(1.5, "credit_card", 1.0, 1.0), (1.0, "credit_card", 2.7, 1.0), (1.0, "credit_card", 2.0, 1.0)]
    frame = spark.createDataFrame(rows, "order_id double, payment_type string, payment_installments double, payment_value double")
    full = frame.selectExpr("*", "1L AS payment_sequential", "TIMESTAMP_NTZ '2020-01-01' AS ingested_at")
    reasons = [r["quarantine_reason"] for r in contracts.annotate(full, contracts.PAYMENTS).collect()]
    assert reasons == [
        "order_id[coerce_dtype('bigint')]=1.5", "payment_installments[coerce_dtype('bigint')]=2.7", None]


def test_order_dates_are_strict(spark):
    from salesloom.operators import cleaning

    row = spark.createDataFrame([("not a date",)], "order_date string").selectExpr(
        "1L AS order_id", "'a' AS order_code", "1L AS customer_id", "'delivered' AS order_status", "order_date",
        "CAST(NULL AS TIMESTAMP_NTZ) AS order_timestamp", "CAST(NULL AS TIMESTAMP_NTZ) AS approved_at",
        "CAST(NULL AS DATE) AS estimated_delivery", "CAST(NULL AS DATE) AS actual_delivery",
        "CAST(NULL AS BIGINT) AS delivery_days_actual", "CAST(NULL AS BIGINT) AS delivery_days_estimated",
        "'online' AS source_channel", "'BRL' AS currency_code", "TIMESTAMP_NTZ '2020-01-01' AS ingested_at")
    with pytest.raises(Exception, match="not a timestamp"):
        cleaning.clean_orders(row).collect()
