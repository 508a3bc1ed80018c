"""Quality checks over the facts, their log and gate, and pipeline health."""

from pyspark.sql import functions as F

from salesloom.catalog.queries_sources import LOAD_TIMES, three_loads
from salesloom.catalog.registry import query
from salesloom.catalog.sql import ratio
from salesloom.catalog.tables import END, RUN_AT, START, Tables
from salesloom.functions.numbers import ratio as ratio_of
from salesloom.operators import checks
from salesloom.operators.single_rows import side_by_side
from salesloom.plans import health, marts, measures
from salesloom.session import scratch_path
from salesloom.sources import warehouse

RESULT = [c for c in checks.RESULT if c != "metadata"]

# SQL of one check result each. `bad` is the number of violations, `seen` the observed number.


def _check(table, name, category, severity, bad, expected, actual, ok, failed, source) -> str:
    return f"""SELECT '{table}.{name}' AS check_name, '{table}' AS table_name,
        '{category}' AS category, '{severity}' AS severity,
        CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '{expected}' AS expected_value,
        {actual} AS actual_value, CAST(bad AS BIGINT) AS rows_affected,
        CASE WHEN bad = 0 THEN {ok} ELSE {failed} END AS message
        FROM (SELECT {bad} AS bad, count(*) AS seen FROM {source})"""


def _n(value: str) -> str:
    return f"format('{{:,}}', CAST({value} AS BIGINT))"


def _row_count(table, view, low):
    shown = f"{low:,}"
    return _check(
        table, "row_count_threshold", "row_count", "CRITICAL", f"greatest(0, {low} - count(*))",
        f">= {shown}", "CAST(seen AS VARCHAR)", f"{_n('seen')} || ' rows, at least {shown} expected'",
        f"{_n('seen')} || ' rows, fewer than {shown}'", view,
    )


def _no_nulls(table, view, column):
    return _check(
        table, f"no_nulls.{column}", "null_check", "CRITICAL", f"count(*) FILTER ({column} IS NULL)",
        "0 NULLs", "bad || ' NULL(s)'", f"'''{column}'' is always filled'",
        f"{_n('bad')} || ' rows lack ''{column}'''", view,
    )


def _unique(table, view, *columns):
    shown = ", ".join(columns)
    groups = f"(SELECT count(*) AS n FROM {view} GROUP BY {shown} HAVING count(*) > 1)"
    return _check(
        table, f"uniqueness.{'+'.join(columns)}", "uniqueness", "CRITICAL", "count(*)",
        "0 duplicate groups", "bad || ' duplicate group(s)'", f"'each ({shown}) comes once'",
        f"{_n('bad')} || ' values of ({shown}) come more than once'", groups,
    )


def _range(table, view, column, name, outside, bounds, severity="CRITICAL"):
    return _check(
        table, name, "range", severity, f"count(*) FILTER ({outside})", bounds,
        "bad || ' out-of-range'", f"'''{column}'' stays in [{bounds}]'",
        f"'''{column}'' leaves [{bounds}] in ' || {_n('bad')} || ' rows'", view,
    )


def _order(table, view, upper, lower):
    return _check(
        table, f"col_order.{upper}>={lower}", "range", "WARNING",
        f"count(*) FILTER ({upper} < {lower})", f"{upper} >= {lower}", "bad || ' violation(s)'",
        f"'''{lower}'' never exceeds ''{upper}'''",
        f"{_n('bad')} || ' row(s) where ''{upper}'' < ''{lower}'''", view,
    )


def _references(table, view, fk, dim, pk, severity="WARNING"):
    orphans = f"(SELECT 1 FROM {view} WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {dim}))"
    return _check(
        table, f"ri.{fk}->{dim}", "referential_integrity", severity, "count(*)",
        "0 orphan FK values", "bad || ' orphan(s)'", f"'every ''{fk}'' is found in ''{dim}.{pk}'''",
        f"{_n('bad')} || ' rows hold a ''{fk}'' unknown to ''{dim}.{pk}'''", orphans,
    )


SALES_CHECKS = " UNION ALL ".join([
    _row_count("fact_sales", "fact_sales", 100_000),
    *[_no_nulls("fact_sales", "fact_sales", c) for c in ("order_item_id", "order_id", "date_key")],
    _unique("fact_sales", "fact_sales", "order_item_id"),
    _range("fact_sales", "fact_sales", "unit_price", "range.unit_price_gt_0", "unit_price <= 0", "> 0"),
    _range("fact_sales", "fact_sales", "freight_value", "range.freight_value_gte_0", "freight_value < 0", ">= 0", "WARNING"),
    _range("fact_sales", "fact_sales", "quantity", "range.quantity_gte_1", "quantity < 1", ">= 1", "WARNING"),
    _references("fact_sales", "fact_sales", "date_key", "dim_date", "date_key"),
    _references("fact_sales", "fact_sales", "customer_key", "dim_customer", "customer_key", "INFO"),
])
WEATHER_CHECKS = " UNION ALL ".join([
    _row_count("fact_weather_daily", "fact_weather", 1_000),
    *[_no_nulls("fact_weather_daily", "fact_weather", c) for c in ("date_key", "city", "state")],
    _unique("fact_weather_daily", "fact_weather", "date_key", "city", "state"),
    _order("fact_weather_daily", "fact_weather", "temp_max", "temp_min"),
    _range("fact_weather_daily", "fact_weather", "weathercode", "range.weathercode_0_99",
           "weathercode < 0 OR weathercode > 99", ">= 0 and <= 99", "WARNING"),
    _references("fact_weather_daily", "fact_weather", "date_key", "dim_date", "date_key"),
])
FX_CHECKS = " UNION ALL ".join([
    _row_count("fact_fx_rates", "fact_fx", 500),
    *[_no_nulls("fact_fx_rates", "fact_fx", c) for c in ("date_key", "base_currency", "quote_currency", "rate")],
    _unique("fact_fx_rates", "fact_fx", "date_key", "base_currency", "quote_currency"),
    _range("fact_fx_rates", "fact_fx", "rate", "range.rate_gt_0", "rate <= 0", "> 0"),
    _references("fact_fx_rates", "fact_fx", "date_key", "dim_date", "date_key"),
])
PAYMENT_CHECKS = " UNION ALL ".join([
    _row_count("fact_payments", "fact_payments", 1),
    *[_no_nulls("fact_payments", "fact_payments", c) for c in ("order_id", "payment_sequential")],
    _unique("fact_payments", "fact_payments", "order_id", "payment_sequential"),
    _range("fact_payments", "fact_payments", "payment_value", "range.payment_value_gt_0", "payment_value <= 0", "> 0"),
    _references("fact_payments", "fact_payments", "date_key", "dim_date", "date_key"),
    _references("fact_payments", "fact_payments", "customer_key", "dim_customer", "customer_key", "INFO"),
])
# Checks that find violations: rows before cleaning.
RAW_CHECKS = " UNION ALL ".join([
    _row_count("lines", "lineitem", 10_000_000_000),
    _no_nulls("lines", "src_items", "unit_price"),
    _unique("lines", "lineitem", "l_orderkey", "l_linenumber"),
    _range("lines", "src_orders", "order_date", "value_range.order_date", "order_date IS NULL", "unbounded"),
])


def _sales(t: Tables):
    return checks.run_checks(
        t.stored("fact_sales"), "fact_sales", checks.fact_sales_checks(t.dim_date, t.dim_customer)
    )


def _weather(t: Tables):
    return checks.run_checks(
        t.stored("fact_weather"), "fact_weather_daily", checks.fact_weather_checks(t.dim_date)
    )


def _fx(t: Tables):
    return checks.run_checks(t.stored("fact_fx"), "fact_fx_rates", checks.fact_fx_checks(t.dim_date))


def _payments(t: Tables):
    suite = checks.fact_payments_checks(t.dim_date, t.dim_customer)
    return checks.run_checks(t.stored("fact_payments"), "fact_payments", suite)


def _raw(t: Tables):
    """Checks on rows before cleaning, all of which fail."""
    lines = [checks.RowCount(10_000_000_000), checks.Unique(("l_orderkey", "l_linenumber"))]
    parts = [
        checks.run_checks(t.raw("lineitem"), "lines", lines),
        checks.run_checks(t.order_items, "lines", [checks.NotNull("unit_price")]),
        checks.run_checks(t.orders, "lines", [checks.InRange("order_date", allow_null=False)]),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(SALES_CHECKS)
def sales_quality(t: Tables):
    return _sales(t).select(*RESULT)


@query(WEATHER_CHECKS)
def weather_quality(t: Tables):
    return _weather(t).select(*RESULT)


@query(FX_CHECKS)
def fx_quality(t: Tables):
    return _fx(t).select(*RESULT)


@query(f"{SALES_CHECKS} UNION ALL {WEATHER_CHECKS} UNION ALL {FX_CHECKS}")
def all_quality(t: Tables):
    """The suites of all loaded facts: 26 results."""
    return _sales(t).unionByName(_weather(t)).unionByName(_fx(t)).select(*RESULT)


@query(PAYMENT_CHECKS)
def payments_quality(t: Tables):
    return _payments(t).select(*RESULT)


@query(RAW_CHECKS)
def raw_quality(t: Tables):
    return _raw(t).select(*RESULT)


LOADED = f"{SALES_CHECKS} UNION ALL {WEATHER_CHECKS} UNION ALL {FX_CHECKS} UNION ALL {PAYMENT_CHECKS}"
RESULTS = f"({LOADED} UNION ALL {RAW_CHECKS})"


def _loaded(t: Tables):
    """The suites of all four facts."""
    return _sales(t).unionByName(_weather(t)).unionByName(_fx(t)).unionByName(_payments(t))


def _share(t: Tables):
    """Stores what several facts and checks read, and the stores, as files tell how small their keys are."""
    for name in ("silver_orders", "order_items", "dim_store"):
        t.stored(name)


def _results(t: Tables):
    _share(t)
    return _loaded(t).unionByName(_raw(t))


@query(f"""SELECT count(*) AS checks, count(*) FILTER (status = 'PASS') AS passed,
    count(*) FILTER (status = 'FAIL') AS failed,
    count(*) FILTER (status = 'FAIL' AND severity = 'WARNING') AS failed_warning,
    count(*) FILTER (status = 'FAIL' AND severity = 'CRITICAL') AS failed_critical FROM {RESULTS}""")
def quality_summary(t: Tables):
    return checks.summarize_results(_results(t))


@query(f"""SELECT 'WARNING' AS halt_on, count(*) AS blocking_failures, count(*) > 0 AS should_halt
    FROM {RESULTS} WHERE status = 'FAIL' AND severity IN ('WARNING', 'CRITICAL')""")
def quality_gate(t: Tables):
    return checks.halt_decision(_results(t), "WARNING")


@query(f"""SELECT count(*) AS checks,
    {ratio("count(*) FILTER (status = 'PASS') * 100", 'count(*)')} AS pass_rate_pct,
    CASE WHEN count(*) FILTER (status = 'PASS') * 100.0 / count(*) >= 95 THEN 'green'
         WHEN count(*) FILTER (status = 'PASS') * 100.0 / count(*) >= 90 THEN 'amber' ELSE 'red'
    END AS band FROM {RESULTS}""")
def quality_pass_rate(t: Tables):
    return health.pass_rate(_results(t))


@query(f"SELECT severity, status, count(*) AS n FROM ({LOADED}) GROUP BY ALL")
def latest_quality_run(t: Tables):
    """Two runs appended to the log; the later one is read back by severity and status."""
    log = scratch_path(t.spark, "quality-log")
    older = RUN_AT.replace(year=RUN_AT.year - 1)
    _share(t)
    checks.run_lifecycle(_raw(t), log, older)
    checks.run_lifecycle(_loaded(t), log, RUN_AT)
    return checks.latest_run(warehouse.read_quality_log(t.spark, log))


# Health.


@query(f"""SELECT {ratio('count(temp_max)', 'count(*)')} AS weather_coverage,
    {ratio('count(*) FILTER (order_code IS NULL)', 'count(*)')} AS order_code_null_rate,
    {ratio('count(*) FILTER (customer_key IS NULL)', 'count(*)')} AS customer_key_null_rate,
    {ratio('count(x.rate)', 'count(*)')} AS fx_coverage
    FROM fact_sales f LEFT JOIN dim_customer c USING (customer_key)
    LEFT JOIN fact_weather w ON w.date_key = f.date_key AND w.city = c.normalized_city
        AND w.state = c.state
    LEFT JOIN fact_fx x ON x.date_key = f.date_key AND x.base_currency = 'USD'
        AND x.quote_currency = 'BRL'""")
def join_coverage(t: Tables):
    weather = marts.sales_with_weather(t.fact_sales, t.dim_customer, t.fact_weather)
    return health.join_coverage(weather, marts.sales_usd(t.fact_sales, t.fact_fx))


BASELINES = {"fact_sales": 28_700, "fact_weather_daily": 9_000, "fact_fx_rates": 9_700}
_EXPECTED = " UNION ALL ".join(
    f"SELECT count(*) AS n, {n} AS baseline FROM {view}"
    for view, n in zip(("fact_sales", "fact_weather", "fact_fx"), BASELINES.values(), strict=True)
)


@query(f"""SELECT *, CASE WHEN min_rows = 0 OR order_id_null_rate > 0.05 OR undocumented_drop > 0.1
            THEN 'PIPELINE FAULT'
        WHEN max_deviation > 0.005 OR join_key_null_rate > 0.02 OR missing_days > 3 THEN 'REVIEW NEEDED'
        ELSE 'NOMINAL' END AS pipeline_status
    FROM (SELECT CAST(round(max(abs(n - baseline) / CAST(baseline AS DOUBLE)), 6) AS DECIMAL(18,6))
            AS max_deviation, min(n) AS min_rows FROM ({_EXPECTED})),
        (SELECT {ratio('count(*) FILTER (order_id IS NULL)', 'count(*)')} AS order_id_null_rate,
            {ratio('count(*) FILTER (customer_id IS NULL)', 'count(*)')} AS join_key_null_rate FROM src_orders),
        (SELECT {ratio('(SELECT count(*) FROM src_orders) - count(*)', '(SELECT count(*) FROM src_orders)')}
            AS undocumented_drop FROM checked_orders),
        (SELECT CAST(greatest(0, date_diff('day', DATE '{START}', min(date)))
            + greatest(0, date_diff('day', max(date), DATE '{END}')) AS INTEGER) AS missing_days
            FROM silver_weather)""")
def pipeline_status(t: Tables):
    """The status card over all loaded facts."""
    counts = measures.row_counts({
        "fact_sales": t.fact_sales, "fact_weather_daily": t.fact_weather, "fact_fx_rates": t.fact_fx})
    rates = t.orders.agg(
        ratio_of(F.count_if(F.col("order_id").isNull()), F.count(F.lit(1))).alias("order_id_null_rate"),
        ratio_of(F.count_if(F.col("customer_id").isNull()), F.count(F.lit(1))).alias("join_key_null_rate"),
        F.count(F.lit(1)).alias("rows_in"),
    )
    answered = t.checked_orders.agg(F.count(F.lit(1)).alias("rows_answered"))
    dropped = side_by_side(rates, answered).select(
        "order_id_null_rate", "join_key_null_rate",
        ratio_of(F.col("rows_in") - F.col("rows_answered"), F.col("rows_in")).alias("undocumented_drop"),
    )
    first, last = F.min("date"), F.max("date")
    missing = t.silver_weather.agg((
        F.greatest(F.lit(0), F.datediff(first, F.lit(START)))
        + F.greatest(F.lit(0), F.datediff(F.lit(END), last))).alias("missing_days"))
    return health.pipeline_status(counts, BASELINES, side_by_side(dropped, missing))


@query(" UNION ALL ".join(
    f"""SELECT CAST(date_trunc('month', {LOAD_TIMES}) AS DATE) AS load_month,
    '{name}' AS table_name, count(*) AS row_count FROM {view} WHERE date_key IS NOT NULL GROUP BY 1"""
    for name, view in (("fact_sales", "fact_sales"), ("fact_weather_daily", "fact_weather"), ("fact_fx_rates", "fact_fx"))
))
def rows_over_time(t: Tables):
    """Rows by load month of three facts after three loads, counted in their lists of files."""
    facts = {"fact_sales": "fact_sales", "fact_weather_daily": "fact_weather", "fact_fx_rates": "fact_fx"}
    return health.rows_over_time(three_loads(t, facts).snapshot(), list(facts))
