import datetime as dt
import random
import statistics
import time
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesloom.operators import checks, dedup, keys, lookups, medians, ordered, profiling, ranking, skew, timeseries
from salesloom.session import stored

D = dt.date


# Deduplication and keys


def test_keep_first_and_last(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), ("b", 5)], "k string, v int")
    assert rows(dedup.keep_first(df, ["k"], [F.col("v").asc_nulls_last()])) == [("a", 1), ("b", 5)]
    assert rows(dedup.keep_last(df, ["k"], [F.col("v")])) == [("a", 2), ("b", 5)]


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedup.keep_last(df, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("ranges", [1, 7])
def test_surrogate_keys_are_dense_and_ordered(spark, ranges):
    """The same keys from however many ranges."""
    codes = [f"c{i:03d}" for i in range(60)]
    random.Random(1).shuffle(codes)
    df = spark.createDataFrame([(c,) for c in codes], "code string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = keys.assign_surrogate_keys(df, "key", [F.col("code")], start=10)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert numbered.columns[0] == "key"
    got = {r["code"]: r["key"] for r in numbered.collect()}
    assert got == {c: i + 10 for i, c in enumerate(sorted(codes))}


def test_surrogate_keys_of_nothing(spark):
    df = spark.createDataFrame([], "code string")
    assert keys.assign_surrogate_keys(df, "key", [F.col("code")]).count() == 0


def test_surrogate_keys_read_only_the_asked_columns(spark):
    df = spark.range(40).selectExpr("concat('c', id) AS code", "repeat('x', 50) AS wide", "null AS untyped")
    numbered = keys.assign_surrogate_keys(df, "key", [F.col("code")])
    assert numbered.columns == ["key", "code", "wide", "untyped"]
    assert dict(numbered.dtypes) == {"key": "bigint", "code": "string", "wide": "string", "untyped": "void"}
    plan = numbered.select("key", "code")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "wide" not in plan


def test_storing_leaves_no_shuffle_files(spark, rows):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = [Path(d) for d in env.blockManager().diskBlockManager().localDirsString()]

    def files():
        return {f.name for d in folders for f in d.rglob("shuffle_*")}

    before = files()
    kept = stored(spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 3).alias("k")).count(), "few")
    until = time.time() + 20
    while (left := files() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert rows(kept) == [(0, 334), (1, 333), (2, 333)]


# Joins


@pytest.fixture
def shuffled(spark):
    """No broadcasts, so that the shuffle path is exercised."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_lookup_spreads_null_keys(shuffled, rows):
    fact = shuffled.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, F.col("id") % 10).alias("fk")
    )
    dim = shuffled.range(5).select(F.col("id").alias("pk"), (F.col("id") * 100).alias("name"))
    joined = lookups.lookup(fact, dim, {"fk": "pk"}, ["id"])
    assert joined.columns == ["id", "fk", "name"]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_salt" in plan and "BroadcastExchange" not in plan
    expected = [
        (i, i % 10 if i % 3 else None, (i % 10) * 100 if i % 3 and i % 10 < 5 else None) for i in range(3000)
    ]
    assert rows(joined) == sorted(expected, key=repr)


def test_lookup_on_several_columns(spark, rows):
    fact = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, "x")], "id int, c string, s string")
    dim = spark.createDataFrame([("a", "x", 9)], "dc string, ds string, v int")
    joined = lookups.lookup(fact, dim, {"c": "dc", "s": "ds"}, ["id"])
    assert rows(joined.select("id", "v")) == [(1, None), (2, 9), (3, None)]


def test_resolve_reports_the_missing(spark, rows):
    fact = spark.createDataFrame([(i, f"k{i % 8}") for i in range(40)], "id int, code string")
    dim = spark.createDataFrame([("k0", 1)], "c string, key int")
    found, report = lookups.resolve(fact, dim, {"code": "c"}, ["id"], "key")
    assert found.count() == 5
    row = report.first()
    assert (row["key_column"], row["missing_rows"]) == ("code", 35)
    assert row["sample_keys"] == ["k1", "k2", "k3", "k4", "k5"]


def test_resolve_all_reports_each_lookup_over_the_rows_that_it_got(spark, rows):
    fact = spark.createDataFrame(
        [(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, None, "y"), (5, "a", "y"), (6, "a", None), (7, "c", "y")],
        "id int, code string, other string")
    one = spark.createDataFrame([("a", 10), ("a", 11), ("c", 12), (None, 13)], "c string, key int")
    two = spark.createDataFrame([("x", 20), (None, 21)], "o string, key2 int")
    found, reports = lookups.resolve_all(
        fact, [(one, {"code": "c"}, "key"), (two, {"other": "o"}, "key2")], ["id"])
    assert rows(found.select("id", "key", "key2")) == [(1, 10, 20), (1, 11, 20), (2, 10, 20), (2, 11, 20)]
    assert [tuple(r.first()) for r in reports] == [("code", 2, ["b"]), ("other", 5, ["y"])]


def test_resolve_all_gives_what_resolve_gives_in_turn(spark, rows):
    fact = spark.range(200).selectExpr("id", "if(id % 9 = 0, null, id % 7) AS a", "id % 5 AS b")
    one = spark.range(5).selectExpr("id AS c", "id + 100 AS key")
    two = spark.range(3).selectExpr("id AS d", "id + 200 AS key2")
    first, missed = lookups.resolve(fact, one, {"a": "c"}, ["id"], "key")
    second, missed2 = lookups.resolve(first, two, {"b": "d"}, ["id"], "key2")
    found, reports = lookups.resolve_all(fact, [(one, {"a": "c"}, "key"), (two, {"b": "d"}, "key2")], ["id"])
    columns = ["id", "key", "key2"]
    assert rows(found.select(columns)) == rows(second.select(columns))
    assert [r.first() for r in reports] == [missed.first(), missed2.first()]


def test_lookup_leaves_dealt_rows_where_they_are(shuffled, rows):
    fact = shuffled.range(60).selectExpr("id", "if(id % 9 = 0, null, id % 7) AS code", "id % 4 AS line")
    table = shuffled.range(5).selectExpr("id AS c", "id + 100 AS key")
    first = dedup.keep_first(fact.repartition("code"), ["code", "line"], [F.col("id")])
    joined = lookups.lookup(first, table, {"code": "c"}, ["line"], dealt=True)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(code") == 1 and plan.count("Exchange") == 2
    plain = lookups.lookup(dedup.keep_first(fact, ["code", "line"], [F.col("id")]), table, {"code": "c"}, ["line"])
    assert joined.columns == plain.columns and rows(joined) == rows(plain)


@pytest.mark.parametrize("most", [0, 4, 1000])
def test_resolve_all_gives_the_same_by_shuffles_and_broadcasts(shuffled, rows, monkeypatch, most):
    """Tables of 5, 3 and 4 rows: all dealt out, stored in between; one dealt out; none."""
    spark, names = shuffled, []
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", most)
    monkeypatch.setattr(lookups, "stored", lambda df, name: names.append(name) or stored(df, name))
    fact = spark.range(200).selectExpr("id", "if(id % 9 = 0, null, id % 7) AS a", "id % 5 AS b", "id % 6 AS c")
    tables = [spark.range(n).selectExpr(f"id AS on_{x}", f"id + {n}00 AS key_{x}") for x, n in (("a", 5), ("b", 3), ("c", 4))]
    found, reports = lookups.resolve_all(
        fact, [(t, {x: f"on_{x}"}, f"key_{x}") for t, x in zip(tables, "abc")], ["id"])
    expected, missed = fact, []
    for t, x in zip(tables, "abc"):
        expected, report = lookups.resolve(expected, t, {x: f"on_{x}"}, ["id"], f"key_{x}")
        missed.append(report)
    columns = ["id", "key_a", "key_b", "key_c"]
    assert rows(found.select(columns)) == rows(expected.select(columns))
    assert [r.first() for r in reports] == [r.first() for r in missed]
    assert names == {0: ["looked_up", "looked_up", "resolved"], 4: ["resolved"], 1000: ["resolved"]}[most]


def test_lookup_tables_with_long_keys_are_not_broadcast(spark, monkeypatch):
    table = spark.createDataFrame([("abc", 1), (None, 2)], "code string, key int")
    assert lookups._is_small(table, ["code"]) and lookups._is_small(table.limit(0), ["code"])
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 2)
    assert not lookups._is_small(table, ["code"])


def test_resolve_without_misses(spark):
    fact = spark.createDataFrame([(1, "a")], "id int, code string")
    dim = spark.createDataFrame([("a", 1)], "c string, key int")
    _, report = lookups.resolve(fact, dim, {"code": "c"}, ["id"], "key")
    assert report.first().asDict() == {"key_column": "code", "missing_rows": 0, "sample_keys": []}


def test_orphans(spark, rows):
    fact = spark.createDataFrame([(1, 1), (2, 2), (3, 99), (4, None)], "id int, fk int")
    dim = spark.createDataFrame([(1,), (2,), (None,)], "pk int")
    assert rows(lookups.orphans(fact, dim, "fk", "pk").select("id")) == [(3,), (4,)]
    count = {n: lookups.count_orphans(fact, dim, "fk", "pk", n).first()[0] for n in (True, False)}
    assert count == {True: 2, False: 1}


# Time series


@pytest.mark.parametrize("seed", range(3))
def test_fill_calendar_against_brute_force(spark, seed):
    rng = random.Random(seed)
    start, end = D(2020, 1, 1), D(2020, 3, 1)
    days = [start + dt.timedelta(i) for i in range((end - start).days + 1)]
    series = {
        e: {d: rng.choice([None, rng.randint(1, 99)]) for d in days if rng.random() < 0.3} for e in "abc"
    }
    series["empty"] = {days[3]: None, days[7]: None}
    data = [(e, d, v) for e, vs in series.items() for d, v in vs.items()]
    df = spark.createDataFrame(data, "e string, day date, v int")
    got = {(r["e"], r["day"]): r["v"] for r in timeseries.fill_calendar(df, ["e"], "day", "v", start, end).collect()}
    expected = {}
    for e, values in series.items():
        known = {d: v for d, v in values.items() if v is not None}
        last = known[min(known)] if known else None
        for d in days:
            last = known.get(d, last)
            expected[e, d] = last
    assert got == expected


def test_growth_does_not_skip_missing_months(spark):
    monthly = spark.createDataFrame(
        [(D(2020, 1, 1), 100), (D(2020, 2, 1), None), (D(2020, 3, 1), 150), (D(2021, 3, 1), 300)], "month date, v int"
    )
    by_month = {r["month"]: r for r in timeseries.monthly_change(monthly, "v", 1, "prior", "change").collect()}
    assert by_month[D(2020, 3, 1)]["change"] is None and by_month[D(2020, 1, 1)]["prior"] is None
    by_month = {r["month"]: r for r in timeseries.monthly_change(monthly, "v", 12, "prior", "change").collect()}
    assert float(by_month[D(2021, 3, 1)]["change"]) == 1.0


def test_rolling_windows_truncate_at_the_start(spark):
    daily = timeseries.calendar(spark, D(2020, 1, 1), D(2020, 1, 10)).withColumn("v", F.lit(1))
    rolled = {r["date"].day: int(r["s"]) for r in timeseries.rolling_sum(daily, "v", 7, "s").collect()}
    assert (rolled[1], rolled[6], rolled[7], rolled[10]) == (1, 6, 7, 7)


def test_calendar_bounds(spark, rows):
    assert rows(timeseries.calendar(spark, D(2020, 2, 28), D(2020, 3, 1))) == [
        (D(2020, 2, 28),), (D(2020, 2, 29),), (D(2020, 3, 1),)]
    assert rows(timeseries.months(spark, D(2019, 12, 31), D(2020, 2, 1))) == [
        (D(2019, 12, 1),), (D(2020, 1, 1),), (D(2020, 2, 1),)]


def test_keys_survive_reloads(spark, rows):
    def members(*codes):
        return spark.createDataFrame([(c, len(c)) for c in codes], "code string, v int")

    none = members().select("code", F.lit(0).cast("long").alias("key"))
    first = keys.continue_surrogate_keys(members("m", "b", "x"), none, "key", "code", [F.col("code")])
    assert rows(first.select("key", "code")) == [(1, "b"), (2, "m"), (3, "x")]
    second = keys.continue_surrogate_keys(members("x", "aa", "zz", "b"), first, "key", "code", [F.col("code")])
    assert second.columns == ["key", "code", "v"]
    assert rows(second.select("key", "code")) == [(1, "b"), (3, "x"), (4, "aa"), (5, "zz")]
    assert rows(keys.continue_surrogate_keys(members("b"), first, "key", "code", [F.col("code")])) == [(1, "b", 1)]


# Ranking and medians


def test_rank_within_against_brute_force(spark):
    rng = random.Random(5)
    data = [(i, "hot" if i % 3 else f"s{i % 4}", rng.choice([None, rng.randint(0, 9)])) for i in range(300)]
    df = spark.createDataFrame(data, "id int, state string, v int")
    got = {r["id"]: (r["peer_rank"], r["peer_count"], float(r["peer_percent_rank"])) for r in ranking.rank_within(df, "state", "v").collect()}
    groups = defaultdict(list)
    for _, s, v in data:
        groups[s].append(-1 if v is None else v)
    for i, s, v in data:
        v = -1 if v is None else v
        rank = 1 + sum(x > v for x in groups[s])
        n = len(groups[s])
        assert got[i] == (rank, n, round((rank - 1) / (n - 1), 6))


def test_top_with_others(spark, rows):
    df = spark.createDataFrame([(f"c{i}", i) for i in range(6)], "c string, v long")
    assert rows(ranking.top_with_others(df, "c", "v", 2, "All Others")) == [("All Others", 6), ("c4", 4), ("c5", 5)]


@pytest.mark.parametrize("seed", range(3))
def test_grouped_median_against_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [("hot", rng.gauss(0, 5)) for _ in range(200 + seed)]
    data += [(f"z{i % 5}", rng.choice([0.0, 1.5, -3.25, 80.0])) for i in range(23 + seed)]
    data += [("same", 1.0)] * 4 + [("none", None), ("far", -90.0), ("far", 90.0)]
    df = spark.createDataFrame(data, "zip string, lat double")
    got = {r["zip"]: r["m"] for r in medians.grouped_median(df, "zip", F.col("lat"), "m").collect()}
    groups = defaultdict(list)
    for z, v in data:
        if v is not None:
            groups[z].append(v)
    assert got == pytest.approx({z: statistics.median(vs) for z, vs in groups.items()})


def test_ranks_of_very_many_values(spark):
    rng = random.Random(6)
    data = [(i, "hot" if i % 3 else f"s{i % 4}", rng.choice([None, rng.randint(0, 10**6)])) for i in range(900)]
    df = spark.createDataFrame([*data, (-1, None, 3), (-2, None, None)], "id int, state string, v int")
    columns = ["id", "peer_rank", "peer_count", "peer_percent_rank", "peer_average"]
    got, expected = (sorted(tuple(r) for r in rank(df, "state", "v").select(columns).collect())
                     for rank in (ranking.rank_in_ranges, ranking.rank_within))
    assert got == expected
    assert ranking.rank_in_ranges(df.limit(0), "state", "v").count() == 0


@pytest.fixture
def wide(spark):
    """Sixteen shuffle partitions, which adaptive execution neither merges nor splits."""
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_per_task(df):
    """Rows of each task of the last stage, the most first; tasks without rows count as well."""
    counts = df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    return sorted(counts, reverse=True)


def test_a_group_of_very_many_values_is_counted_by_many_tasks(wide):
    df = wide.range(100_000, numPartitions=4).selectExpr("'g' AS g", "0.01 * id / 100000 AS v", "1L AS n")
    placed = ordered.running_counts(df, "g", F.col("v").asc(), "n")
    assert placed.where("_before <> round(v * 10000000) OR _total <> 100000").count() == 0
    assert rows_per_task(placed)[0] <= 50_000  # of ranges of a sixteenth, a few may meet in one task
    assert medians.grouped_median(df, "g", F.col("v"), "m").first()["m"] == pytest.approx(0.0049999500)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_hot_key_is_spread(wide, how):
    lines = wide.range(60_000, numPartitions=4).selectExpr(
        "id AS line", "CASE WHEN id % 3 = 0 THEN 7L WHEN id % 1000 = 1 THEN NULL ELSE id END AS k")
    orders = wide.range(0, 60_000, 1, 4).where("id % 2 = 1").selectExpr("id AS k", "id * 2 AS v")
    hot = skew.hot_keys(lines, ["k"])
    assert len(hot) == 1
    plain, spread = lines.join(orders, "k", how), skew.join(lines, orders, ["k"], hot, ["line"], how)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).count() == plain.exceptAll(spread).count() == 0
    if how == "inner":
        assert rows_per_task(plain)[0] > 20_000
        tasks = rows_per_task(spread)
        assert tasks[0] <= 2 * tasks[len(tasks) // 2] and tasks[-1] > 0
        assert "_salt" in spread._jdf.queryExecution().executedPlan().toString()


def test_no_hot_key_leaves_a_plain_join(wide):
    lines = wide.range(1000).withColumnRenamed("id", "k")
    assert skew.hot_keys(lines, ["k"]) == {} and skew.hot_keys(lines.where("k < 0"), ["k"]) == {}
    assert "_salt" not in skew.join(lines, lines, ["k"], {}, ["k"])._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        skew.join(lines, lines, ["k"], {}, ["k"], "full")


# Checks and profiles


def results(df):
    return {r["check_name"]: r for r in df.collect()}


def test_checks_pass_and_fail(spark):
    df = spark.createDataFrame(
        [(1, 5, 1, 9), (1, None, 0, 9), (None, 7, 9, None), (None, -1, None, 1)], "id int, v int, lo int, hi int"
    )
    dim = spark.createDataFrame([(1,), (None,)], "pk int")
    got = results(checks.run_checks(df, "t", [
        checks.RowCount(5), checks.NotNull("id"), checks.NotNull("v"), checks.Unique(("id",)),
        checks.InRange("v", low=0, high=6), checks.InRange("v", low=-1, strict=True, label="strict"),
        checks.InRange("v", low=-5, allow_null=False, label="present"), checks.InRange("v", label="free"),
        checks.NotBelow("hi", "lo"), checks.NotBelow("hi", "lo", allow_null=False, severity="INFO"),
        checks.References("v", dim, "dim", "pk"), checks.References("id", dim, "dim", "pk"),
    ]))
    affected = {n.removeprefix("t."): (r["status"], r["rows_affected"]) for n, r in got.items()}
    assert affected == {
        "row_count_threshold": ("FAIL", 1), "no_nulls.id": ("FAIL", 2), "no_nulls.v": ("FAIL", 1),
        "uniqueness.id": ("FAIL", 2), "value_range.v": ("FAIL", 2), "strict": ("FAIL", 1),
        "present": ("FAIL", 1), "free": ("PASS", 0), "col_order.hi>=lo": ("FAIL", 2),
        "ri.v->dim": ("FAIL", 3), "ri.id->dim": ("PASS", 0),
    }
    assert got["t.row_count_threshold"]["message"] == "4 rows, fewer than 5"
    assert got["t.free"]["expected_value"] == "unbounded"
    assert '"violations":2' in got["t.uniqueness.id"]["metadata"]


def test_scalar_checks_share_one_scan(spark):
    df = spark.range(10).withColumn("v", F.col("id"))
    fused = checks.run_checks(df, "t", [checks.RowCount(1), checks.NotNull("v"), checks.InRange("v", low=0)])
    assert fused._jdf.queryExecution().executedPlan().toString().count("Range (") == 1


@pytest.mark.parametrize("halt_on, halts", [("INFO", True), ("WARNING", True), ("CRITICAL", False)])
def test_gate(spark, halt_on, halts):
    df = spark.createDataFrame([("PASS", "CRITICAL"), ("FAIL", "WARNING"), ("FAIL", "INFO")], "status string, severity string")
    assert checks.halt_decision(df, halt_on).first()["should_halt"] is halts


def test_gate_rejects_unknown_severity(spark):
    with pytest.raises(KeyError):
        checks.halt_decision(spark.createDataFrame([], "status string, severity string"), "FATAL")


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "a"), (1, "a")], "x int, y string")
    got = {(r["column_name"], r["metric"]): r["value"] for r in profiling.profile(df, "t").collect()}
    assert got == {
        (None, "row_count"): 4, (None, "col_count"): 2, (None, "duplicate_rows"): 1, ("x", "null_pct"): 25,
        ("y", "null_pct"): 0, ("x", "min"): 1, ("x", "max"): 2,
    }


def test_schema_issues(spark, rows):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1.0)], "order_id long, price double")
    assert rows(profiling.schema_issues(df, {"order_id": "int", "price": "float"}, 0.9)) == []
    assert rows(profiling.schema_issues(df, {"order_id": "object", "price": "float", "qty": "int"})) == [
        ("Column 'order_id': expected dtype category 'object', got 'bigint'",),
        ("Column 'price': null rate 66.7% exceeds threshold 50.0%",),
        ("Missing columns: ['qty']",),
    ]
