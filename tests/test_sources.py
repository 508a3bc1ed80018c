import datetime as dt
import json
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesloom.operators import contracts
from salesloom.session import shared_folder
from salesloom.sources import feeds, history, lake, manifests, paths, schemas, warehouse
from salesloom.sources.versions import ConflictError, Load, Store
from salesloom.streaming import incremental

D, T = dt.date, dt.datetime
AT = T(2024, 2, 1, 6)


def numbers(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id int")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_csv_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.read_csv(spark, str(tmp_path / "absent"), schemas.RAW_SELLERS).count()


def test_csv_keeps_quotes_and_lines(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        'review_id,order_id,review_score,review_comment_message,review_creation_date\n'
        'r1,o1,5,"two\nlines, ""quoted""",2017-01-01\n'
    )
    row = lake.read_csv(spark, str(tmp_path / "r.csv"), schemas.RAW_REVIEWS).first()
    assert row["review_comment_message"] == 'two\nlines, "quoted"' and row["review_score"] == 5


def test_snapshots(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        lake.latest_snapshot(spark, path)
    lake.write_snapshot(numbers(spark, 1), path, D(2024, 1, 9))
    lake.write_snapshot(numbers(spark, 2), path, D(2024, 1, 10))
    lake.write_snapshot(numbers(spark, 3), path, D(2024, 1, 10))
    assert rows(lake.latest_snapshot(spark, path)) == [(2,)]
    lake.write_snapshot(numbers(spark, 4), path, D(2024, 1, 10), force=True)
    assert rows(lake.latest_snapshot(spark, path)) == [(4,)]
    # An unfinished later snapshot and leftovers of a failed write are not read.
    (Path(path) / "snapshot_date=2024-01-11").mkdir()
    numbers(spark, 5).write.parquet(f"{path}/snapshot_date=2024-01-12.staging-x")
    assert rows(lake.latest_snapshot(spark, path)) == [(4,)]


def test_quarantine(spark, tmp_path, rows):
    path = str(tmp_path / "q")
    empty = spark.createDataFrame([], "id int, quarantine_reason string")
    lake.write_quarantine(empty, path, "orders", AT)
    assert not Path(path).exists()
    bad = spark.createDataFrame([(1, "null date")], "id int, quarantine_reason string")
    lake.write_quarantine(bad, path, "orders", AT)
    lake.write_quarantine(bad, path, "orders", AT)
    assert rows(lake.read_quarantine(spark, path, "orders")) == [(1, "null date", AT.isoformat(), "orders")] * 2


@pytest.mark.parametrize("cutoff, kept", [(5, 5), (0, 0), (10, 10)])
def test_publish_silver(spark, tmp_path, cutoff, kept):
    annotated = spark.range(10).withColumn(contracts.REASON, F.when(F.col("id") >= cutoff, "late"))
    silver, quarantine = str(tmp_path / "s"), str(tmp_path / "q")
    for _ in range(2):
        lake.publish_silver(annotated, silver, quarantine, "t", D(2024, 1, 1), AT)
    assert lake.latest_snapshot(spark, silver).columns == ["id"]
    assert lake.latest_snapshot(spark, silver).count() == kept
    if kept < 10:
        assert lake.read_quarantine(spark, quarantine, "t").count() == 2 * (10 - kept)


def test_publish_silver_of_an_empty_feed(spark, tmp_path):
    nothing = spark.range(0).withColumn(contracts.REASON, F.lit(None).cast("string"))
    silver, quarantine = str(tmp_path / "s"), str(tmp_path / "q")
    lake.publish_silver(nothing, silver, quarantine, "t", D(2024, 1, 1), AT, skip_empty=True)
    assert paths.child_folders(spark, silver) == [] and not Path(quarantine).exists()
    lake.publish_silver(nothing, silver, quarantine, "t", D(2024, 1, 1), AT)
    assert lake.latest_snapshot(spark, silver).count() == 0


def test_gold_keeps_old_version_when_a_write_fails(spark, tmp_path, rows):
    path = str(tmp_path / "g")
    lake.write_gold({"g": numbers(spark, 1)}, path, AT)
    failing = numbers(spark, 2).withColumn("id", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        lake.write_gold({"g": failing}, path, AT)
    assert rows(lake.read_gold(spark, path, "g")) == [(1,)]
    lake.write_gold({"g": numbers(spark, 3)}, path, AT)
    assert rows(lake.read_gold(spark, path, "g")) == [(3,)]
    lake.write_gold({}, path, AT)


FACT = "id int, date_key int, v int"


def test_upsert(spark, tmp_path, rows):
    path = str(tmp_path / "f")

    def load(at, *data):
        warehouse.upsert_fact(spark.createDataFrame(list(data), FACT), path, ["id"], at)

    def read():
        return rows(warehouse.read_fact(spark, path).select("id", "date_key", "v", F.date_format("_loaded_at", "dd")))

    load(AT, (1, 20240115, 10), (2, 20240215, 20), (None, 20240115, 0))
    load(AT, (3, 20240315, 30))
    assert read() == [(1, 20240115, 10, "01"), (2, 20240215, 20, "01"), (3, 20240315, 30, "01")]
    store = Store(spark, str(tmp_path))
    before = store.snapshot()
    march = {r["file"] for r in before.files("f").where("low.id = 3 AND high.id = 3").collect()}
    assert len(march) == 1
    # Row 2 moves to January and empties February, row 4 is new, row 1 changes.
    load(AT + dt.timedelta(days=1), (1, 20240116, 11), (2, 20240117, 21), (4, 20240415, 40))
    assert read() == [
        (1, 20240116, 11, "02"), (2, 20240117, 21, "02"), (3, 20240315, 30, "01"), (4, 20240415, 40, "02"),
    ]
    # The file of row 3 is still the same one; a reader of the first load still sees it whole.
    assert march <= {r["file"] for r in store.snapshot().files("f").collect()}
    assert rows(before.read("f").select("id", "v")) == [(1, 10), (2, 20), (3, 30)]
    load(AT + dt.timedelta(days=2), (None, 20240101, 1))
    assert len(read()) == 4
    assert store.history().select("rows_in", "rows_replaced", "rows_total").collect() == [
        (2, 0, 2), (1, 0, 3), (3, 2, 4), (0, 0, 4)]
    store.expire(keep=1)
    assert store.numbers() == [4] and len(read()) == 4
    kept = {r["file"].split("/")[0] for r in store.snapshot().files("f").collect()}
    assert set(paths.child_folders(spark, f"{tmp_path}/data/f")) == kept
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        before.read("f").collect()


def test_load_all_skips_missing(spark, tmp_path):
    gold, target = str(tmp_path / "g"), str(tmp_path / "w")
    assert warehouse.load_all(spark, gold, target, AT) == []
    lake.write_gold({"dim_store": numbers(spark, 1)}, gold, AT)
    assert warehouse.load_all(spark, gold, target, AT) == ["dim_store"]
    assert Store(spark, target).snapshot().tables == ["dim_store"]


def test_a_load_that_fails_between_two_tables_changes_nothing(spark, tmp_path, rows):
    gold, target = str(tmp_path / "g"), str(tmp_path / "w")
    good = {"dim_store": numbers(spark, 1), "dim_currency": numbers(spark, 5)}
    lake.write_gold(good, gold, AT)
    warehouse.load_all(spark, gold, target, AT)
    reader = Store(spark, target).snapshot()
    lake.write_gold({"dim_store": numbers(spark, 2)}, gold, AT)
    load = Store(spark, target).load(AT + dt.timedelta(days=1))
    load.replace("dim_store", numbers(spark, 2))
    with pytest.raises(Exception, match="boom"):
        load.replace("dim_currency", numbers(spark, 6).withColumn("id", F.raise_error(F.lit("boom")).cast("int")))
    for tables in (reader, Store(spark, target).snapshot()):
        assert tables.number == 1
        assert [rows(tables.read(n).select("id")) for n in ("dim_store", "dim_currency")] == [[(1,)], [(5,)]]
    warehouse.load_all(spark, gold, target, AT + dt.timedelta(days=2))
    assert rows(reader.read("dim_store").select("id")) == [(1,)]
    assert rows(Store(spark, target).read("dim_store").select("id")) == [(2,)]
    assert rows(Store(spark, target).read("dim_currency").select("id")) == [(5,)]


def test_the_slower_of_two_loads_is_told(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path / "s"))
    with pytest.raises(FileNotFoundError):
        store.read("t")
    first, second = store.load(AT), store.load(AT)
    first.replace("t", numbers(spark, 1))
    second.replace("t", numbers(spark, 2))
    first.commit()
    with pytest.raises(ConflictError):
        second.commit()
    assert rows(store.read("t").select("id")) == [(1,)] and store.numbers() == [1]
    with pytest.raises(ValueError, match="as a whole"):
        store.load(AT).upsert("t", numbers(spark, 1), ["id"])


def test_an_upsert_looks_at_the_ranges_of_its_files_once(spark, tmp_path, monkeypatch):
    """The list of new files is read where it is written, not made of the files again for each use."""
    store, read = Store(spark, str(tmp_path / "s")), []
    rows = "id long, date_key int, v long"
    whole = Load._holding

    def holding(self, view, name, listed, fresh, keys):
        read.extend(fresh.inputFiles())
        return whole(self, view, name, listed, fresh, keys)

    monkeypatch.setattr(Load, "_holding", holding)
    for at, ids in ((AT, (1, 2, 3)), (AT + dt.timedelta(days=1), (3, 4))):
        load = store.load(at)
        load.upsert("f", spark.createDataFrame([(i, 20240101, at.day) for i in ids], rows), ["id"])
        load.commit()
    assert read and all("/lists/f/" in file for file in read)
    assert sorted(r["id"] for r in store.read("f").collect()) == [1, 2, 3, 4]


def test_an_upsert_writes_changed_files_once(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path / "s"))
    fact = spark.range(0, 40_000, numPartitions=1).selectExpr(
        "id", "int(20240101 + id div 2000) AS date_key", "id AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small files, as if they were large
    load = store.load(AT)
    load.upsert("f", fact.repartition(4), ["id"])
    load.commit()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before = {r["file"]: r["rows"] for r in store.snapshot().files("f").collect()}
    assert len(before) > 2
    load = store.load(AT + dt.timedelta(days=1))
    load.upsert("f", spark.createDataFrame([(7, 20240101, -1), (8, 20240101, -2)], "id long, date_key int, v long"), ["id"])
    after = {r["file"]: r["rows"] for r in load.commit().files("f").collect()}
    gone, new = set(before) - set(after), set(after) - set(before)
    assert len(gone) == 1 and sum(after[f] for f in new) == before[gone.pop()]
    assert sum(after.values()) == 40_000 and rows(store.read("f", id=(7, 8)).select("id", "v")) == [(7, -1), (8, -2)]
    # Of all files of the two loads, only those in the range are opened.
    assert len(store.read("f", date_key=(20240119, 20240119)).inputFiles()) < len(after)
    pruned = warehouse.loaded_between(store.read("f"), AT + dt.timedelta(days=1), AT + dt.timedelta(days=2))
    assert pruned.count() == 2
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_day" in plan


def test_dimension_reload_leaves_facts(spark, tmp_path):
    fact, dim = str(tmp_path / "fact"), str(tmp_path / "dim")  # two tables of one store
    warehouse.upsert_fact(spark.createDataFrame([(1, 20240115, 10)], FACT), fact, ["id"], AT)
    for _ in range(2):
        warehouse.reload_dimension(numbers(spark, 1, 2), dim, AT)
    assert warehouse.read_fact(spark, fact).count() == 1 and warehouse.read_table(spark, dim).count() == 2


def test_load_time_range_is_half_open(spark):
    df = spark.createDataFrame([(T(2024, 1, d),) for d in (1, 2, 3)], "_loaded_at timestamp")
    assert warehouse.loaded_between(df, T(2024, 1, 1), T(2024, 1, 3)).count() == 2


def test_weather_files(spark, tmp_path, rows):
    daily = {
        "time": ["2017-01-01", "2017-01-02"], "temperature_2m_max": [30.5, None], "temperature_2m_min": [20.0, 19.0],
        "precipitation_sum": [0.0, 12.5], "windspeed_10m_max": [10.0, 11.0], "weather_code": [3, None],
    }
    (tmp_path / "sao_paulo_2017-01-01.json").write_text(json.dumps({"latitude": 1, "daily": daily}, indent=1))
    (tmp_path / "natal_2017-01-01.json").write_text(json.dumps({"daily": {}}))
    (tmp_path / "atlantis_2017-01-01.json").write_text(json.dumps({"daily": daily}))
    placed = feeds.with_city(feeds.read_responses(spark, str(tmp_path)), feeds.city_list(spark))
    assert rows(feeds.parse_weather(placed)) == [
        ("sao paulo", "SP", D(2017, 1, 1), 30.5, 20.0, 0.0, 10.0, 3.0),
        ("sao paulo", "SP", D(2017, 1, 2), None, 19.0, 12.5, 11.0, None),
    ]


def test_corrupt_files_are_told_apart(spark, tmp_path, rows):
    landed = spark.createDataFrame(
        [("a_1", '{"daily": {}}'), ("b_1", '{"daily": ['), ("c_1", "[]"), ("2024", "oops")], "file_name string, payload string")
    feeds.land(landed, str(tmp_path / "in"))
    good, bad = feeds.split_corrupt(feeds.read_responses(spark, str(tmp_path / "in")))
    assert rows(good.select("file_name")) == [("a_1",), ("c_1",)]
    assert rows(bad.select("file_name", "payload", "quarantine_reason", "block_start")) == [
        ("2024", "oops\n", "unreadable JSON", 0), ("b_1", '{"daily": [\n', "unreadable JSON", 0)]


def test_fx_shapes(spark, rows):
    def response(payload):
        return spark.createDataFrame([(json.dumps(payload),)], "payload string")

    usd, brl = F.lit("USD"), F.lit("BRL")
    expected = [("2017-01-02", "USD", "BRL", "3.250000")]

    def shown(df):
        return [(str(d), b, q, str(r)) for d, b, q, r in rows(df)]

    nested = {"rates": {"2017-01-02": {"BRL": 3.25, "EUR": 1}, "2017-01-03": {"EUR": 1}, "2017-01-04": {"BRL": None}}}
    assert shown(feeds.parse_fx_nested(response(nested), usd, brl)) == expected
    listed = [
        {"date": "2017-01-02", "base": "USD", "quote": "BRL", "rate": 3.25},
        {"date": "2017-01-03", "base": "USD", "quote": "BRL", "rate": None}, {"date": None, "rate": 1.0},
    ]
    assert shown(feeds.parse_fx_list(response(listed))) == expected
    assert shown(feeds.parse_fx_flat(response({"2017-01-02": 3.25, "2017-01-03": None}), usd, brl)) == expected


@pytest.mark.parametrize("cities, status", [(0, "failed"), (1, "partial"), (2, "success")])
def test_weather_manifest(spark, cities, status):
    df = spark.createDataFrame([(f"c{i}",) for i in range(cities)], "city string")
    row = manifests.weather_manifest(df, D(2017, 1, 1), D(2017, 1, 2), 2).first()
    assert (row["delivered"], row["total_records"], row["status"]) == (cities, cities, status)


def test_fx_manifest_counts_changes(spark):
    data = [("USD", "BRL", D(2017, 1, 1 + i), r) for i, r in enumerate([3.0, 3.0, 3.1, 3.0, 3.0])]
    df = spark.createDataFrame(data, "base_currency string, quote_currency string, date date, rate double")
    row = manifests.fx_manifest(df, D(2017, 1, 1), D(2017, 1, 5)).first()
    assert (row["delivered"], row["total_records"]) == (3, 5)


def test_stream_cleans_only_new_files(spark, tmp_path, rows):
    landing, silver, quarantine, state = (str(tmp_path / n) for n in ("in", "s", "q", "c"))

    def clean(batch):
        return batch.withColumn(contracts.REASON, F.when(F.col("id") < 0, "negative"))

    for ids in ((1, -1), (2, -2)):
        numbers(spark, *ids).coalesce(1).write.mode("append").parquet(landing)
        arriving = incremental.stream_parquet(spark, landing, "*.parquet")
        incremental.clean_new_files(arriving, clean, silver, quarantine, state)
    assert rows(spark.read.parquet(silver).select("id", "batch_id")) == [(1, 0), (2, 1)]
    assert rows(spark.read.parquet(quarantine).select("id")) == [(-1,), (-2,)]


def test_plain_csv_is_split(spark, tmp_path):
    """A CSV file without declared line breaks is read by several tasks."""
    path = tmp_path / "orders.csv"
    line = ",".join(["x" * 30] * 7)
    path.write_text("\n".join([schemas.RAW_ORDERS.replace(" string", "").replace(" ", ""), *[line] * 20_000]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        assert lake.read_csv(spark, str(path), schemas.RAW_ORDERS).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_upsert_of_repeated_and_undated_rows(spark, tmp_path, rows):
    path = str(tmp_path / "f")
    first = [(1, None, 10), (1, None, 20), (2, 20240115, 5), (None, 20240115, 1)]
    warehouse.upsert_fact(spark.createDataFrame(first, FACT), path, ["id"], AT)
    assert rows(warehouse.read_fact(spark, path).drop("_loaded_at")) == [(1, None, 20), (2, 20240115, 5)]
    again = [(1, 20240220, 7), (2, None, 9), (2, None, 8)]
    warehouse.upsert_fact(spark.createDataFrame(again, FACT), path, ["id"], AT)
    assert rows(warehouse.read_fact(spark, path).drop("_loaded_at")) == [(1, 20240220, 7), (2, None, 9)]


def test_snapshots_overlap_and_fail_alone(spark, tmp_path):
    slow = [spark.range(4, numPartitions=1).selectExpr(
        "id", f"java_method('java.lang.Thread', 'sleep', {400 + i}L) AS s") for i in range(3)]
    broken = spark.range(1).select(F.raise_error(F.lit("no such disk")).alias("b"))
    tables = {**{f"t{i}": df for i, df in enumerate(slow)}, "broken": broken}
    tracker, most, outcome = spark.sparkContext.statusTracker(), [], {}
    work = threading.Thread(target=lambda: outcome.update(lake.snapshot_tables(tables, str(tmp_path), D(2024, 1, 1))))
    work.start()
    while work.is_alive():
        most.append(len(tracker.getActiveJobsIds()))
        time.sleep(0.02)
    assert max(most) >= 2
    assert outcome == {"t0": None, "t1": None, "t2": None, "broken": "no such disk"}
    assert len(tracker.getJobIdsForGroup("snapshot t1")) >= 1
    assert all(lake.latest_snapshot(spark, f"{tmp_path}/t{i}").count() == 4 for i in range(3))
    assert lake.snapshot_tables({}, str(tmp_path), D(2024, 1, 1)) == {}


def test_stages_are_recorded_whether_they_fail_or_not(spark, tmp_path, rows):
    path = str(tmp_path / "h")
    source = spark.range(10)

    def run(stage, transform, source=source):
        return history.run_stage(source, transform, lambda df: df.write.parquet(str(tmp_path / stage)), path, "r", stage)

    assert run("good", lambda df: df.where("id < 4")) == "success"
    assert run("bad", lambda df: df.select(F.raise_error(F.lit("rule 7")).alias("x"))) == "failed"
    assert run("missing", lambda df: df.select("absent")) == "failed"
    assert run("unreadable", lambda df: df, source.where(F.raise_error(F.lit("gone")).cast("boolean"))) == "failed"
    found = {r["stage"]: r for r in history.read_history(spark, path).collect()}
    assert {k: (r["status"], r["rows_processed"]) for k, r in found.items()} == {
        "good": ("success", 4), "bad": ("failed", 10), "missing": ("failed", 10), "unreadable": ("failed", None)}
    assert found["good"]["error"] is None and found["bad"]["error"] == "rule 7" and "absent" in found["missing"]["error"]
    assert all(r["duration_seconds"] > 0 and r["started_at"] is not None for r in found.values())


def test_members_that_come_back_get_their_old_key(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path))
    for number, codes in enumerate((["b", "m"], ["a", "m"], ["a", "b", "c"])):
        load = store.load(AT + dt.timedelta(days=number))
        members = spark.createDataFrame([(c,) for c in codes], "code string")
        warehouse.reload_members(load, "dim", members, "code", "key")
        load.commit()
    assert rows(store.read("dim").select("code", "key")) == [("a", 3), ("b", 1), ("c", 4)]
    assert rows(store.snapshot(1).read("dim").select("code", "key")) == [("b", 1), ("m", 2)]
    assert rows(store.read("dim_keys").select("code", "key")) == [("a", 3), ("b", 1), ("c", 4), ("m", 2)]
