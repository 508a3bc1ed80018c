"""Tables in immutable versions, made current together by one small manifest.

    <store>/manifests/000000000007.json      what is current after load 7
    <store>/data/<table>/batch=<id>/...      files of one load, never changed or renamed
    <store>/lists/<table>/<id>/              the files of a table of facts, with their ranges

A load writes its files beside the old ones. Nothing refers to them until `commit` gives the next
manifest its name, in a single step that fails if another load was faster. A reader resolves a manifest
once and sees the tables of that load, whatever is loaded meanwhile; a load that fails leaves files that
nothing refers to, until `expire` removes them.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesloom.operators.dedup import keep_last
from salesloom.sources import paths

LOADED_AT, LOAD_DAY, BATCH = "_loaded_at", "load_day", "batch"
DATE = "date_key"
HISTORY = ("number long, loaded_at timestamp, "
           "changes array<struct<table_name: string, rows_in: long, rows_replaced: long, rows_total: long>>")


class ConflictError(RuntimeError):
    """Another load has been committed since this one began."""


class Snapshot:
    """The tables of one manifest."""

    def __init__(self, spark: SparkSession, path: str, manifest: dict):
        self.spark, self.path, self.manifest = spark, path, manifest

    @property
    def number(self) -> int:
        return self.manifest["number"]

    @property
    def tables(self) -> list[str]:
        return sorted(self.manifest["tables"])

    def _entry(self, name: str) -> dict:
        if name not in self.manifest["tables"]:
            raise FileNotFoundError(f"no table {name} in {self.path}, load {self.number}")
        return self.manifest["tables"][name]

    def schema(self, name: str) -> StructType:
        return StructType.fromJson(self._entry(name)["schema"])

    def files(self, name: str) -> DataFrame:
        """file, rows, load_day, low and high (of the keys and the date) of the files of a fact."""
        return self.spark.read.parquet(f"{self.path}/{self._entry(name)['list']}")

    def read(self, name: str, **ranges: tuple) -> DataFrame:
        """A table of this load, facts with their `load_day`.

        Values of key or date columns within (first, last) may be asked for; files of a fact that
        hold none are not opened.
        """
        entry = self._entry(name)
        if "folder" in entry:
            rows = self.spark.read.schema(self.schema(name)).parquet(f"{self.path}/{entry['folder']}")
        else:
            files = self.files(name)
            for column, (first, last) in ranges.items():
                files = files.where((F.col(f"high.{column}") >= first) & (F.col(f"low.{column}") <= last))
            rows = self.read_files(name, [row[0] for row in files.select("file").collect()])
        for column, (first, last) in ranges.items():
            rows = rows.where(F.col(column).between(first, last))
        return rows

    def read_files(self, name: str, files: list[str]) -> DataFrame:
        """Rows of the named files; the load day is a partition, so that a filter on it drops files while planning."""
        folder = f"{self.path}/data/{name}"
        schema = self.schema(name).add(LOAD_DAY, "date")
        if not files:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.option("basePath", folder).schema(schema)
        return read.parquet(*(f"{folder}/{file}" for file in files)).drop(BATCH)


class Load:
    """New versions of some tables, current for all readers at `commit` and for none before."""

    def __init__(self, store: Store, loaded_at: datetime):
        self.spark, self.path, self.loaded_at = store.spark, store.path, loaded_at
        self.before = store.snapshot()
        self.tables = dict(self.before.manifest["tables"])
        self.changes: list[dict] = []

    def _changed(self, name: str, rows_in: int, replaced: int, total: int) -> None:
        self.changes.append(
            {"table_name": name, "rows_in": rows_in, "rows_replaced": replaced, "rows_total": total})

    def replace(self, name: str, df: DataFrame, stamp: bool = True) -> None:
        """A new version of the whole table, with its load time unless `stamp` is off."""
        rows = df.withColumn(LOADED_AT, F.lit(self.loaded_at)) if stamp else df
        folder = f"data/{name}/{BATCH}={uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        count = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{folder}").count()
        old = self.tables.get(name, {}).get("rows", 0)
        self.tables[name] = {"folder": folder, "schema": rows.schema.jsonValue(), "rows": count}
        self._changed(name, count, old, count)

    def upsert(self, name: str, source: DataFrame, keys: list[str], recency: list[Column] | None = None) -> None:
        """Insert new rows and replace the rows whose key exists. Rows with a NULL key are dropped.

        Of several rows with one key in `source` the last one by `recency` counts, and by the values of
        all other columns where that leaves ties or is not given. The new rows are written once, ordered
        by load day and key. Of the old files, those whose key range meets the batch are searched for
        its keys, and only files that hold one are written again, once, without the rows replaced.
        """
        if name in self.tables and "list" not in self.tables[name]:
            raise ValueError(f"{name} is replaced as a whole by earlier loads")
        if name in {change["table_name"] for change in self.changes}:
            raise ValueError(f"{name} was changed by this load already")
        others = [F.col(c) for c in source.columns if c not in keys]
        last = keep_last(source.dropna(subset=keys), keys, [*(recency or []), *others])
        incoming = last.withColumn(LOADED_AT, F.lit(self.loaded_at))
        batch = f"{BATCH}={uuid.uuid4().hex}"
        schema = incoming.schema
        if name in self.tables:  # columns that this batch lacks stay, as NULL for its rows
            old_schema = self.before.schema(name)
            missing = [f for f in old_schema.fields if f.name not in schema.names]
            schema = StructType([*schema.fields, *missing])
        entry = {"schema": schema.jsonValue(), "keys": keys}
        view = Snapshot(self.spark, self.path, {"number": 0, "tables": {name: entry}})
        self._write(incoming, name, batch, keys)
        fresh = self._kept(name, self._ranges(view, name, self._files(name, batch), keys))
        listed, replaced, old_rows, kept_list = None, [], 0, None
        if name in self.tables:
            listed = self.before.files(name)
            old_rows = listed.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
            replaced = self._holding(view, name, listed, fresh, keys)
            if replaced:
                own = self._files(name, batch)
                old = view.read_files(name, replaced).drop(LOAD_DAY)
                kept = old.join(view.read_files(name, own).select(*keys), keys, "left_anti")
                self._write(kept.select(*schema.names), name, batch, keys)
                rest = sorted(set(self._files(name, batch)) - set(own))
                kept_list = self._ranges(view, name, rest, keys)
            listed = listed.where(~F.col("file").isin(replaced)) if replaced else listed
        rows_in = fresh.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        for part in (listed, kept_list):
            fresh = fresh if part is None else fresh.unionByName(part)
        place = f"lists/{name}/{uuid.uuid4().hex}"
        total = self._kept(name, fresh, place).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        self.tables[name] = {**entry, "list": place}
        self._changed(name, rows_in, old_rows + rows_in - total, total)

    def _write(self, rows: DataFrame, name: str, batch: str, keys: list[str]) -> None:
        placed = rows.withColumn(LOAD_DAY, F.to_date(LOADED_AT))
        placed.repartitionByRange(LOAD_DAY, *keys).sortWithinPartitions(LOAD_DAY, *keys).write.mode(
            "append").partitionBy(LOAD_DAY).parquet(f"{self.path}/data/{name}/{batch}")

    def _files(self, name: str, batch: str) -> list[str]:
        folder = f"{self.path}/data/{name}/{batch}"
        return [f"{batch}/{day}/{file}" for day in paths.child_folders(self.spark, folder)
                for file in paths.child_files(self.spark, f"{folder}/{day}") if file.endswith(".parquet")]

    @staticmethod
    def _own_path() -> Column:
        return F.regexp_extract("_metadata.file_path", f"({BATCH}=[^/]+/[^/]+/[^/]+)$", 1)

    def _ranges(self, view: Snapshot, name: str, files: list[str], keys: list[str]) -> DataFrame:
        """One row for each file, from its key and date columns."""
        rows = view.read_files(name, files)
        if not files:
            rows = rows.withColumn("file", F.lit(""))
        else:
            rows = rows.withColumn("file", self._own_path())
        known = [*keys, *([DATE] if DATE in rows.columns and DATE not in keys else [])]
        return rows.groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"), F.first(LOAD_DAY).alias(LOAD_DAY),
            F.struct(*[F.min(c).alias(c) for c in known]).alias("low"),
            F.struct(*[F.max(c).alias(c) for c in known]).alias("high"))

    def _kept(self, name: str, ranges: DataFrame, place: str | None = None) -> DataFrame:
        """The list of files, written so that the files are read for it once; one row for each file."""
        path = f"{self.path}/{place or f'lists/{name}/{uuid.uuid4().hex}'}"
        ranges.coalesce(1).write.parquet(path)
        return self.spark.read.schema(ranges.schema).parquet(path)

    def _holding(self, view: Snapshot, name: str, listed: DataFrame, fresh: DataFrame, keys: list[str]) -> list[str]:
        """The listed files that hold a key of the batch."""
        bounds = fresh.agg(*[F.min(f"low.{k}").alias(f"a{i}") for i, k in enumerate(keys)],
                           *[F.max(f"high.{k}").alias(f"b{i}") for i, k in enumerate(keys)]).first()
        near = listed
        for i, key in enumerate(keys):
            near = near.where((F.col(f"high.{key}") >= F.lit(bounds[f"a{i}"])) & (
                F.col(f"low.{key}") <= F.lit(bounds[f"b{i}"])))
        files = [row[0] for row in near.select("file").collect()]
        if not files:
            return []
        new = view.read_files(name, [row[0] for row in fresh.select("file").collect()]).select(*keys)
        old = view.read_files(name, files).select(*keys, self._own_path().alias("file"))
        return sorted(row[0] for row in old.join(new, keys, "left_semi").select("file").distinct().collect())

    def view(self) -> Snapshot:
        """The tables as this load will leave them, for its own use before it is committed."""
        return Snapshot(self.spark, self.path, {"number": self.before.number + 1, "tables": self.tables})

    def commit(self) -> Snapshot:
        """Make the versions of this load current, in one step."""
        number = self.before.number + 1
        manifest = {"number": number, "loaded_at": self.loaded_at.isoformat(),
                    "tables": self.tables, "changes": self.changes}
        folder = f"{self.path}/manifests"
        draft = f"{folder}/_{uuid.uuid4().hex}"
        paths.write_text(self.spark, draft, json.dumps(manifest))
        if not paths.name_once(self.spark, draft, f"{folder}/{number:012d}.json"):
            paths.delete(self.spark, draft)
            raise ConflictError(f"load {number} of {self.path} was committed by another writer")
        return Snapshot(self.spark, self.path, manifest)


class Store:
    """Versioned tables below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self) -> list[int]:
        names = paths.child_files(self.spark, f"{self.path}/manifests")
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The latest load, or the one of that number; an empty store has load 0 without tables."""
        known = self.numbers()
        if number is None and not known or number == 0:
            return Snapshot(self.spark, self.path, {"number": 0, "tables": {}})
        wanted = known[-1] if number is None else number
        text = paths.read_text(self.spark, f"{self.path}/manifests/{wanted:012d}.json")
        return Snapshot(self.spark, self.path, json.loads(text))

    def read(self, name: str, **ranges: tuple) -> DataFrame:
        return self.snapshot().read(name, **ranges)

    def load(self, loaded_at: datetime) -> Load:
        return Load(self, loaded_at)

    def history(self) -> DataFrame:
        """number, loaded_at, table_name, rows_in, rows_replaced, rows_total of every load that is kept."""
        files = [f"{self.path}/manifests/{n:012d}.json" for n in self.numbers()]
        if not files:
            return self.spark.createDataFrame([], HISTORY).selectExpr("number", "loaded_at", "inline(changes)")
        loads = self.spark.read.schema(HISTORY).json(files)
        return loads.selectExpr("number", "loaded_at", "inline(changes)")

    def expire(self, keep: int) -> None:
        """Forget all but the last `keep` loads, and remove files that no load left refers to.

        Not while a load is being written, as its files are not referred to yet.
        """
        known = self.numbers()
        for number in known[:-keep]:
            paths.delete(self.spark, f"{self.path}/manifests/{number:012d}.json")
        used: set[str] = set()
        for number in known[-keep:]:
            snapshot = self.snapshot(number)
            for name, entry in snapshot.manifest["tables"].items():
                if "folder" in entry:
                    used.add(entry["folder"])
                    continue
                used.add(entry["list"])
                batches = snapshot.files(name).select(F.substring_index("file", "/", 1)).distinct().collect()
                used.update(f"data/{name}/{row[0]}" for row in batches)
        for kind in ("data", "lists"):
            for name in paths.child_folders(self.spark, f"{self.path}/{kind}"):
                for part in paths.child_folders(self.spark, f"{self.path}/{kind}/{name}"):
                    if f"{kind}/{name}/{part}" not in used:
                        paths.delete(self.spark, f"{self.path}/{kind}/{name}/{part}")
