"""Embedding near-duplicates from randomised-rotation binary codes with stored correction factors.

A unit vector is rotated by a random orthogonal matrix and kept as the signs of its components, with
one factor: its inner product with its own code. The inner product of two vectors is estimated
without bias from one vector and the other's code, divided by that factor, and a confidence bound
follows from the factor and the dimension. A pair whose upper bound is below the threshold is
dismissed; every other pair is computed exactly in double precision, and only that decides.

Pairs are looked for in the buckets of several tables, each keyed by signs of further random
directions. Bits grow with the logarithm of the rows, so that buckets of unlike vectors stay small,
and tables grow with the bits, so that a pair at the threshold meets with the stated probability.
Equal vectors are one node with a weight. Buckets beyond BLOCK rows are cut into blocks that are
compared block by block in tasks of their own.
"""

from __future__ import annotations

import math
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.components import connected_components
from salesloom.session import shared_folder

SEED = 11
RECALL = 0.98  # of pairs exactly at the threshold; closer pairs meet more often
BUCKET = 8  # rows of a label that share a bucket by chance, about
BLOCK = 1024
DEVIATIONS = 5.0  # width of the confidence bound, in standard deviations


@lru_cache(maxsize=8)
def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    matrix, triangle = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return matrix * np.sign(np.diag(triangle))


def encode(units: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their code vectors (signs over the root of the dimension), and the factors."""
    rotated = units @ turn
    codes = np.where(rotated >= 0, 1.0, -1.0) / math.sqrt(units.shape[1])
    return rotated, codes, np.einsum("ij,ij->i", rotated, codes)


def upper_bounds(rotated: np.ndarray, codes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Upper confidence bound of the inner product of every vector (rows) with every coded vector."""
    size = max(2, codes.shape[1])
    estimates = rotated @ codes.T / factors
    spread = np.sqrt(np.maximum(0, 1 - factors**2) / (factors**2 * (size - 1)))
    return estimates + DEVIATIONS * spread


def plan_tables(rows: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a key and number of tables for labels of at most `rows` distinct vectors."""
    bits = max(1, math.ceil(math.log2(max(2, rows / BUCKET))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and embedding of rows that can link: labelled, finite, not zero."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("embedding", lambda x: x == 0)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        "embedding")
    return rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~bad & ~zero)


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column, all of one size, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _units(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # no overflow of squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


@lru_cache(maxsize=8)
def _directions(size: int, count: int) -> np.ndarray:
    return np.random.default_rng(SEED + 1).standard_normal((size, count))


def table_keys(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The key of each vector in each table."""
    signs = (units @ _directions(units.shape[1], bits * tables) >= 0).reshape(len(units), tables, bits)
    return signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def _with_keys(bits: int, tables: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.diff(batch.column("embedding").offsets.to_numpy())
            keys: list = [None] * batch.num_rows
            for size in np.unique(sizes):  # vectors of several sizes never link
                at = np.flatnonzero(sizes == size)
                matrix = _matrix(batch.column("embedding").take(pa.array(at)))
                for i, own in zip(at.tolist(), table_keys(_units(matrix), bits, tables), strict=True):
                    keys[i] = own
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.list_(pa.int64()))], [*batch.schema.names, "keys"])

    return run


def _stars(size: int, found: list) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the smallest row that links inside the group reach from them, where it is another."""
    low = np.arange(size)
    while found:
        before = low.copy()
        for x, y in found:
            least = np.minimum(low[x], low[y])
            np.minimum.at(low, x, least)
            np.minimum.at(low, y, least)
        low = low[low]
        if (low == before).all():
            break
    moved = np.flatnonzero(low != np.arange(size))
    return moved, low[moved]


class Prepared(NamedTuple):
    units: np.ndarray
    rotated: np.ndarray
    codes: np.ndarray
    factors: np.ndarray
    keys: np.ndarray


def _links(own: Prepared, a: np.ndarray, b: np.ndarray, table: int, threshold: float):
    """Linked pairs of rows a with rows b (or inside a) that share no table before this one."""
    inside = a is b
    for start in range(0, len(a), BLOCK):
        some = a[start:start + BLOCK]
        i, j = np.nonzero(upper_bounds(own.rotated[some], own.codes[b], own.factors[b]) >= threshold)
        i, j = some[i], b[j]
        if inside:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), 1 << 15):
            x, y = i[part:part + (1 << 15)], j[part:part + (1 << 15)]
            close = np.einsum("ij,ij->i", own.units[x], own.units[y]) >= threshold
            x, y = x[close], y[close]
            new = ~(own.keys[x, :table] == own.keys[y, :table]).any(axis=1)
            yield x[new], y[new]


_GROUP = ("dimension", "label_key", "table", "key", "left", "right")


def _compare(threshold: float, bits: int, tables: int):
    """Rows come sorted by _GROUP; whole groups are looked at together."""

    def look(rows: pa.Table):
        marks = {n: rows[n].to_numpy() for n in _GROUP}
        changed = np.zeros(rows.num_rows - 1, bool)
        for mark in marks.values():
            changed |= mark[1:] != mark[:-1]
        starts = np.r_[0, np.flatnonzero(changed) + 1]
        stops = np.r_[starts[1:], rows.num_rows]
        nodes, weights, block = (rows[n].to_numpy() for n in ("node", "weight", "block"))
        dimension = marks["dimension"]
        sums, stars = [], []
        for size in np.unique(dimension):
            at = np.flatnonzero(dimension == size)
            base = at[0]
            units = _units(_matrix(rows["embedding"].slice(base, len(at)).combine_chunks()))
            own = Prepared(units, *encode(units, rotation(int(size))), table_keys(units, bits, tables))
            for start, stop in zip(starts, stops, strict=True):
                if stop - start < 2 or not base <= start < base + len(at):
                    continue
                left, right = marks["left"][start], marks["right"][start]
                members = np.arange(start, stop)
                a = members[block[start:stop] == left] - base
                b = a if left == right else members[block[start:stop] == right] - base
                found = []
                for x, y in _links(own, a, b, int(marks["table"][start]), threshold):
                    if len(x):
                        found.append((x + base - start, y + base - start))
                if not found:
                    continue
                linked = np.zeros(stop - start, np.int64)
                for x, y in found:
                    np.add.at(linked, x, weights[start + y])
                    np.add.at(linked, y, weights[start + x])
                some = np.flatnonzero(linked)
                sums.append((nodes[start + some], linked[some], nodes[start + some]))
                moved, low = _stars(stop - start, found)
                stars.append((nodes[start + moved], np.zeros(len(moved), np.int64), nodes[start + low]))
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(column)) for column in zip(*sums, *stars, strict=True)],
                ["node", "links", "other"])

    def run(batches):
        waiting, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            count += batch.num_rows
            if count < 4 * BLOCK:
                continue
            rows = pa.Table.from_batches(waiting)
            last = np.ones(rows.num_rows, bool)
            for name in _GROUP:
                mark = rows[name].to_numpy()
                last &= mark == mark[-1]
            cut = rows.num_rows - int(last.sum())
            if cut:
                yield from look(rows.slice(0, cut))
                waiting, count = rows.slice(cut).to_batches(), count - cut
        if waiting:
            yield from look(pa.Table.from_batches(waiting))

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows link if their labels are equal and their cosine, in double precision, is `threshold` or more.
    A row that cannot link (no label, no vector, a zero vector, a component that is NULL or not
    finite) stands alone, and so do vectors of different sizes. No link below the threshold is made;
    `recall` is the chance of finding a pair just at it. Rows of one vec_id give one row each. A NULL
    vec_id links and is counted by others but is never the smallest of a component.
    """
    shared_folder(vectors.sparkSession)
    rows = usable(vectors)
    identity = F.struct("label", "embedding")
    digest = F.sha2(F.to_json(F.struct("label", "embedding")), 256)
    rows = rows.withColumn("digest", digest)
    nodes = rows.groupBy("digest").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"),
        F.count("*").alias("weight"), F.min("vec_id").alias("first_vec"),
    ).withColumn("node", F.monotonically_increasing_id()).checkpoint()
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(largest, threshold, recall)
    kind = nodes.schema["embedding"].dataType.simpleString()
    points = nodes.select(
        "node", F.xxhash64("label").alias("label_key"), F.size("embedding").alias("dimension"), "weight", "embedding")
    keyed = points.mapInArrow(_with_keys(bits, tables), (
        f"node long, label_key long, dimension int, weight long, embedding {kind}, keys array<long>"))
    placed = keyed.select("*", F.posexplode("keys").alias("table", "key")).drop("keys")
    bucket = ["dimension", "label_key", "table", "key"]
    sizes = placed.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    cut = placed.join(sizes, bucket).withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node", "table"), F.col("blocks")).cast("int"))
    # each row goes to the tasks of its block with every block, its own included
    spread = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *bucket, "node", "weight", "embedding", "block",
        F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    found = spread.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(
        _compare(threshold, bits, tables), "node long, links long, other long").checkpoint()
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select("node", "other")).withColumnRenamed("node", "linked")
    grouped = nodes.select("digest", "node", "weight", "first_vec").join(counts, "node", "left").join(
        roots, F.col("node") == F.col("linked"), "left").select(
        "digest", "first_vec", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    least = grouped.groupBy("root").agg(F.min("first_vec").alias("component_id"))
    known = grouped.join(least, "root").select("digest", "n_links", "component_id")
    # one row per input row: those that can link meet their node, the others stand alone
    linked = rows.select("vec_id", "digest").join(known, "digest").select("vec_id", "n_links", "component_id")
    alone = _alone(vectors)
    result = linked.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                             F.col("vec_id").alias("component_id")))
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _alone(vectors: DataFrame) -> DataFrame:
    """vec_id of the rows that `usable` leaves out."""
    values = F.col("embedding").cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(values, lambda x: x == 0)
    return vectors.where(F.coalesce(F.col("label").isNull() | values.isNull() | bad | zero, F.lit(True))).select(
        F.col("vec_id").cast("long").alias("vec_id"))
