"""Quality scores from a factorisation machine.

The inputs of a text are its hashed words (weights of unit length), statistics of its structure, and
its n_chars where the table has one. Every input has a weight and a short vector; the score is the
logistic of the weighted sum and of the inner products of all pairs of vectors, which the identity
sum over pairs = (square of the sum - sum of the squares) / 2 gives in linear time.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.samples import smallest
from salesloom.llm.texts import chunks, utf8, word_hashes, word_table

BUCKETS = 1 << 16
FACTORS = 8
SAMPLE = 4_000  # labelled rows of each class that the model is fitted on, at most
EPOCHS = 8
BATCH = 64
RATE = 0.1
DECAY = 1e-5
SEED = 7
_CLASSES = ("upper", "lower", "digit", "blank", "break", "mark", "other")
STATISTICS = 14


@lru_cache(maxsize=1)
def _byte_classes() -> np.ndarray:
    table = np.full(256, 5)
    table[65:91], table[97:123], table[48:58] = 0, 1, 2
    table[[9, 11, 12, 13, 32]] = 3
    table[10] = 4
    table[128:] = 6
    return table


class Features(NamedTuple):
    """Inputs of several texts, one text after the other."""

    inputs: np.ndarray
    values: np.ndarray
    owners: np.ndarray
    rows: int


def features(texts: list[bytes], n_chars: np.ndarray) -> Features:
    """Hashed words first, then a statistic each in the places from BUCKETS on."""
    words = word_table(texts)
    bucket = (word_hashes(words) % np.uint64(BUCKETS)).astype(np.int64)
    keys, counts = np.unique(words.owners * BUCKETS + bucket, return_counts=True)
    owners, inputs = keys // BUCKETS, keys % BUCKETS
    weights = np.log1p(counts)
    norms = np.sqrt(np.bincount(owners, weights**2, len(texts)))
    values = weights / norms[owners]
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    kinds = len(_CLASSES)
    classes = np.bincount(
        np.repeat(np.arange(len(texts)) * kinds, sizes) + _byte_classes()[data],
        minlength=len(texts) * kinds).reshape(-1, kinds)
    shares = classes / np.maximum(1, sizes)[:, None]
    n_words = np.maximum(1, words.counts)
    lengths = words.ends - words.starts
    distinct = np.bincount(owners, minlength=len(texts)) / n_words
    mean = np.bincount(words.owners, lengths, len(texts)) / n_words
    square = np.bincount(words.owners, lengths.astype(float) ** 2, len(texts)) / n_words
    commonest = np.zeros(len(texts))
    np.maximum.at(commonest, owners, counts)
    statistics = np.column_stack([
        shares, np.log1p(words.counts) / 8, distinct, np.log1p(mean), np.sqrt(np.maximum(0, square - mean**2)) / 8,
        commonest / n_words, np.log1p(n_chars) / 8, words.counts == 0,
    ])
    places = np.broadcast_to(np.arange(BUCKETS, BUCKETS + STATISTICS), statistics.shape)
    inputs = np.concatenate([inputs, places.ravel()])
    values = np.concatenate([values, statistics.ravel()])
    owners = np.concatenate([owners, np.repeat(np.arange(len(texts)), STATISTICS)])
    return Features(inputs, values, owners, len(texts))


class Model(NamedTuple):
    bias: float
    weights: np.ndarray
    vectors: np.ndarray  # input by factor

    def scores(self, own: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._sums(own)[0], -50, 50)))

    def _sums(self, own: Features) -> tuple[np.ndarray, np.ndarray]:
        """The sum before the logistic, and for every factor the sum of the weighted vectors."""
        linear = np.bincount(own.owners, self.weights[own.inputs] * own.values, own.rows)
        sums, squares = np.zeros((own.rows, self.vectors.shape[1])), np.zeros(own.rows)
        for factor in range(self.vectors.shape[1]):
            terms = self.vectors[own.inputs, factor] * own.values
            sums[:, factor] = np.bincount(own.owners, terms, own.rows)
            squares += np.bincount(own.owners, terms**2, own.rows)
        return self.bias + linear + ((sums**2).sum(axis=1) - squares) / 2, sums


def learn(samples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Adaptive gradient descent on the logistic loss, both classes of equal weight."""
    rng = np.random.default_rng(SEED)
    size = BUCKETS + STATISTICS
    weights, vectors, bias = np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)), 0.0
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    if not len(labels):
        return Model(0.0, weights, np.zeros_like(vectors))
    share = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
    importance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            some = order[start:start + BATCH]
            own = Features(
                np.concatenate([samples[i][0] for i in some]), np.concatenate([samples[i][1] for i in some]),
                np.repeat(np.arange(len(some)), [len(samples[i][0]) for i in some]), len(some))
            total, sums = Model(bias, weights, vectors)._sums(own)
            error = (1 / (1 + np.exp(-np.clip(total, -50, 50))) - labels[some]) * importance[some] / len(some)
            used, at = np.unique(own.inputs, return_inverse=True)
            scaled = error[own.owners] * own.values
            slope = np.bincount(at, scaled, len(used)) + DECAY * weights[used]
            seen_w[used] += slope**2
            weights[used] -= RATE * slope / np.sqrt(seen_w[used])
            square = np.bincount(at, scaled * own.values, len(used))
            slopes = np.column_stack([
                np.bincount(at, scaled * sums[own.owners, f], len(used)) for f in range(FACTORS)])
            slopes += (DECAY - square[:, None]) * vectors[used]
            seen_v[used] += slopes**2
            vectors[used] -= RATE * slopes / np.sqrt(seen_v[used])
            step = error.sum()
            seen_b += step**2
            bias -= RATE * step / np.sqrt(seen_b)
    return Model(bias, weights, vectors)


def _sized(docs: DataFrame):
    """The n_chars of a row, or the length of its text where the table has none, or it is NULL or no number."""
    length = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    if "n_chars" not in docs.columns or not isinstance(docs.schema["n_chars"].dataType, (T.NumericType, T.StringType)):
        return length
    return F.coalesce(F.col("n_chars").try_cast("long"), length)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on `labels` (doc_id, label 0 or 1): at most `sample` rows of each label, by a hash of the id.

    The sample is the only thing that comes to the driver: 2 * `sample` texts at most, as inputs.
    Labels other than 0 and 1, and rows without an id or a text of their own, teach nothing. Of rows
    that share an id, the one whose text has the smallest hash teaches.
    """
    known = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"),
        F.xxhash64("doc_id").alias("mark"))
    # A cut of the hash range first, so that no task puts all rows of a label in order.
    order = Window.partitionBy("label").orderBy("mark", "doc_id")
    chosen = smallest(known, "label", sample).distinct().withColumn(
        "place", F.row_number().over(order)).where(F.col("place") <= sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _sized(docs).alias("n_chars")).where(F.col("text").isNotNull()).join(
        F.broadcast(chosen.select("doc_id", "label")), "doc_id").groupBy("label", "doc_id").agg(
        F.min(F.struct(F.xxhash64("text").alias("mark"), "text", "n_chars")).alias("row")).select(
        "label", "doc_id", "row.text", "row.n_chars")

    def run(batches):
        for batch in chunks(batches):
            own = features(utf8(batch.column("text")), np.maximum(0, batch.column("n_chars").to_numpy()))
            order = np.argsort(own.owners, kind="stable")
            ends = np.r_[0, np.cumsum(np.bincount(own.owners, minlength=own.rows))].astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("label").cast(pa.int32()), batch.column("doc_id").cast(pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(own.inputs[order], pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(own.values[order], pa.float32())),
            ], ["label", "doc_id", "inputs", "values"])

    found = rows.mapInArrow(run, "label int, doc_id long, inputs array<int>, values array<float>").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    samples = [
        (inputs.values.to_numpy().astype(np.int64), inputs_values.values.to_numpy().astype(float))
        for inputs, inputs_values in zip(found["inputs"], found["values"], strict=True)]
    return learn(samples, found["label"].to_numpy().astype(float))


def score(docs: DataFrame, model: Model, into: str = "quality") -> DataFrame:
    """All rows and columns, and `into`: a score from 0 to 1, higher where label 1 is likelier.

    NULL and empty texts have no words and get the score of their statistics. Only the text and its
    n_chars are read. The model, a table of BUCKETS inputs, goes to every task.
    """
    if into in docs.columns:
        raise ValueError(f"the documents have a column {into} already")
    carried = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def rate(text: pa.Array, n_chars: pa.Array) -> pa.Array:
        scores = []
        for part in chunks([pa.record_batch([text, n_chars], ["text", "n_chars"])]):
            own = features(utf8(part.column("text")), np.maximum(0, part.column("n_chars").to_numpy()))
            scores.append(carried.value.scores(own))
        return pa.array(np.concatenate([np.zeros(0), *scores]))

    return docs.select(*[docs[c] for c in docs.columns], rate("text", _sized(docs)).alias(into))
