"""Language identification and quality: brute force, held-out accuracy, odd tables."""

import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.llm import langid, quality

FOLDER = "/root/testdata/sf0.01"


def test_forward_sums_all_segmentations(tokenizer_path):
    path = tokenizer_path("piece_bpe_32k.model")
    numbers = langid.vocabulary(path)
    probabilities = np.random.default_rng(1).dirichlet(np.ones(len(numbers)), 3).T
    words = ["▁the", "▁hello", "▁éaux", "ñ日a", "▁x"]
    got = langid.word_scores(words, langid.pieces_of(path), probabilities)
    for word, scores in zip(words, got, strict=True):
        total = np.zeros(3)
        for cuts in product((0, 1), repeat=len(word) - 1):
            term, start = np.ones(3), 0
            for end in range(1, len(word) + 1):
                if end == len(word) or cuts[end - 1]:
                    piece, start = word[start:end], end
                    unknown = langid._UNKNOWN if len(piece) == 1 else 0.0
                    term = term * (probabilities[numbers[piece]] if piece in numbers else unknown)
            total += term
        assert np.log(total) == pytest.approx(scores)


def test_expected_counts_are_those_of_all_segmentations(tokenizer_path):
    path = tokenizer_path("piece_bpe_32k.model")
    numbers = langid.vocabulary(path)
    probabilities = np.random.default_rng(2).dirichlet(np.ones(len(numbers)), 2).T
    word = "▁with"
    lattice = langid.Lattice([word], langid.pieces_of(path))
    got = lattice.expected(lattice.weights(probabilities), np.array([[1.0, 2.0]]), len(numbers))
    want, total = np.zeros_like(got), np.zeros(2)
    for cuts in product((0, 1), repeat=len(word) - 1):
        edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        pieces = [word[a:b] for a, b in zip(edges, edges[1:])]
        if all(p in numbers for p in pieces):
            share = np.prod([probabilities[numbers[p]] for p in pieces], axis=0)
            total += share
            for p in pieces:
                want[numbers[p]] += share
    assert got == pytest.approx(want / total * [1.0, 2.0], abs=1e-9)


def test_words_are_whole():
    assert langid.words_of("Ab²c 12 x_y") == ["▁ab", "▁c", "▁x", "▁y"]
    long = langid.words_of("a" * 150)
    assert "".join(long) == "▁" + "a" * 150 and langid.words_of(None) == []


@pytest.fixture(scope="module")
def language(spark, tokenizer_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return docs, held, langid.fit(docs.where(~held), tokenizer_path("piece_bpe_32k.model"), sample=100, rounds=2)


def test_held_out_languages(language):
    docs, held, model = language
    rows = langid.identify(docs.where(held), model).select("lang", "language.*").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in rows)
    assert len(rows) > 200 and right >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_texts(language, documents):
    odd = documents([(1, None), (2, ""), (3, "12 ²½ !!"), (None, "the and of"), (4, "the and of"), (4, "the and of")])
    found = langid.identify(odd.withColumn("score", F.lit(1)), language[2])
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "language"]
    got = [(r["doc_id"], r["language"]["lang_pred"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "und"), (2, "und"), (3, "und"), (None, "en"), (4, "en"), (4, "en")], key=str)


def test_nothing_to_learn_languages_from(documents, tokenizer_path):
    model = langid.fit(documents([]), tokenizer_path("piece_bpe_32k.model"))
    row = langid.identify(documents([(1, "abc")]), model).first()["language"]
    assert tuple(row) == ("und", 0.0)


def test_pair_sum_identity():
    rng = np.random.default_rng(4)
    own = quality.features([b"a b c a", b"", b"Some MORE words! 12\n"], np.array([7, 0, 20]))
    size = quality.BUCKETS + quality.STATISTICS
    model = quality.Model(0.3, rng.normal(size=size), rng.normal(size=(size, quality.FACTORS)))
    for row, score in enumerate(model.scores(own)):
        at = np.flatnonzero(own.owners == row)
        total = model.bias + model.weights[own.inputs[at]] @ own.values[at]
        for n, i in enumerate(at):
            for j in at[:n]:
                total += model.vectors[own.inputs[i]] @ model.vectors[own.inputs[j]] * own.values[i] * own.values[j]
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def test_held_out_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = quality.fit(docs, labels.where(~held), sample=1000)
    rows = quality.score(docs, model).join(labels.where(held), "doc_id").select("label", "quality").collect()
    for label in (0, 1):
        own = [r["quality"] >= 0.5 for r in rows if r["label"] == label]
        assert len(own) > 50 and np.mean(np.array(own) == label) >= 0.95


def test_quality_of_odd_tables(spark, documents):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(9)) if i % 2 else "!! " * 9) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (1, None), (2, 7), (99, 1)], "doc_id long, label int")
    model = quality.fit(documents(rows), labels)
    odd = documents([(1, None), (2, ""), (None, "a b"), (3, "x" * 200_000)])
    found = quality.score(odd.drop("n_chars").withColumn("weights", F.lit(1)), model)
    scores = [r["quality"] for r in found.collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    assert quality.score(documents([]), model).count() == 0
    empty = quality.fit(documents([]), labels.limit(0))
    assert quality.score(documents(rows), empty).first()["quality"] == 0.5
    with pytest.raises(ValueError):
        quality.score(odd.withColumn("quality", F.lit(1)), model)


def test_repeated_ids_and_odd_sizes(spark, documents):
    rows = [(1, f"good words here {i % 7}") for i in range(3000)] + [(2, "!! ## 99")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0)], "doc_id long, label int")
    docs = documents(rows)
    model = quality.fit(docs, labels, sample=5)
    alone = quality.fit(docs.groupBy("doc_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"), F.max("n_chars").alias("n_chars")), labels, sample=5)
    assert np.array_equal(model.weights, alone.weights) and model.bias == alone.bias
    sized = quality.score(documents([(1, "good words")]), model).first()["quality"]
    for odd in (F.lit("many"), F.array(F.lit(1)), F.lit(None).cast("string"), F.lit("10")):
        found = quality.score(documents([(1, "good words")]).withColumn("n_chars", odd), model).first()
        assert found["quality"] == sized
        quality.fit(docs.withColumn("n_chars", odd), labels, sample=5)


def test_copies_do_not_thin_the_sample_of_a_language(documents):
    rows = [(i, f"text {i % 5}", "aa") for i in range(2000)] + [(i, f"other {i}", "bb") for i in range(300)]
    found = langid.sample_texts(documents(rows), 10).collect()
    assert sorted(r["text"] for r in found if r["lang"] == "aa") == [f"text {i}" for i in range(5)]
    assert sum(r["lang"] == "bb" for r in found) == 10


def test_copies_do_not_thin_the_sample_of_a_label(spark, documents):
    docs = documents([(i, "good words here" if i % 2 else "!! ## 99") for i in range(4)])
    labels = spark.range(4000).selectExpr("id % 4 AS doc_id", "cast(id % 2 AS int) AS label")
    rows = quality.score(docs, quality.fit(docs, labels, sample=10)).collect()
    assert all((r["quality"] > 0.5) == (r["doc_id"] % 2 == 1) and r["quality"] != 0.5 for r in rows)
