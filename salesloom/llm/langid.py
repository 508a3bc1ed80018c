"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a
word is the sum over all its segmentations into pieces, from a forward algorithm, and a text's is the
product over its words. Piece probabilities are fitted by expectation maximisation on words of a
bounded sample of labelled texts, with the backward algorithm for the expected counts. The work per
text is a lookup per word: the forward algorithm runs once per distinct word of a task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.samples import smallest
from salesloom.llm.texts import HashSet, chunks, mix, span_hashes

SAMPLE = 1_000  # labelled texts of a language that the model is fitted on, at most
ROUNDS = 4
SMOOTHING = 0.1  # added to the expected count of every piece
LETTERS = 64  # a longer word is scored in parts of so many letters
CACHED_WORDS = 200_000
_SPACE = "▁"
_WORD = re.compile(r"[^\W\d_]+")
_SCALE = 24.0  # per letter; keeps products of a word near one
_UNKNOWN = 1e-7  # of a letter without a piece, in every language


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, int]:
    """Pieces of lower-case letters, with or without the space mark in front, and the mark itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_byte(i))
    kept = {p for p in pieces if (p.removeprefix(_SPACE).isalpha() and p == p.lower()) or p == _SPACE}
    return {p: i for i, p in enumerate(sorted(kept))}


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased, with the space mark in front; long runs in parts."""
    if not text:
        return []
    found = []
    for word in _WORD.findall(text.lower()):
        if word.isalpha():
            parts = (word,)
        else:  # \w also has number signs that are no letters
            parts = re.findall(r"\S+", "".join(c if c.isalpha() else " " for c in word))
        for part in parts:
            if len(part) <= LETTERS:
                found.append(_SPACE + part)
            else:
                found.extend(_SPACE * (i == 0) + part[i:i + LETTERS] for i in range(0, len(part), LETTERS))
    return found


def _letter_values(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    return mix(points + np.uint64(1))


class Pieces:
    """The vocabulary by length, as hashes that all substrings of many words are looked up in."""

    def __init__(self, numbers: dict[str, int]):
        self.size = len(numbers)
        self.by_length: dict[int, tuple[HashSet, np.ndarray]] = {}
        for length in sorted({len(p) for p in numbers}):
            own = [p for p in numbers if len(p) == length]
            starts = np.arange(len(own)) * length
            hashes = span_hashes(_letter_values("".join(own)), starts, starts + length)
            order = np.argsort(hashes)
            self.by_length[length] = HashSet(hashes), np.array([numbers[p] for p in own], np.int64)[order]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(vocabulary(path))


class Lattice:
    """All pieces inside the words of a batch: word, where it ends, its length, and its number."""

    def __init__(self, words: list[str], pieces: Pieces):
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        values = _letter_values("".join(words))
        firsts = np.cumsum(self.sizes) - self.sizes
        owner = np.repeat(np.arange(len(words)), self.sizes)
        place = np.arange(len(values)) - firsts[owner]
        room = self.sizes[owner] - place
        starts, lengths, numbers = [], [], []
        single = np.zeros(len(values), bool)
        for length, (members, own) in pieces.by_length.items():
            at = np.flatnonzero(room >= length)
            hit, found = members.places(span_hashes(values, at, at + length))
            starts.append(at[hit])
            lengths.append(np.full(len(hit), length))
            numbers.append(own[found])
            if length == 1:
                single[at[hit]] = True
        alone = np.flatnonzero(~single)  # letters that are no piece
        start = np.concatenate([*starts, alone]).astype(np.int64)
        length = np.concatenate([*lengths, np.ones(len(alone))]).astype(np.int64)
        number = np.concatenate([*numbers, np.full(len(alone), -1)]).astype(np.int64)
        end = place[start] + length
        order = np.argsort(end, kind="stable")
        self.rows, self.ends, self.lengths, self.numbers = (
            x[order] for x in (owner[start], end, length, number))
        self.cuts = np.searchsorted(self.ends, np.arange(1, self.sizes.max(initial=0) + 2))

    def weights(self, probabilities: np.ndarray) -> np.ndarray:
        """Scaled probability of every edge in every language."""
        known = np.vstack([probabilities, np.full(probabilities.shape[1], _UNKNOWN)])
        return known[self.numbers] * _SCALE ** self.lengths[:, None]

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """alpha[word, position, language]: scaled probability of the word's first letters."""
        alpha = np.zeros((len(self.sizes), self.sizes.max(initial=0) + 1, weights.shape[1]))
        alpha[:, 0] = 1.0
        for end in range(1, alpha.shape[1]):
            some = slice(self.cuts[end - 1], self.cuts[end])
            rows = self.rows[some]
            terms = alpha[rows, end - self.lengths[some]] * weights[some]
            for language in range(weights.shape[1]):
                alpha[:, end, language] = np.bincount(rows, terms[:, language], len(self.sizes))
        return alpha

    def expected(self, weights: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
        """Expected uses of every piece: `counts` has how often each language holds each word."""
        alpha = self.forward(weights)
        beta = np.zeros_like(alpha)
        everyone = np.arange(len(self.sizes))
        beta[everyone, self.sizes] = 1.0
        for end in range(alpha.shape[1] - 1, 0, -1):
            some = slice(self.cuts[end - 1], self.cuts[end])
            np.add.at(beta, (self.rows[some], end - self.lengths[some]),
                      beta[self.rows[some], end] * weights[some])
        total = alpha[everyone, self.sizes]
        uses = alpha[self.rows, self.ends - self.lengths] * weights * beta[self.rows, self.ends]
        uses *= (counts / np.maximum(total, 1e-300))[self.rows]
        result = np.zeros((size + 1, weights.shape[1]))
        np.add.at(result, self.numbers, uses)
        return result[:size]


BATCH = 4_000


def word_scores(words: list[str], pieces: Pieces, probabilities: np.ndarray) -> np.ndarray:
    """Log-probability of each word in each language, all segmentations summed."""
    result = np.zeros((len(words), probabilities.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for start in range(0, len(words), BATCH):
        some = order[start:start + BATCH]
        lattice = Lattice([words[i] for i in some], pieces)
        alpha = lattice.forward(lattice.weights(probabilities))
        last = alpha[np.arange(len(some)), lattice.sizes]
        result[some] = np.log(np.maximum(last, 1e-300)) - lattice.sizes[:, None] * np.log(_SCALE)
    return result


def sample_texts(docs: DataFrame, size: int) -> DataFrame:
    """lang and text of at most `size` distinct labelled texts of a language, those with the smallest hashes.

    Distinct texts are counted per language and step of the hash range first; a cut that lets through
    little more than `size` of them comes before they are put in order, so that no task sees a language
    as a whole. The counts, and the model, have a bounded number of entries per language.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("mark"), "text")
    order = Window.partitionBy("lang").orderBy("mark", "text")
    placed = smallest(labelled, "lang", size).dropDuplicates(["lang", "mark"]).withColumn(
        "place", F.row_number().over(order))
    return placed.where(F.col("place") <= size).select("lang", "text")


def count_words(sample: DataFrame) -> DataFrame:
    """lang, word and n of a sample."""

    def run(batches):
        for batch in chunks(batches):
            counts: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts.update((lang, word) for word in words_of(text))
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])

    return sample.select("lang", "text").mapInArrow(run, "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Languages, sorted, and the probability of every piece in each of them."""

    def __init__(self, path: str, languages: list[str], probabilities: np.ndarray):
        self.path, self.languages, self.probabilities = path, languages, probabilities


def fit(docs: DataFrame, path: str, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Fit on rows with a lang and a text: at most `sample` distinct texts of a language.

    The words of the sample, at most `sample` texts for each language, are counted in Spark and
    fitted where they are; only expected counts per piece and language come to the driver.
    """
    counted = count_words(sample_texts(docs, sample)).groupBy("word").agg(
        F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("counts")).repartition("word").checkpoint()
    languages = [r["lang"] for r in counted.select(F.explode(F.map_keys("counts")).alias("lang")).distinct().sort("lang").collect()]
    size = pieces_of(path).size
    probabilities = np.full((size, max(1, len(languages))), 1.0 / max(1, size))
    place = {lang: i for i, lang in enumerate(languages)}

    def expectations(probabilities):
        def run(batches):
            pieces = pieces_of(path)
            total = np.zeros(probabilities.shape)
            for batch in batches:
                words = batch.column("word").to_pylist()
                counts = np.zeros((len(words), len(languages)))
                for row, entries in enumerate(batch.column("counts").to_pylist()):
                    for lang, n in entries:
                        counts[row, place[lang]] = n
                order = sorted(range(len(words)), key=lambda i: len(words[i]))
                for start in range(0, len(order), BATCH):
                    some = order[start:start + BATCH]
                    lattice = Lattice([words[i] for i in some], pieces)
                    total += lattice.expected(lattice.weights(probabilities), counts[some], pieces.size)
            used = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([
                pa.array(used, pa.int32()),
                pa.array(total[used].tolist(), pa.list_(pa.float64()))], ["piece", "uses"])

        return run

    for _ in range(rounds if languages else 0):
        sums = [F.sum(F.col("uses")[i]).alias(f"l{i}") for i in range(len(languages))]
        rows = counted.mapInArrow(expectations(probabilities), "piece int, uses array<double>").groupBy(
            "piece").agg(*sums).collect()
        uses = np.full(probabilities.shape, SMOOTHING)
        for row in rows:
            uses[row["piece"]] += [row[f"l{i}"] for i in range(len(languages))]
        probabilities = uses / uses.sum(axis=0)
    return Model(path, languages, probabilities)


class Scorer:
    """Scores texts in a task; remembers a bounded number of words."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, pieces_of(model.path)
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, model.probabilities.shape[1]))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its posterior probability, languages equally likely beforehand."""
        languages = self.model.languages
        if not languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        split = [words_of(text) for text in texts]
        if len(self.known) > CACHED_WORDS:
            self.known, self.table = {}, self.table[:0]
        new = list(set(chain.from_iterable(split)).difference(self.known))
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.table = np.vstack([self.table, word_scores(new, self.pieces, self.model.probabilities)])
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        totals = np.zeros((len(texts), len(languages)))
        some = np.flatnonzero(sizes)
        if len(some):
            totals[some] = np.add.reduceat(self.table[at], (np.cumsum(sizes) - sizes)[some], axis=0)
        shares = np.exp(totals - totals.max(axis=1, keepdims=True))
        shares /= shares.sum(axis=1, keepdims=True)
        best = shares.argmax(axis=1)
        scores = np.where(sizes > 0, shares[np.arange(len(texts)), best], 0.0)
        return [languages[b] if n else "und" for b, n in zip(best.tolist(), sizes.tolist(), strict=True)], scores


_RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def identify(docs: DataFrame, model: Model, into: str = "language") -> DataFrame:
    """All rows and columns, and a struct `into` of lang_pred and score.

    lang_pred is one of the model's languages, and `und` with score 0 where the text is NULL or has no
    letter, or where there was nothing to learn from. Ties go to the first language in alphabetical
    order. Only the text is read. Long texts are read whole.
    """
    if into in docs.columns:
        raise ValueError(f"the documents have a column {into} already")
    carried = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(_RESULT)
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(carried.value)  # of the task; words stay known from batch to batch
        for column in columns:
            langs, scores = [], [np.zeros(0)]
            for part in chunks([pa.record_batch([column], ["text"])]):
                names, values = scorer.predict(part.column("text").to_pylist())
                langs.extend(names)
                scores.append(values)
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(np.concatenate(scores))], ["lang_pred", "score"])

    return docs.select(*[docs[c] for c in docs.columns], predict("text").alias(into))

