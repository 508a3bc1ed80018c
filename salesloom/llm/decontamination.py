"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is `size` consecutive words of an item, or the whole of a shorter one. Its tokens are word
shingles, ordered by how often all documents hold them. As a document must hold every shingle of a
window, the necessary prefix is one token, the rarest. Where a document has that token, its place in
the window fixes where the window would start (positional bound), and it must fit into the document
(length bound). What is left is compared word by word.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.texts import HashSet, chunks, ragged, run_hashes, utf8, word_hashes, word_table

SHINGLE = 3
# Item texts that one pass carries to the tasks; more items take more passes over the documents.
SLICE_BYTES = 16 << 20
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def fold(text: bytes) -> bytes:
    """Lower-case A-Z; bytes that are no letter, digit or part of a longer character become spaces."""
    return text.translate(_FOLD)


class Windows(NamedTuple):
    """Distinct windows of a slice of items."""

    texts: list[bytes]  # words joined by spaces
    sizes: np.ndarray  # words
    items: list[list[str]]


def item_windows(items: list[tuple[str, bytes]], size: int) -> Windows:
    found: dict[bytes, set[str]] = defaultdict(set)
    lengths = {}
    for item, text in items:
        words = fold(text).split()
        length = min(size, len(words))
        for start in range(len(words) - length + 1 if words else 0):
            window = b" ".join(words[start:start + length])
            found[window].add(item)
            lengths[window] = length
    return Windows(list(found), np.array([lengths[w] for w in found], np.int64),
                   [sorted(found[w]) for w in found])


def window_shingles(windows: Windows) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By window, the hashes of its shingles in order, keyed with the shingle length (1 to SHINGLE)."""
    result = {}
    for number, text in enumerate(windows.texts):
        words = word_table([text])
        length = min(SHINGLE, int(windows.sizes[number]))
        result[number] = (length, run_hashes(word_hashes(words), length))
    return result


def inner_runs(hashes: np.ndarray, words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs that stay inside one text, and the index of their first words."""
    runs = run_hashes(hashes, length)
    inside = np.flatnonzero(words.owners[: len(runs)] == words.owners[length - 1:]) if len(runs) else np.zeros(0, int)
    return runs[inside], inside


def shingle_frequencies(docs: DataFrame, shingles: dict[int, np.ndarray]) -> dict[int, dict[int, int]]:
    """Occurrences of the given shingles over all documents, by shingle length and hash.

    Each task sends one row per shingle at most, and so does the result: it is as small as the slice.
    """
    sets = {length: HashSet(values) for length, values in shingles.items()}

    def run(batches):
        totals = {length: np.zeros(len(s.values), np.int64) for length, s in sets.items()}
        for batch in chunks(batches):
            words = word_table([fold(t) for t in utf8(batch.column("text"))])
            hashes = word_hashes(words)
            for length, members in sets.items():
                runs, _ = inner_runs(hashes, words, length)
                totals[length] += np.bincount(members.places(runs)[1], minlength=len(members.values))
        for length, members in sets.items():
            some = np.flatnonzero(totals[length])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(some), length), pa.int32()),
                pa.array(members.values[some].view(np.int64)), pa.array(totals[length][some]),
            ], ["length", "shingle", "n"])

    counted = docs.select("text").mapInArrow(run, "length int, shingle long, n long")
    result = {length: {} for length in shingles}
    for row in counted.groupBy("length", "shingle").agg(F.sum("n").alias("n")).collect():
        result[row["length"]][row["shingle"] % 2**64] = row["n"]
    return result


class Index(NamedTuple):
    """By shingle length: the prefix tokens and, in their order, the windows with the token's place."""

    windows: Windows
    tokens: dict[int, HashSet]
    starts: dict[int, np.ndarray]  # of a token's entries
    numbers: dict[int, np.ndarray]  # window of an entry
    offsets: dict[int, np.ndarray]  # place of the token in that window


def build_index(windows: Windows, shingles: dict[int, tuple], frequencies: dict[int, dict[int, int]]) -> Index:
    entries = defaultdict(list)
    for number, (length, hashes) in shingles.items():
        rarity = [(frequencies[length].get(int(h), 0), int(h), place) for place, h in enumerate(hashes)]
        _, token, place = min(rarity)
        entries[length].append((token, number, place))
    tokens, starts, numbers, offsets = {}, {}, {}, {}
    for length, rows in entries.items():
        rows.sort()
        values = np.array([r[0] for r in rows], np.uint64)
        tokens[length] = HashSet(values)
        starts[length] = np.r_[np.searchsorted(values, tokens[length].values), len(rows)]
        numbers[length] = np.array([r[1] for r in rows], np.int64)
        offsets[length] = np.array([r[2] for r in rows], np.int64)
    return Index(windows, tokens, starts, numbers, offsets)


def find_windows(index: Index, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and window number of every occurrence; then the words of each text."""
    words = word_table([fold(t) for t in texts])
    hashes = word_hashes(words)
    lasts = words.firsts + words.counts
    firsts, found = [], []
    for length, members in index.tokens.items():
        runs, at = inner_runs(hashes, words, length)
        hit, token = members.places(runs)
        sizes = index.starts[length][token + 1] - index.starts[length][token]
        entries = ragged(index.starts[length][token], sizes)
        number = index.numbers[length][entries]
        start = np.repeat(at[hit], sizes) - index.offsets[length][entries]
        owner = np.repeat(words.owners[at[hit]], sizes)
        fits = (start >= words.firsts[owner]) & (start + index.windows.sizes[number] <= lasts[owner])
        firsts.append(start[fits])
        found.append(number[fits])
    start = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    number = np.concatenate(found) if found else np.zeros(0, np.int64)
    last = start + index.windows.sizes[number] - 1 if len(start) else start
    lefts, rights = words.starts[start], words.ends[last]
    same = np.array([
        words.flat[a:b] == index.windows.texts[w]
        for a, b, w in zip(lefts.tolist(), rights.tolist(), number.tolist(), strict=True)], bool)
    start, number = start[same], number[same]
    owner = words.owners[start]
    return owner, start - words.firsts[owner], number, words.counts


def _scan(docs: DataFrame, index: Index) -> DataFrame:
    """row columns, n_words, the ranges of hit words and the items found, of every document."""

    def run(batches):
        for batch in chunks(batches):
            owner, start, number, counts = find_windows(index, utf8(batch.column("text")))
            ranges = [[] for _ in range(batch.num_rows)]
            items = [set() for _ in range(batch.num_rows)]
            for i, s, w in sorted(zip(owner.tolist(), start.tolist(), number.tolist(), strict=True)):
                end = s + int(index.windows.sizes[w])
                if ranges[i] and ranges[i][-1]["b"] >= s:
                    ranges[i][-1]["b"] = max(end, ranges[i][-1]["b"])
                else:
                    ranges[i].append({"a": s, "b": end})
                items[i].update(index.windows.items[w])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()),
                pa.array(ranges, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                pa.array([sorted(s) for s in items], pa.list_(pa.string())),
            ], ["doc_id", "text_key", "n_words", "ranges", "items"])

    return docs.mapInArrow(
        run, "doc_id long, text_key long, n_words long, ranges array<struct<a:long,b:long>>, items array<string>")


def _covered():
    """Words in a sorted list of ranges that may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(
        F.array_sort("ranges"), start,
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), r["b"] - F.greatest(r["a"], acc["upto"]))).alias("n"),
            F.greatest(acc["upto"], r["b"]).alias("upto")),
        lambda acc: acc["n"])


def find_contamination(docs: DataFrame, items: DataFrame, size: int = 13,
                       slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, text_key (xxhash64), n_words, n_hit, n_items, items (sorted) and contaminated of every document.

    A word inside any occurrence of a window is hit; a document is contaminated if at least a
    twentieth of its words, and at least one, are hit. NULL and empty texts have no words. Items
    without words have no window; a NULL item_id is left out of the list of items, its windows hit all
    the same. Rows of one doc_id and one text give one row each. Items beyond `slice_bytes` are
    compared slice by slice, so what a task holds does not grow with the benchmark.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    bench = items.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = bench.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    slices = int(total // slice_bytes) + 1
    parts = []
    for number in range(slices):
        own = bench.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == number)
        texts = [(r["item_id"] or "", r["text"].encode()) for r in own.collect()]
        windows = item_windows(texts, size)
        if not windows.texts and number < slices - 1:
            continue
        shingles = window_shingles(windows)
        by_length = {
            length: np.concatenate([h for n, h in shingles.values() if n == length])
            for length in {n for n, _ in shingles.values()}}
        frequencies = shingle_frequencies(rows, by_length) if by_length else {}
        parts.append(_scan(rows, build_index(windows, shingles, frequencies)))
    found = parts[0]
    if len(parts) > 1:
        # Each part holds every row once; equal rows are numbered together and divided afterwards.
        for part in parts[1:]:
            found = found.unionByName(part)
        found = found.groupBy("doc_id", "text_key").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("ranges")).alias("ranges"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count("*") / len(parts)).cast("int").alias("copies"))
        found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    hit = _covered()
    named = F.filter("items", lambda item: item != "")
    return found.select(
        "doc_id", "text_key", "n_words", hit.alias("n_hit"), named.alias("items"),
        F.size(named).cast("long").alias("n_items"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
