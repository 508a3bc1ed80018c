"""Phrase collocations from sorted count streams, read in prefix order and in suffix order.

Every word opens a window: itself and the words that follow it in its piece, up to the longest phrase.
Tasks sort and count the windows of a chunk and send one packed stream to each range of windows. There
the streams are merged, and the counts of all phrases that begin a window are sums of neighbouring
rows, so one pass counts the phrases of all lengths. Groups that a range boundary cuts are the first
and last of a range; only those are added up once more.

Frequent phrases are then read in two orders. In prefix order a phrase follows the phrases that begin
it, in suffix order those that end it, so one pass that remembers the last phrase of each length knows
the counts of all its left or right parts, and the largest count of the phrases one word longer. What
crosses range boundaries is a few numbers per range. No phrase is looked up in a hash table.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.texts import chunks, utf8
from salesloom.session import shared_folder

LONGEST = 4  # words of a phrase
CHUNK = 8 << 20  # bytes of text whose windows are counted together
RANGES = 4  # for each shuffle partition, which takes one range at a time
SAMPLED = 64  # windows for each range
SCALE = 2_000_000
# Characters between pieces, and between words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \x09"
_TO_BREAK = bytes.maketrans(BREAKS + BLANKS, b"\n" * len(BREAKS) + b" " * len(BLANKS))
UNKNOWN = "und"


def word_stream(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in byte order, and the words of all texts as 1, 2, ...; 0 ends a piece."""
    data = b"\n".join(texts).lower().translate(_TO_BREAK).replace(b"\n", b" \n ")
    found = pa.array(data.split(b" "), pa.binary()).dictionary_encode()
    words = found.dictionary.to_pylist()
    order = sorted(range(len(words)), key=words.__getitem__)
    order = [i for i in order if words[i] not in (b"", b"\n")]
    number = np.zeros(len(words), np.int64)
    number[order] = np.arange(1, len(order) + 1)
    blank = np.array([word == b"" for word in words], bool)
    codes = found.indices.to_numpy(zero_copy_only=False)
    vocabulary = pa.array([words[i] for i in order], pa.binary()).cast(pa.string())
    return vocabulary, number[codes[~blank[codes]]]


def distinct_rows(columns: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of columns of small numbers in order, and the sums of their counts."""
    # Two columns become the rank of their pair, which keeps the order, until one number is left.
    levels, key = [], columns[0]
    for column in columns[1:]:
        pairs, key = np.unique(key << 32 | column, return_inverse=True)
        levels.append(pairs)
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.diff(key[order], prepend=-1))
    sums = np.add.reduceat(counts[order], starts) if len(starts) else counts
    keys = key[order[starts]]
    found = []
    for pairs in reversed(levels):
        found.append(pairs[keys] & 0xFFFFFFFF)
        keys = pairs[keys] >> 32
    return np.stack([keys, *reversed(found)], axis=1), sums


def windows(stream: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows in order, one row each with 0 behind the end of the piece, and their counts."""
    padded = np.r_[stream, np.zeros(longest, np.int64)]
    size = len(stream)
    columns = [padded[:size]]
    for step in range(1, longest):
        columns.append(np.where(columns[-1] > 0, padded[step:step + size], 0))
    own = np.flatnonzero(columns[0])
    return distinct_rows([column[own] for column in columns], np.ones(len(own), np.int64))


def _names(longest: int) -> list[str]:
    return [f"w{k}" for k in range(1, longest + 1)]


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    texts, langs = utf8(batch.column("text")), batch.column("lang").dictionary_encode()
    own = langs.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(own, kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(own[order]) != 0]).tolist()
    for start, stop in zip(edges, [*edges[1:], len(order)], strict=True):
        yield langs.dictionary[int(own[order[start]])].as_py(), [texts[i] for i in order[start:stop].tolist()]


def split_points(rows: DataFrame, longest: int, ranges: int) -> list[tuple]:
    """Windows that begin the ranges, from a sample: (lang, words as bytes). They decide who counts what, not the counts.

    The sample has about `SAMPLED` windows for each range, so that the driver's share grows with the
    number of ranges only, as it does for any range partitioning.
    """
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    wanted = SAMPLED * ranges
    text_bytes = 512 * wanted
    share = min(1.0, text_bytes / max(total, 1))
    some = rows if share == 1 else rows.sample(share, seed=12)
    chance = min(1.0, 8 * wanted / max(1.0, total * share))

    def run(batches):
        for number, batch in enumerate(chunks(batches, limit=CHUNK)):
            luck = np.random.default_rng([TaskContext.get().partitionId(), number])
            for lang, texts in _by_language(batch):
                vocabulary, stream = word_stream(texts)
                found = windows(stream, longest)[0]
                found = found[luck.random(len(found)) < chance]
                columns = [vocabulary.take(pa.array(c - 1, mask=c == 0)) for c in found.T]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(found)), *columns], ["lang", *_names(longest)])

    kinds = ", ".join(f"{n} string" for n in ["lang", *_names(longest)])
    taken = some.mapInArrow(run, kinds).distinct().collect()
    points = sorted({(row[0].encode(), *((w or "").encode() for w in row[1:])) for row in taken})
    return [points[len(points) * k // ranges] for k in range(1, ranges)] if len(points) > ranges else points


def _edges(points: list[tuple], vocabulary: list[bytes], found: np.ndarray) -> list[int]:
    """For each split point the first window that is not before it."""
    doubled = [2 * column for column in found.T]  # words that are missing lie between two others
    edges = []
    for _, *words in points:
        low, high = 0, len(found)
        for word, column in zip(words, doubled, strict=True):
            place = bisect_left(vocabulary, word)
            known = place < len(vocabulary) and vocabulary[place] == word
            code = 0 if not word else 2 * place + (2 if known else 1)
            part = column[low:high]
            low, high = low + np.searchsorted(part, code), low + np.searchsorted(part, code, "right")
        edges.append(int(low))
    return edges


_STREAMS = "range int, lang string, words binary, word_bytes int, codes binary, rows int"


def count_windows(rows: DataFrame, longest: int, points: list[tuple]) -> DataFrame:
    """The windows of each chunk of texts, sorted and counted, as one packed stream for each range.

    A stream has its words in order, and for each column of windows, and for the counts, one number a window.
    """
    langs = [point[0] for point in points]

    def run(batches):
        codec = pa.Codec("zstd")
        for batch in chunks(batches, limit=CHUNK):
            for lang, texts in _by_language(batch):
                vocabulary, stream = word_stream(texts)
                found, counts = windows(stream, longest)
                if not len(found):
                    continue
                words = vocabulary.cast(pa.binary()).to_pylist()
                first, last = bisect_left(langs, lang.encode()), bisect_right(langs, lang.encode())
                edges = [0, *_edges(points[first:last], words, found), len(found)]
                out: dict[str, list] = {name.split()[0]: [] for name in _STREAMS.split(", ")}
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    if a == b:
                        continue
                    used, codes = np.unique(found[a:b], return_inverse=True)
                    if used[0]:  # 0, the end of a piece, is always known
                        used, codes = np.r_[0, used], codes + 1
                    listed = b" ".join([words[i - 1] for i in used[1:].tolist()])
                    packed = np.concatenate([codes.reshape(b - a, longest).T.ravel().astype(np.int64), counts[a:b]])
                    out["range"].append(first + k)
                    out["lang"].append(lang)
                    out["words"].append(codec.compress(listed, asbytes=True))
                    out["word_bytes"].append(len(listed))
                    out["codes"].append(codec.compress(_by_bytes(packed), asbytes=True))
                    out["rows"].append(b - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["range"], pa.int32()), pa.array(out["lang"], pa.string()),
                     pa.array(out["words"], pa.binary()), pa.array(out["word_bytes"], pa.int32()),
                     pa.array(out["codes"], pa.binary()), pa.array(out["rows"], pa.int32())], list(out))

    return rows.mapInArrow(run, _STREAMS)


def _by_bytes(values: np.ndarray) -> bytes:
    """Lowest bytes first, then the next ones: small numbers become long rows of zeros."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_bytes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _merge(streams: list[tuple], longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Streams of one range as one: words in order, windows in order, counts."""
    codec = pa.Codec("zstd")
    words, sizes, columns, counts = [], [], [], []
    for packed, size, codes, rows in streams:
        own = codec.decompress(packed, size, asbytes=True).split(b" ") if size else []
        words += own
        sizes.append(len(own))
        values = _from_bytes(codec.decompress(codes, (longest + 1) * rows * 8, asbytes=True))
        columns.append(values[:-rows].reshape(longest, rows))
        counts.append(values[-rows:])
    found = pa.array(words, pa.binary()).dictionary_encode()
    distinct = found.dictionary.to_pylist()
    order = sorted(range(len(distinct)), key=distinct.__getitem__)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(1, len(order) + 1)
    numbers = number[found.indices.to_numpy(zero_copy_only=False)]
    ends = np.cumsum(sizes)
    for k, end in enumerate(ends.tolist()):
        columns[k] = np.r_[0, numbers[end - sizes[k]:end]][columns[k]]
    merged, totals = distinct_rows(list(np.concatenate(columns, axis=1)), np.concatenate(counts))
    return pa.array([distinct[i] for i in order], pa.binary()).cast(pa.string()), merged, totals


_PHRASES = "n int, count long, cut boolean"


def _count_prefixes(least: int, longest: int):
    """Sums of the phrases that begin the windows of a range. Rows come by range and language.

    The first and the last phrase of each length may go on in other ranges; they are marked as cut.
    """
    names = _names(longest)

    def count(lang: str, streams: list[tuple]) -> Iterator[pa.RecordBatch]:
        words, found, counts = _merge(streams, longest)
        new = np.zeros(len(found), bool)
        new[0] = True
        for depth in range(longest + 1):
            if depth:
                new[1:] |= found[1:, depth - 1] != found[:-1, depth - 1]
            starts = np.flatnonzero(new)
            sums = np.add.reduceat(counts, starts)
            cut = np.zeros(len(starts), bool)
            cut[[0, -1]] = True
            keep = ((sums >= least) | cut) if depth else cut
            if depth:
                keep &= found[starts, depth - 1] > 0
            at = starts[keep]
            columns = [
                words.take(pa.array(found[at, k] - 1)) if k < depth else pa.nulls(len(at), pa.string())
                for k in range(longest)]
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), len(at)), *columns,
                 pa.array(np.full(len(at), depth), pa.int32()), pa.array(sums[keep]), pa.array(cut[keep])],
                ["lang", *names, "n", "count", "cut"])

    def run(batches):
        own, waiting = None, []
        for batch in batches:
            for row in zip(*(batch.column(name.split()[0]).to_pylist() for name in _STREAMS.split(", ")), strict=True):
                if row[:2] != own and waiting:
                    yield from count(own[1], waiting)
                    waiting = []
                own = row[:2]
                waiting.append(row[2:])
        if waiting:
            yield from count(own[1], waiting)

    return run


def frequent_phrases(rows: DataFrame, least: int = 30, longest: int = LONGEST) -> DataFrame:
    """lang, phrase (array of words), n, count of all phrases with so many occurrences; n = 0 has all words of a lang."""
    names = _names(longest)
    keys = ["lang", *names]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streams = count_windows(rows, longest, split_points(rows, longest, RANGES * parts))
    dealt = streams.repartition(parts, "range").sortWithinPartitions("range", "lang")
    kinds = ", ".join(f"{n} string" for n in keys)
    found = dealt.mapInArrow(_count_prefixes(least, longest), f"{kinds}, {_PHRASES}").checkpoint()
    whole = found.where(~F.col("cut")).drop("cut")
    summed = found.where("cut").groupBy(*keys, "n").agg(F.sum("count").alias("count"))
    return whole.union(summed.select(whole.columns)).where((F.col("count") >= least) | (F.col("n") == 0)).select(
        "lang", F.array_compact(F.array(*names)).alias("phrase"), "n", "count")


def _last(n: np.ndarray, depth: int) -> np.ndarray:
    """For every row the place of the last phrase of `depth` words at or before it, or -1."""
    return np.maximum.accumulate(np.where(n == depth, np.arange(len(n)), -1))


def _open_rows(n: np.ndarray, longest: int) -> list[int]:
    """By depth, the place of the phrase that rows behind the last one may begin with, or -1."""
    found = []
    for depth in range(1, longest + 1):
        own, ended = np.flatnonzero(n == depth), np.flatnonzero(n < depth)
        still = len(own) and (not len(ended) or ended[-1] < own[-1])
        found.append(int(own[-1]) if still else -1)
    return found


def _summary(longest: int):
    """One row for a range: what other ranges need to know of it, by depth."""

    def run(batches):
        n, f = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            n.append(batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64))
            f.append(batch.column("count").to_numpy(zero_copy_only=False))
        n, f = np.concatenate(n), np.concatenate(f)
        heads, closed = [], []
        for depth in range(1, longest + 1):
            ends = np.flatnonzero(n <= depth)
            before = int(ends[0]) if len(ends) else len(n)
            heads.append(int(f[:before][n[:before] == depth + 1].max(initial=0)))
            closed.append(bool(len(ends)))
        opened = [int(f[at]) if at >= 0 else 0 for at in _open_rows(n, longest)]
        row = [[TaskContext.get().partitionId()], [heads], [closed], [opened]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[0], pa.int32()), pa.array(row[1], pa.list_(pa.int64())),
             pa.array(row[2], pa.list_(pa.bool_())), pa.array(row[3], pa.list_(pa.int64()))],
            ["range", "heads", "closed", "opened"])

    return run


def _across(ranges: list, longest: int) -> tuple[dict, dict]:
    """Counts of the phrases open where a range begins, and the largest longer counts behind its end, by depth."""
    before, behind = {}, {}
    counts = [0] * longest
    for row in ranges:
        before[row["range"]] = counts
        counts = [o if closed else c for o, closed, c in zip(row["opened"], row["closed"], counts, strict=True)]
    largest = [0] * longest
    for row in reversed(ranges):
        behind[row["range"]] = largest
        largest = [h if closed else max(h, c) for h, closed, c in zip(
            row["heads"], row["closed"], largest, strict=True)]
    return before, behind


def _read(before: dict, behind: dict, longest: int, parts: str, longer: str):
    """Rows in order with the counts of the phrases they begin with and the largest count one word longer."""

    def run(batches):
        me = TaskContext.get().partitionId()
        outer = before.get(me, [0] * longest)
        held = None  # the open rows, whose longer phrases may still come

        def out(rows: pa.Table, counts: np.ndarray, largest: np.ndarray) -> Iterator[pa.RecordBatch]:
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(counts) + 1) * longest, pa.int32()), pa.array(counts.ravel()))
            yield from rows.append_column(parts, lists).append_column(
                longer, pa.array(largest)).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            counts, largest = np.zeros((len(rows), longest), np.int64), np.zeros(len(rows), np.int64)
            old = 0
            if held is not None:
                old = len(held[0])
                rows = pa.concat_tables([held[0], rows])
                counts, largest = np.concatenate([held[1], counts]), np.concatenate([held[2], largest])
            n = rows.column("n").to_numpy().astype(np.int64)
            f = rows.column("count").to_numpy()
            for depth in range(1, longest):
                place = _last(n, depth)
                known = np.where(place >= 0, f[place], outer[depth - 1])
                counts[old:, depth - 1] = np.where(n > depth, known, 0)[old:]
                child = (n == depth + 1) & (place >= 0)
                np.maximum.at(largest, place[child], f[child])
            stay = [at for at in _open_rows(n, longest) if at >= 0]
            gone = np.ones(len(n), bool)
            gone[stay] = False
            stay = np.flatnonzero(~gone)
            held = rows.take(stay), counts[stay], largest[stay]
            yield from out(rows.filter(pa.array(gone)), counts[gone], largest[gone])
        if held is not None:
            depths = held[0].column("n").to_numpy().astype(np.int64)
            later = np.array(behind[me], np.int64)[depths - 1]
            yield from out(held[0], held[1], np.maximum(held[2], later))

    return run


def _in_order(phrases: DataFrame, order: Column, longest: int, parts: str, longer: str) -> DataFrame:
    """The phrases with `parts` and `longer`, read as a stream ordered by lang and `order`."""
    count = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = phrases.repartitionByRange(count, F.col("lang"), order).sortWithinPartitions(
        F.col("lang"), order).checkpoint()
    ranges = stream.select("n", "count").mapInArrow(
        _summary(longest), "range int, heads array<long>, closed array<boolean>, opened array<long>")
    # One row for each partition of the stream, however many phrases there are.
    before, behind = _across(sorted(ranges.collect(), key=lambda r: r["range"]), longest)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    return stream.mapInArrow(
        _read(before, behind, longest, parts, longer), f"{kinds}, {parts} array<long>, {longer} long")


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = 30, longest: int = LONGEST, share: int = 80,
                 top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases whose words belong together most, by language.

    Texts are lower-cased (A to Z), cut into pieces at `BREAKS` and into words at `BLANKS`. A phrase
    of 2 to `longest` words inside a piece with a >= `least` occurrences is a candidate. Cut in two it
    has floor(2,000,000 * a / (l + r)), l and r being the occurrences of the parts; its score is that of
    the lowest cut, the shortest first part among equals. A candidate inside a longer one with at least
    `share` hundredths of its occurrences is dropped; as no phrase is more frequent than one inside it, one
    word longer is all that must be looked at. n counts all words of the language.

    A NULL lang counts as `und`, a NULL or empty text has no words, repeated rows count each, doc_id and
    other columns are not read, and no documents give no rows. Very long texts are counted as a whole.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    shared_folder(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    found = frequent_phrases(rows, least, longest)
    totals = found.where("n = 0").select("lang", F.col("count").alias("total"))
    phrases = found.where("n > 0")
    left = _in_order(phrases, F.col("phrase"), longest, "lefts", "longer_right")
    both = _in_order(left, F.reverse("phrase"), longest, "rights", "longer_left")
    cuts = F.array_compact(F.array(*[
        F.when(F.col("n") > k, F.struct(
            F.call_function("div", _exact(F.col("count")) * SCALE, _exact(F.col("lefts")[k - 1]) + _exact(F.element_at(
                "rights", F.greatest(F.col("n") - k, F.lit(1))))).alias("score"),
            F.lit(k).alias("cut"), F.col("lefts")[k - 1].alias("l"),
            F.element_at("rights", F.greatest(F.col("n") - k, F.lit(1))).alias("r")))
        for k in range(1, longest)]))
    longer = _exact(F.greatest("longer_right", "longer_left"))
    scored = both.where((F.col("n") > 1) & (longer * 100 < _exact(F.col("count")) * share)).select(
        "lang", F.array_join("phrase", " ").alias("phrase"), F.col("count").alias("a"), F.array_min(cuts).alias("best"))
    scored = scored.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    ranked = scored.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
