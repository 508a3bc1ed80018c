"""Substring deduplication by super-k-mer partitioning.

A window is `window` consecutive words of one document. The minimiser of a window is the smallest
hash of its runs of GRAM words; consecutive windows that share it form a super-k-mer, which travels
packed with others in one string, words joined by spaces, to the minimiser's bucket. There every window of the
bucket is sorted by hash, equal hashes are compared byte by byte, and every window but the earliest
of its kind is repeated. Equal windows have equal minimisers, so that they always meet.

Repeats are taken out twice before that: equal super-k-mers of a chunk of documents travel once, and
runs of words that very many super-k-mers share are passed over as minimisers. The list of these is
bounded and only spreads the load: a window keeps its minimiser wherever it stands.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.texts import (
    chunks, mix, ragged, run_hashes, sliding_min, span_hashes, utf8, word_hashes, word_table,
)

GRAM = 3
# A minimiser of more super-k-mers than this is passed over; at most so many of them, the commonest.
COMMON = 2_000
COMMON_MOST = 10_000
# Text that the super-k-mers of one bucket hold, about: what a task has in memory at a time.
BUCKET_BYTES = 6 << 20
# Parts of a bucket, by minimiser, whose windows are sorted one after the other.
PARTS = 8
# Text whose super-k-mers are packed together.
PACKED_BYTES = 6 << 20
_NO_ID = np.iinfo(np.int64).min
_PASSED = np.uint64(2**64 - 1)
_COMPARED_BYTES = 1 << 21


class SuperKmers:
    """Super-k-mers of some documents, without those that only repeat an earlier one among them."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], window: int, common: np.ndarray):
        words = word_table(texts)
        hashes = word_hashes(words)
        count = max(0, len(hashes) - window + 1)
        keys, valid = np.zeros(count, np.uint64), np.zeros(count, bool)
        if count:
            valid = words.owners[:count] == words.owners[window - 1:]
            grams = run_hashes(hashes, GRAM)
            if len(common):
                grams = np.where(np.isin(grams, common), _PASSED, grams)
            keys = sliding_min(grams, window - GRAM + 1)
            passed = np.flatnonzero(valid & (keys == _PASSED))
            if len(passed):
                keys[passed] = span_hashes(hashes, passed, passed + window)
        before = np.r_[False, valid[:-1] & (keys[1:] == keys[:-1])] if count else valid
        after = np.r_[valid[1:] & (keys[1:] == keys[:-1]), False] if count else valid
        first, last = np.flatnonzero(valid & ~before), np.flatnonzero(valid & ~after)
        owner = words.owners[first] if count else first
        # in the order of documents and places
        order = np.lexsort((first - words.firsts[owner], ids[owner]))
        first, last, owner = first[order], last[order], owner[order]
        flat = words.flat
        packed = [flat[a:b] for a, b in zip(
            words.starts[first].tolist(), words.ends[last + window - 1].tolist(), strict=True)]
        seen: dict[bytes, int] = {}
        same = np.fromiter((seen.setdefault(p, i) for i, p in enumerate(packed)), np.int64, len(packed))
        place = first - words.firsts[owner]
        again = same != np.arange(len(packed))
        later = again & ((ids[owner] != ids[owner[same]]) | (place != place[same]))
        kept = np.flatnonzero(~again)
        self.keys, self.owners, self.places = keys[first][kept], owner[kept], place[kept]
        self.packed = [packed[i] for i in kept.tolist()]
        self.repeated = owner[later], place[later], (last - first + window)[later]


def order_ids(column: pa.Array) -> np.ndarray:
    """doc_id as numbers; NULL comes before all others."""
    return column.fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def survey(docs: DataFrame, window: int) -> tuple[np.ndarray, int]:
    """Minimisers that more than COMMON super-k-mers share, the commonest COMMON_MOST of them, and the
    bytes of all super-k-mers.

    Every task counts all its super-k-mers and sends those it has seen most often. What comes out
    decides where a window is counted, never whether.
    """

    def run(batches):
        counts: Counter = Counter()
        total = 0
        for batch in chunks(batches, limit=PACKED_BYTES):
            found = SuperKmers(order_ids(batch.column("doc_id")), utf8(batch.column("text")), window,
                               np.zeros(0, np.uint64))
            total += sum(map(len, found.packed))
            values, times = np.unique(found.keys, return_counts=True)
            often = times > 1
            counts.update(dict(zip(values[often].tolist(), times[often].tolist(), strict=True)))
            if len(counts) > 20 * COMMON_MOST:
                counts = Counter(dict(counts.most_common(COMMON_MOST)))
        top = counts.most_common(COMMON_MOST // 5)
        yield pa.RecordBatch.from_arrays([
            pa.array([None, *np.array([k for k, _ in top], np.uint64).view(np.int64).tolist()], pa.int64()),
            pa.array([total, *(n for _, n in top)], pa.int64())], ["key", "n"])

    counted = docs.select("doc_id", "text").mapInArrow(run, "key long, n long")
    rows = (counted.groupBy("key").agg(F.sum("n").alias("n")).where((F.col("n") > COMMON) | F.col("key").isNull())
            .orderBy(F.col("key").isNotNull(), F.desc("n"), "key").limit(COMMON_MOST + 1).collect())
    keys = [r["key"] for r in rows if r["key"] is not None]
    return np.sort(np.array(keys, np.int64).view(np.uint64)), sum(r["n"] for r in rows if r["key"] is None)


_PIECES = "bucket int, packed binary, bytes long, doc_id long, text_key int, place int, words int"
_REPEATS = "doc_id long, text_key int, place int, words int"
_NUMBERS = ("<i8", "<i4", "<i4", "u1")  # doc_id, text_key, place and part of a super-k-mer


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def pack(columns: list[np.ndarray], texts: list[bytes]) -> bytes:
    """Super-k-mers as one string: how many, their numbers, and their words."""
    parts = [np.array([len(texts)], "<i8"), *(c.astype(k) for c, k in zip(columns, _NUMBERS, strict=True))]
    return b"".join([*(p.tobytes() for p in parts), b"\n".join(texts)])


def unpack(packed: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    count, at, columns = int(np.frombuffer(packed, "<i8", 1)[0]), 8, []
    for kind in _NUMBERS:
        columns.append(np.frombuffer(packed, kind, count, at))
        at += count * columns[-1].itemsize
    return columns, packed[at:].split(b"\n")


def _split(window: int, common: np.ndarray, buckets: int):
    """A packed string for each chunk and bucket, and the repeats found inside the chunk."""

    def run(batches):
        codec = _codec()
        for batch in chunks(batches, limit=PACKED_BYTES):
            ids, keys = order_ids(batch.column("doc_id")), batch.column("text_key").to_numpy()
            found = SuperKmers(ids, utf8(batch.column("text")), window, common)
            dealt = mix(found.keys)
            bucket = (dealt % np.uint64(buckets)).astype(np.int64)
            part = dealt // np.uint64(buckets) % np.uint64(PARTS)
            order = np.argsort(bucket, kind="stable")
            cuts = np.r_[0, np.flatnonzero(np.diff(bucket[order])) + 1, len(order)]
            packed, sizes, where = [], [], []
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                own = order[start:stop]
                if not len(own):
                    continue
                owner = found.owners[own]
                raw = pack([ids[owner], keys[owner], found.places[own], part[own]],
                           [found.packed[i] for i in own.tolist()])
                packed.append(codec.compress(raw, asbytes=True))
                sizes.append(len(raw))
                where.append(bucket[own[0]])
            owner, place, size = found.repeated
            known, new = len(owner), len(packed)
            none, nothing = pa.nulls(new, pa.int64()), pa.nulls(new, pa.int32())
            rows = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[where, place % buckets], pa.int32()),
                pa.array([*packed, *[None] * known], pa.binary()), pa.array([*sizes, *[None] * known], pa.int64()),
                pa.concat_arrays([none, batch.column("doc_id").take(rows)]),
                pa.concat_arrays([nothing, batch.column("text_key").take(rows)]),
                pa.concat_arrays([nothing, pa.array(place, pa.int32())]),
                pa.concat_arrays([nothing, pa.array(size, pa.int32())]),
            ], ["bucket", "packed", "bytes", "doc_id", "text_key", "place", "words"])

    return run


def _equal_spans(data: np.ndarray, lefts: np.ndarray, rights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the bytes of two spans of one size are equal, for many spans, some at a time."""
    result = np.ones(len(sizes), bool)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + _COMPARED_BYTES, "right")))
        some = sizes[start:stop]
        equal = data[ragged(lefts[start:stop], some)] == data[ragged(rights[start:stop], some)]
        result[start:stop] = np.logical_and.reduceat(equal, np.cumsum(some) - some)
        start = stop
    return result


def repeated_windows(ids: np.ndarray, places: np.ndarray, texts: list[bytes], window: int):
    """Row, first word and number of words of every run of windows that start earlier elsewhere."""
    order = np.lexsort((places, ids))
    ids, places = ids[order], places[order]
    words = word_table([texts[i] for i in order.tolist()])
    hashes = word_hashes(words)
    runs = run_hashes(hashes, window)
    inside = np.flatnonzero(words.owners[: len(runs)] == words.owners[window - 1:]) if len(runs) else np.zeros(0, np.int64)
    row = words.owners[inside]
    place = places[row] + inside - words.firsts[row]
    if len(row) and ((np.diff(ids[row]) == 0) & (np.diff(place) < 0)).any():  # an id with several texts
        sort = np.lexsort((place, ids[row]))
        inside, row, place = inside[sort], row[sort], place[sort]
    runs = runs[inside]
    by_hash = np.argsort(runs, kind="stable")
    ordered = runs[by_hash]
    new = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
    first = np.empty(len(runs), np.int64)
    first[by_hash] = by_hash[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = (first != np.arange(len(runs))) & (
        (ids[row] != ids[row[first]]) | (place != place[first]))
    own = np.flatnonzero(later)
    # A window behind an equal one, at both ends, needs only its last word compared.
    follows = np.zeros(len(own), bool)
    if len(own) > 1:
        a, b = own[1:], first[own[1:]]
        follows[1:] = ((own[:-1] == a - 1) & (first[own[:-1]] == b - 1) & (inside[a - 1] == inside[a] - 1)
                       & (inside[b - 1] == inside[b] - 1))
    data = np.frombuffer(words.flat, np.uint8)
    shift = np.where(follows, window - 1, 0)
    left, right = words.starts[inside[own] + shift], words.starts[inside[first[own]] + shift]
    sizes = words.ends[inside[own] + window - 1] - left
    equal = sizes == words.ends[inside[first[own]] + window - 1] - right
    if equal.all():
        equal = _equal_spans(data, left, right, sizes)
    if not equal.all():  # different windows of one hash: tell them apart by their bytes
        seen: dict[bytes, int] = {}
        flat = words.flat
        for i, at in enumerate(inside.tolist()):
            first[i] = seen.setdefault(flat[words.starts[at]:words.ends[at + window - 1]], i)
        own = np.flatnonzero((first != np.arange(len(runs))) & (
            (ids[row] != ids[row[first]]) | (place != place[first])))
    breaks = np.r_[True, (np.diff(own) != 1) | (np.diff(inside[own]) != 1)] if len(own) else np.zeros(0, bool)
    starts = np.flatnonzero(breaks)
    sizes = np.diff(np.r_[starts, len(own)])
    return order[row[own[starts]]], place[own[starts]], sizes + window - 1


def _count(window: int):
    """Rows come sorted by bucket; a bucket is looked at part by part, as equal windows share theirs."""

    def look(strings: list[bytes]):
        some = [unpack(s) for s in strings]
        ids, keys, places, parts = (np.concatenate(c) for c in zip(*(s[0] for s in some), strict=True))
        texts = [t for s in some for t in s[1]]
        for part in np.unique(parts):
            own = np.flatnonzero(parts == part)
            row, place, size = repeated_windows(
                ids[own], places[own].astype(np.int64), [texts[i] for i in own.tolist()], window)
            row = own[row]
            docs = pa.array(ids[row], pa.int64(), mask=ids[row] == _NO_ID)
            yield pa.RecordBatch.from_arrays(
                [docs, pa.array(keys[row], pa.int32()), pa.array(place, pa.int32()), pa.array(size, pa.int32())],
                ["doc_id", "text_key", "place", "words"])

    def run(batches):
        codec, bucket, waiting = _codec(), None, []
        for batch in batches:
            yield batch.filter(batch.column("packed").is_null()).select(["doc_id", "text_key", "place", "words"])
            for own, packed, size in zip(*(batch.column(n).to_pylist() for n in ("bucket", "packed", "bytes")), strict=True):
                if packed is None:
                    continue
                if own != bucket and waiting:
                    yield from look(waiting)
                    waiting = []
                bucket = own
                waiting.append(codec.decompress(packed, size, asbytes=True))
        if waiting:
            yield from look(waiting)

    return run


def text_key():
    """With doc_id, what tells rows apart: rows equal in both are one document."""
    return F.hash("text")


def find_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, text_key and the ranges (place, words) of repeated words, of documents that have any."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    rows = rows.where(F.col("text").isNotNull())
    common, total = survey(rows, window)
    buckets = int(total // BUCKET_BYTES) + 1
    pieces = rows.mapInArrow(_split(window, common, buckets), _PIECES)
    repeats = pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_count(window), _REPEATS)
    return repeats.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("place", "words")).alias("ranges"))


_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("kept_text", T.StringType())])


@F.arrow_udf(_RESULT)
def _without(text: pa.Array, ranges: pa.Array) -> pa.Array:
    counts, removed, kept = [], [], []
    for value, spans in zip(utf8(text), ranges.to_pylist(), strict=True):
        words = value.split()
        counts.append(len(words))
        if spans:
            gone = np.zeros(len(words) + 1, np.int64)
            places = np.array([s["place"] for s in spans])
            np.add.at(gone, places, 1)
            np.add.at(gone, places + np.array([s["words"] for s in spans]), -1)
            stays = (np.cumsum(gone[:-1]) == 0).tolist()
            words = [word for word, stay in zip(words, stays, strict=True) if stay]
        removed.append(counts[-1] - len(words))
        kept.append(b" ".join(words))
    return pa.StructArray.from_arrays(
        [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
        ["n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = 20, into: str = "result") -> DataFrame:
    """All rows and columns of `docs`, and a struct `into` of n_words, n_removed and kept_text.

    Each word is removed that a window covers whose words also start earlier: in a smaller doc_id, or
    earlier in the same document. Windows are those of the input. NULL and empty texts have no words
    and keep an empty text. A NULL doc_id counts as the smallest. Rows equal in doc_id and text are
    one document, and are treated alike; so windows at one place of one doc_id are never "earlier".
    """
    if into in docs.columns:
        raise ValueError(f"the documents have a column {into} already")
    repeats = find_repeats(docs, window).toDF("__doc", "__key", "__ranges")
    joined = docs.join(repeats, F.col("doc_id").eqNullSafe(F.col("__doc")) & (text_key() == F.col("__key")), "left")
    return joined.select(*[docs[c] for c in docs.columns], _without("text", "__ranges").alias(into))
