"""Lexical retrieval packing: documents into full windows, with BM25 neighbours side by side.

Every document is cut into full windows from its start; what is left, its tail, is packed. Tails are
put in order by their content and dealt to shards of SHARD consecutive ones; each shard has an
inverted index of its tails with BM25 weights whose document frequencies and mean length are those of
all tails. A seed tail asks the index with all its terms for its best unused neighbours, which fill
its window, each followed by the unused ones that are close to it; the one that does not fit is cut,
and its rest stays as a tail.

The order by content is made of weighted minwise hashes: of two tails, the first hash agrees with a
chance equal to the share of their terms, weighted by rarity, that both have, and ties of it are
ordered by the next hash. So near copies meet in a shard however many tails there are, and copies of
any number are dealt to as many shards as they fill. A seed that finds no close neighbour (CLOSE of
its own score at least) in its shard waits for the next search, which orders the tails that are left
by other hashes. The last search fills windows with the best that its shard has; what is over there is
chained and cut into windows whose lengths are powers of two, so that no window is padded at all.

Each search shuffles the tails that are left once, and a tail meets the tails of one shard: the cost
grows in proportion to the tails.

Terms are the token ids themselves: a fixed vocabulary, so that the table of document frequencies has
a bound that does not depend on the corpus.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.texts import chunks, mix, ragged
from salesloom.session import scratch_path

WINDOW = 1024
SHARD = 1_024  # tails of a shard
SEARCHES = 2  # orders by content
COMMON = 16  # a term in more than this part of a shard is common
CLOSE = 0.5  # share of a seed's own score that a neighbour needs before the last search
HASHES = 4  # of 16 bits, in a key
RANGE_TOKENS, MOST_TOKENS = 1 << 21, 1 << 26  # ids of a range: of small inputs, and at most
K1, B = 1.2, 0.75
END = 0  # id behind every document
#: The split pattern and the special token of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}
_SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_SPACE = re.compile(_SPACE + "{1000,}")
_TWO_SPACES = re.compile(_SPACE + "{2}")  # in every 500th character, wherever there is a long run


@lru_cache(maxsize=2)
def encoding(path: str):
    """The byte-level BPE whose ranks a file lists, and the number of its ids."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    coder = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return coder, max(*ranks.values(), *SPECIAL.values()) + 1


def encode(texts: list[str | None], path: str) -> list[np.ndarray]:
    """The ids of each whole text, END behind them; NULL is empty.

    A long run of white space is one match of the pattern, but for its last character if something
    other than a special token follows; such runs are merged without the pattern, which would
    search them recursively.
    """
    coder, end = encoding(path)[0], np.array([END], np.uint32)
    found = []
    for text in texts:
        text, start, parts = text or "", 0, []
        if not _TWO_SPACES.search(text[::500]):
            found.append(np.concatenate([coder.encode_to_numpy(text, allowed_special="all"), end]))
            continue
        for run in _LONG_SPACE.finditer(text):
            parts.append(coder.encode_to_numpy(text[start:run.start()], allowed_special="all"))
            start = run.end()
            if start < len(text) and not text.startswith(tuple(SPECIAL), start):
                start -= 1
            parts.append(np.array(coder._encode_single_piece(text[run.start():start]), np.uint32))
        parts.append(coder.encode_to_numpy(text[start:], allowed_special="all"))
        found.append(np.concatenate([*parts, end]))
    return found


def crc(ids: np.ndarray) -> int:
    """CRC-32 of the ids as unsigned little-endian 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ROW = f"{_PIECE}, unit long, ids binary"
_NAMES = [column.split()[0] for column in _ROW.split(", ")]


def _cut(path: str, window: int):
    """Full windows as finished pieces, tails with their ids and without a sequence."""

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in chunks(batches):
            rows: list[list] = [[] for _ in range(8)]
            owners = []
            for row, ids in enumerate(encode(batch.column("text").to_pylist(), path)):
                for start in range(0, len(ids), window):
                    part = ids[start:start + window]
                    full = len(part) == window
                    number += 2
                    owners.append(row)
                    for column, value in zip(rows, (
                            start, len(part), crc(part), len(ids), number if full else None,
                            0 if full else None, number, None if full else part.astype("<u2").tobytes()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owners, pa.int64())),
                 *(pa.array(c, pa.int64()) for c in rows[:7]), pa.array(rows[7], pa.binary())],
                _NAMES)

    return run


def _frequencies(terms: int):
    def run(batches):
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for ids in batch.column("ids").to_pylist():
                total[np.unique(np.frombuffer(ids, "<u2"))] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["term", "n"])

    return run


def content_hashes(idf: np.ndarray, search: int) -> np.ndarray:
    """Ranks of all terms for each hash of a search; the smallest rank of a tail is its hash.

    The rank orders exponential draws whose rate is the rarity of the term, the same in every task.
    """
    terms = np.arange(len(idf), dtype=np.uint64)
    ranks = np.empty((HASHES, len(idf)), np.int64)
    for own in range(HASHES):
        dice = mix(mix(terms + np.uint64(1)) + np.uint64(1 + own + HASHES * search)) >> np.uint64(11)
        draws = -np.log((dice.astype(float) + 0.5) / 2.0**53) / np.maximum(idf, 1e-9)
        ranks[own, np.argsort(draws, kind="stable")] = np.arange(len(idf))
    return ranks


def content_keys(tails: list[np.ndarray], ranks: np.ndarray) -> np.ndarray:
    """One 64-bit number for each tail, the first hash in front."""
    if not tails:
        return np.zeros(0, np.int64)
    ids = np.concatenate(tails)
    starts = np.cumsum([0, *map(len, tails[:-1])])
    keys = np.zeros(len(tails), np.uint64)
    for own in ranks:
        keys = keys << np.uint64(16) | np.minimum.reduceat(own[ids], starts).astype(np.uint64)
    return keys.view(np.int64)


class ShardIndex:
    """Inverted index of the tails of a shard, with BM25 weights.

    What the terms in more than one of COMMON tails add to all scores is summed at once, when the index
    is made; the lists are those of the other terms. Weights have 32 bits and sums 64, so that the order
    of adding does not matter.
    """

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float):
        self.size = len(tails)
        lengths = np.array([len(t) for t in tails], np.int64)
        owners = np.repeat(np.arange(len(tails)), lengths)
        keys, counts = np.unique(owners << 32 | np.concatenate(tails).astype(np.int64), return_counts=True)
        terms, owners = keys & 0xFFFFFFFF, keys >> 32
        shrink = K1 * (1 - B + B * lengths[owners] / mean)
        weights = (idf[terms] * counts * (K1 + 1) / (counts + shrink)).astype(np.float32)  # lists stay in the cache
        starts = np.searchsorted(owners, np.arange(len(tails)))
        self.own = np.add.reduceat(weights, starts, dtype=float)
        _, held, sizes = np.unique(terms, return_inverse=True, return_counts=True)
        common = sizes > max(1, len(tails) // COMMON)
        dense = np.zeros((int(common.sum()), self.size))
        many = common[held]
        dense[(np.cumsum(common) - 1)[held[many]], owners[many]] = weights[many]
        self.common = (dense > 0).T.astype(float) @ dense
        owners, weights, held = owners[~many], weights[~many], held[~many]
        self.held = held
        self.first = np.searchsorted(owners, np.arange(len(tails) + 1))
        by_term = np.argsort(held.astype(np.uint16), kind="stable")  # ids have 16 bits, which are sorted by digits
        self.postings, self.weights = owners[by_term].astype(np.int32), weights[by_term]
        self.sizes = np.where(common, 0, sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.most = np.zeros(len(sizes))
        if len(self.weights):
            self.most[~common] = np.maximum.reduceat(self.weights, self.starts[~common])

    def keep(self, open_tails: np.ndarray) -> None:
        """Take all other tails out of the lists."""
        kept = open_tails[self.postings]
        terms = np.repeat(np.arange(len(self.sizes)), self.sizes)[kept]
        self.postings, self.weights = self.postings[kept], self.weights[kept]
        self.sizes = np.bincount(terms, minlength=len(self.sizes))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def terms_of(self, seed: int) -> np.ndarray:
        return self.held[self.first[seed]:self.first[seed + 1]]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of all tails in the lists for the terms of one."""
        terms = self.terms_of(seed)
        own = ragged(self.starts[terms], self.sizes[terms])
        return self.common[seed] + np.bincount(self.postings[own], self.weights[own], self.size)

    def reached(self, seed: int, need: float, open_tails: np.ndarray) -> np.ndarray | None:
        """BM25 of all tails for the terms of one; None only if no open tail but the seed scores `need`.

        The lists are read only if what they can add at most is enough for one of the tails.
        """
        unread = self.most[self.terms_of(seed)].sum()
        hopeful = open_tails & (self.common[seed] >= need * (1 - 1e-9) - unread)
        hopeful[seed] = False
        return self.scores(seed) if hopeful.any() else None


def fill_windows(tails: list[np.ndarray], idf: np.ndarray, mean: float, window: int, last: bool):
    """Pieces (tail, from, to, sequence, offset), and how many ids of each tail are placed.

    Seeds come in the order of the tails and take their best unused neighbours. A neighbour brings
    its own close ones along, so that it is not parted from its copies. Unless this is the `last`
    search, a seed without a close neighbour, or without enough of any, is left; in the last one,
    seeds that cannot fill a window are chained at the end.
    """
    index = ShardIndex(tails, idf, mean)
    sizes = np.array([len(t) for t in tails], np.int64)
    placed = np.zeros(len(tails), np.int64)
    is_open = sizes > 0
    pieces, sequence = [], 0

    def neighbours(tail: int, close: bool) -> list[int]:
        """Open tails, the best first, ties in their order; only close ones, or all if one is close or need not be."""
        need = CLOSE * index.own[tail]
        scores = index.reached(tail, need, is_open) if close or not last else index.scores(tail)
        if scores is None:
            return []
        at = np.flatnonzero(is_open & (scores >= need if close else scores > 0))
        at = at[np.argsort(-scores[at], kind="stable")]
        return at.tolist() if last or len(at) and scores[at[0]] >= need else []

    indexed = len(tails)
    for seed in range(len(tails)):
        if not is_open[seed]:
            continue
        is_open[seed] = False
        members, room = [seed], window - int(sizes[seed] - placed[seed])
        for own in neighbours(seed, False):
            following = [own] if is_open[own] else []
            while following and room > 0:
                tail = following.pop(0)
                is_open[tail] = False
                members.append(tail)
                room -= int(sizes[tail] - placed[tail])
                if tail == own and room > 0:
                    following = neighbours(tail, True)
            if room <= 0:
                break
        if room > 0:
            is_open[members] = True
            continue
        offset = 0
        for tail in members:
            start = int(placed[tail])
            take = min(int(sizes[tail]) - start, window - offset)
            pieces.append((tail, start, start + take, sequence, offset))
            placed[tail], offset = start + take, offset + take
        is_open[members[-1]] = placed[members[-1]] < sizes[members[-1]]
        sequence += 1
        if 4 * (now := int(is_open.sum())) < 3 * indexed:
            index.keep(is_open)
            indexed = now
    if last:
        _chain(pieces, sequence, sizes, placed, window)
    return pieces, placed


def _chain(pieces: list, sequence: int, sizes: np.ndarray, placed: np.ndarray, window: int) -> None:
    """Place all that is left, one tail after the other, in windows and then in falling powers of two."""
    def next_size() -> int:
        return window if left >= window else 1 << left.bit_length() - 1

    left, offset = int((sizes - placed).sum()), 0
    size = next_size() if left else 0
    for tail in np.flatnonzero(placed < sizes).tolist():
        while placed[tail] < sizes[tail]:
            start = int(placed[tail])
            take = min(int(sizes[tail]) - start, size - offset)
            pieces.append((tail, start, start + take, sequence, offset))
            placed[tail], offset, left = start + take, offset + take, left - take
            if offset == size and left:
                sequence, offset = sequence + 1, 0
                size = next_size()


def _search(idf: np.ndarray, mean: float, window: int, shard: int, number: int, last: bool):
    """Rows come in order of content; every `shard` of them are packed. Tails that are left have ids."""

    def finish(rows: pa.Table, sequence: int):
        tails = [np.frombuffer(ids, "<u2").astype(np.int64) for ids in rows["ids"].to_pylist()]
        pieces, placed = fill_windows(tails, idf, mean, window, last)
        tail, a, b, own, offset = np.array(pieces, np.int64).reshape(-1, 5).T
        checks = [crc(tails[t][x:y]) for t, x, y in zip(tail.tolist(), a.tolist(), b.tolist(), strict=True)]
        rest = np.flatnonzero(placed < [len(t) for t in tails])
        start = rows["start"].to_numpy()
        at, none = np.r_[tail, rest], [None] * len(rest)
        kept = [tails[t][placed[t]:].astype("<u2").tobytes() for t in rest.tolist()]
        yield pa.RecordBatch.from_arrays([
            rows["doc_id"].take(pa.array(at)).combine_chunks(),
            pa.array(start[at] + np.r_[a, placed[rest]]),
            pa.array(np.r_[b - a, [len(tails[t]) - placed[t] for t in rest.tolist()]].astype(np.int64)),
            pa.array([*checks, *none], pa.int64()),
            rows["doc_tokens"].take(pa.array(at)).combine_chunks(),
            pa.array([*(sequence + 2 * own).tolist(), *none], pa.int64()),
            pa.array([*offset.tolist(), *none], pa.int64()),
            rows["unit"].take(pa.array(at)).combine_chunks(),
            pa.array([*[None] * len(tail), *kept], pa.binary()),
        ], _NAMES)

    def run(batches):
        sequence = (number + 1 << 58) + (TaskContext.get().partitionId() << 33) + 1
        waiting = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            waiting = rows if waiting is None else pa.concat_tables([waiting, rows])
            while waiting.num_rows >= shard:
                yield from finish(waiting.slice(0, shard), sequence)
                # a tail is shorter than a window, so a shard has fewer windows than tails and powers of two
                waiting, sequence = waiting.slice(shard), sequence + 2 * (shard + 64)
        if waiting is not None and waiting.num_rows:
            yield from finish(waiting, sequence)

    return run


def _ordered(tails: DataFrame, tokens: int, idf: np.ndarray, search: int) -> DataFrame:
    """Tails in ranges of their content; equal content is split by unit, so no range is hot."""
    ranks = content_hashes(idf, search)

    @F.arrow_udf(T.LongType())
    def key(ids: pa.Array) -> pa.Array:
        return pa.array(content_keys([np.frombuffer(i, "<u2") for i in ids.to_pylist()], ranks))

    session = int(tails.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(math.ceil(tokens / RANGE_TOKENS), max(session, math.ceil(tokens / MOST_TOKENS)))
    keyed = tails.select("doc_id", "start", "doc_tokens", "unit", "ids", key("ids").alias("key"))
    return keyed.repartitionByRange(max(1, ranges), "key", "unit").sortWithinPartitions("key", "unit")


def pack(docs: DataFrame, ranks_path: str, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    A document is its ids with END behind; a NULL or empty text is END alone. Every id lies in exactly
    one piece, and the pieces of a sequence follow one another from offset 0 without a gap. All
    sequences have `window` tokens, but for the last ones, whose lengths are powers of two.
    Repeated rows and rows without a doc_id are packed like any others; other columns are not read.
    `ranks_path` must exist on every executor.
    """
    spark = docs.sparkSession
    _, terms = encoding(ranks_path)
    if terms > 1 << 16:
        raise ValueError("tails are stored in 16 bits an id")
    path = scratch_path(spark, "packing")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.mapInArrow(_cut(ranks_path, window), _ROW).write.parquet(path)
    cut = spark.read.parquet(path)
    columns = _NAMES[:7]
    full = cut.where(F.col("sequence_id").isNotNull()).select(*columns)
    tails = cut.where(F.col("sequence_id").isNull())
    total, tokens = tails.agg(F.count("*"), F.sum("length")).first()
    if not total:
        return full
    counted = tails.select("ids").mapInArrow(_frequencies(terms), "term int, n long")
    frequencies = np.zeros(terms, np.int64)
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        frequencies[row["term"]] = row["n"]
    idf, mean = np.log1p((total - frequencies + 0.5) / (frequencies + 0.5)), tokens / total
    for search in range(SEARCHES):
        last = search == SEARCHES - 1
        found = _ordered(tails, tokens, idf, search).mapInArrow(
            _search(idf, mean, window, shard, search, last), _ROW)
        if last:
            return full.unionByName(found.select(*columns))
        path = scratch_path(spark, "packing-search")
        found.write.parquet(path)
        found = spark.read.parquet(path)
        full = full.unionByName(found.where(F.col("sequence_id").isNotNull()).select(*columns))
        tails = found.where(F.col("sequence_id").isNull())
        tokens = tails.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
