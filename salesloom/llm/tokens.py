"""Token counts of sentencepiece BPE models by rank-synchronous array merging.

A piece of the vocabulary holds the space mark only in front. Text therefore falls into units, a run
of spaces with the word behind it, that no merge crosses. Distinct units of a batch become ragged
arrays of symbols; in each round every unit merges its pair of lowest rank, all units at once. What
survives is counted: one token per symbol, and one per UTF-8 byte of a character without a piece.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.texts import chunks

SPACE = "▁"
# Longer units are merged one by one with a heap: the same order, without a round per merge.
LONG_UNIT = 256
CACHED_UNITS = 400_000
_UNIT = re.compile(SPACE + "*[^" + SPACE + "]+|" + SPACE + "+")
_NONE = np.iinfo(np.int64).max


class Merges:
    """Symbols, their token counts, and the ranked pairs of a model."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != 2 or model.normalizer_spec.precompiled_charsmap:
            raise ValueError("only BPE models without text normalisation are supported")
        if model.normalizer_spec.remove_extra_whitespaces or not model.trainer_spec.byte_fallback:
            raise ValueError("only models that keep spaces and fall back to bytes are supported")
        self.prefix = SPACE if model.normalizer_spec.add_dummy_prefix else ""
        pieces = {p.piece: p.score for p in model.pieces if p.type == p.NORMAL}
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("a piece crosses a word")
        self.symbols: dict[str, int] = {}
        self.tokens: list[int] = []
        for text in chain(pieces, sorted(set("".join(pieces)))):
            self._symbol(text, 1 if text in pieces else len(text.encode()))
        ranks = {s: i for i, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        merges = {}
        for text, score in pieces.items():
            for cut in range(1, len(text)):
                left, right = self.symbols.get(text[:cut]), self.symbols.get(text[cut:])
                if left is not None and right is not None:
                    merges[left << 32 | right] = (ranks[score], self.symbols[text])
        self.merges = merges
        self.keys = np.array(sorted(merges), np.int64)
        self.ranks, self.merged = np.array([merges[k] for k in self.keys.tolist()], np.int64).T

    def _symbol(self, text: str, tokens: int) -> int:
        if text not in self.symbols:
            self.symbols[text] = len(self.tokens)
            self.tokens.append(tokens)
        return self.symbols[text]

    def characters(self, unit: str) -> list[int]:
        known = self.symbols
        return [known[c] if c in known else self._symbol(c, len(c.encode())) for c in unit]

    def count(self, units: list[str]) -> np.ndarray:
        """Tokens of each unit."""
        result = np.zeros(len(units), np.int64)
        short = [i for i, unit in enumerate(units) if len(unit) <= LONG_UNIT]
        if short:
            result[short] = self._count_together([units[i] for i in short])
        for i, unit in enumerate(units):
            if len(unit) > LONG_UNIT:
                result[i] = self._count_alone(unit)
        return result

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def _count_together(self, units: list[str]) -> np.ndarray:
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        symbols = np.array(self.characters("".join(units)), np.int64)
        owners = np.repeat(np.arange(len(units)), sizes)
        result = np.zeros(len(units), np.int64)
        weights = np.array(self.tokens, np.int64)
        while len(symbols):
            ranks = np.full(len(symbols), _NONE)
            merged = np.zeros(len(symbols), np.int64)
            inner = np.flatnonzero(owners[1:] == owners[:-1])
            ranks[inner], merged[inner] = self._lookup(symbols[inner], symbols[inner + 1])
            starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            lowest = np.minimum.reduceat(ranks, starts)
            finished = np.repeat(lowest == _NONE, sizes)
            if finished.any():
                result += np.bincount(
                    owners[finished], weights[symbols[finished]], len(units)).astype(np.int64)
                keep = ~finished
                symbols, owners, ranks, merged = (
                    a[keep] for a in (symbols, owners, ranks, merged))
                sizes, lowest = sizes[lowest != _NONE], lowest[lowest != _NONE]
                if not len(symbols):
                    break
            # the leftmost pair of the lowest rank, one for each unit
            sites = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            sites = sites[np.r_[True, owners[sites[1:]] != owners[sites[:-1]]]]
            symbols[sites] = merged[sites]
            keep = np.ones(len(symbols), bool)
            keep[sites + 1] = False
            symbols, owners = symbols[keep], owners[keep]
        return result

    def _count_alone(self, unit: str) -> int:
        symbols = self.characters(unit)
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        heap = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                found = self.merges.get(symbols[left] << 32 | symbols[right])
                if found:
                    heapq.heappush(heap, (found[0], left, right, symbols[left], symbols[right]))

        for left in range(len(symbols) - 1):
            offer(left, left + 1)
        while heap:
            _, left, right, was_left, was_right = heapq.heappop(heap)
            if symbols[left] != was_left or symbols[right] != was_right or after[left] != right:
                continue
            symbols[left] = self.merges[was_left << 32 | was_right][1]
            symbols[right] = -1
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return sum(self.tokens[s] for s in symbols if s >= 0)


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    return Merges(path)


class Counter:
    """Counts tokens of texts; remembers a bounded number of units."""

    def __init__(self, path: str):
        self.merges, self.known = merges_of(path), {}

    def counts(self, texts: list[str | None]) -> np.ndarray:
        marked = [self.merges.prefix + t.replace(" ", SPACE) if t else "" for t in texts]
        units = [_UNIT.findall(text) for text in marked]
        if len(self.known) > CACHED_UNITS:
            self.known = {}
        new = list(set(chain.from_iterable(units)).difference(self.known))
        self.known.update(zip(new, self.merges.count(new).tolist(), strict=True))
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        values = np.fromiter(
            map(self.known.__getitem__, chain.from_iterable(units)), np.int64, int(sizes.sum()))
        sums = np.r_[0, np.cumsum(values)]
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; a NULL text counts as empty, with 0 of both.

    No begin, end or special tokens; their strings inside a text are ordinary text. One narrow pass:
    repeated rows stay repeated, a NULL doc_id stays NULL, other columns are not read.
    `model_path` must exist on every executor.
    """

    def run(batches):
        counter = Counter(model_path)
        for batch in chunks(batches):
            counts = counter.counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
