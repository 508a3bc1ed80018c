"""Text columns as numpy arrays: bounded chunks, word tables and hashes of spans.

All functions work on whole texts. A hash only routes or pre-selects; callers that need equality
compare the bytes as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = np.random.default_rng(20).integers(1, 2**63, 256).astype(np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `limit` bytes of `column`, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; NULL becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


class Words(NamedTuple):
    """The words of several texts, joined by single spaces in `flat`."""

    flat: bytes
    starts: np.ndarray  # of a word, in bytes of `flat`
    ends: np.ndarray
    counts: np.ndarray  # words of a text
    firsts: np.ndarray  # index of a text's first word
    owners: np.ndarray  # text of a word


def word_table(texts: list[bytes]) -> Words:
    """Words are runs of bytes other than space and 0x09 to 0x0D."""
    split = [text.split() for text in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    total = int(counts.sum())
    sizes = np.fromiter(map(len, chain.from_iterable(split)), np.int64, total)
    ends = np.cumsum(sizes + 1) - 1
    return Words(
        b" ".join(chain.from_iterable(split)), ends - sizes, ends, counts,
        np.cumsum(counts) - counts, np.repeat(np.arange(len(split)), counts),
    )


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of `values`; equal spans have equal hashes wherever they stand."""
    global _powers
    size = len(values) + 1
    if len(_powers[0]) < size:
        inverse = pow(_BASE, -1, 2**64)
        _powers = tuple(
            np.multiply.accumulate(np.concatenate(
                [np.ones(1, np.uint64), np.full(size, base, np.uint64)]))
            for base in (_BASE, inverse)
        )
    sums = np.zeros(size, np.uint64)
    np.cumsum(values * _powers[0][: size - 1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers[1][starts])


def byte_values(data: bytes) -> np.ndarray:
    return _BYTE_VALUES[np.frombuffer(data, np.uint8)]


def word_hashes(words: Words, block: int = 1 << 20) -> np.ndarray:
    """Hash of every word; some bytes at a time, as the arrays take many bytes for each."""
    result = np.empty(len(words.starts), np.uint64)
    start = 0
    while start < len(result):
        base = int(words.starts[start])
        stop = max(start + 1, int(np.searchsorted(words.ends, base + block, "right")))
        own = slice(start, stop)
        data = byte_values(words.flat[base:int(words.ends[stop - 1])])
        result[own] = span_hashes(data, words.starts[own] - base, words.ends[own] - base)
        start = stop
    return result


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` consecutive words; runs may cross texts."""
    firsts = np.arange(max(0, len(hashes) - length + 1))
    return span_hashes(hashes, firsts, firsts + length)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of `width` values."""
    result, done = values, 1
    while done < width:
        step = min(done, width - done)
        result = np.minimum(result[: len(result) - step], result[step:])
        done += step
    return result


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of all spans, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class HashSet:
    """Membership of 64-bit hashes: a table of bits first, then a sorted array."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.values >> np.uint64(44)] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of hashes that are members, and their places among the members."""
        at = np.flatnonzero(self.bits[hashes >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.values, hashes[at]), max(0, len(self.values) - 1))
        hit = self.values[place] == hashes[at] if len(self.values) else np.zeros(len(at), bool)
        return at[hit], place[hit]
