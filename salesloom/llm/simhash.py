"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most two bits agree in at least six of their eight bytes.
A posting is a fingerprint under a set of six byte positions and their values: whoever shares six
positional bytes, the guaranteed minimum, meets under one of the 28 sets. Under a key only two bytes
are free, so that no list holds more than 65,536 distinct fingerprints however large the corpus is,
and a long list is searched by flipping bits instead of by comparing pairs. The tally of shared
bytes and the differing bits are then verified for every candidate pair.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.components import connected_components
from salesloom.llm.texts import chunks, ragged, utf8, word_table
from salesloom.session import shared_folder

SHINGLE = 3
SEED = 42
BYTES = 8
BLOCK = 1 << 15  # shingles whose bits are summed at a time
PIECE = 1 << 20  # bytes of a long text
_BLANK = re.compile(rb"[\x20\x09-\x0d]")
# Lists up to this length are compared pair by pair, longer ones by flipping bits.
SHORT_LIST = 128


def _pieces(text: bytes):
    """A text in pieces of about `PIECE` bytes, cut at white space; a word stays whole."""
    start = 0
    while len(text) - start > PIECE:
        cut = _BLANK.search(text, start + PIECE)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def _add(texts: list[bytes], rows: np.ndarray, sums: np.ndarray, totals: np.ndarray, whole: bool) -> list[bytes]:
    """Add the bits of the hashes of all shingles to the rows of the texts; the last words of the last text.

    With `whole`, a text of fewer words than a shingle has is a shingle by itself. Bits are summed for
    a block of shingles at a time.
    """
    words = word_table(texts)
    full = np.maximum(words.counts - SHINGLE + 1, 0)
    shingles = np.where(words.counts > 0, np.maximum(full, 1), 0) if whole else full
    first = ragged(words.firsts, shingles)
    owners = np.repeat(np.arange(len(texts)), shingles)
    last = first + np.minimum(words.counts, SHINGLE)[owners] - 1
    flat, digest = words.flat, xxhash.xxh64_intdigest
    for start in range(0, len(first), BLOCK):
        own = slice(start, start + BLOCK)
        hashes = np.fromiter(
            (digest(flat[a:b], SEED) for a, b in zip(
                words.starts[first[own]].tolist(), words.ends[last[own]].tolist(), strict=True)),
            np.uint64, len(first[own]))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        edges = np.flatnonzero(np.diff(owners[own], prepend=-1))
        sums[rows[owners[own][edges]]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int32)
    totals[rows] += shingles
    tail = slice(max(0, len(words.starts) - SHINGLE + 1), None)
    return [flat[a:b] for a, b in zip(words.starts[tail].tolist(), words.ends[tail].tolist(), strict=True)]


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """A bit is set if it is set in over half of the hashes of the shingles, repeats included.

    A long text is read in pieces, each behind the last words of the one before, so that memory depends
    on a piece, or on the longest word, and not on the text.
    """
    sums, totals = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    short = [i for i, text in enumerate(texts) if len(text) <= PIECE]
    _add([texts[i].lower() for i in short], np.array(short, np.int64), sums, totals, True)
    for row, text in enumerate(texts):
        if len(text) > PIECE:
            carried: list[bytes] = []
            for piece in _pieces(text):
                carried = _add([b" ".join([*carried, piece.lower()])], np.array([row]), sums, totals, False)
            if not totals[row]:
                _add([b" ".join(carried)], np.array([row]), sums, totals, True)
    return np.packbits(2 * sums > totals[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, and fingerprint (64 bits in a long) of every row; no words give zero."""

    def run(batches):
        for batch in chunks(batches):
            values = fingerprints(utf8(batch.column("text"))).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(values)],
                ["doc_id", "text_key", "fingerprint"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text",
    ).mapInArrow(run, "doc_id long, text_key long, fingerprint long")


def position_sets(distance: int) -> list[int]:
    """Masks of all sets of byte positions that two fingerprints so close must share one of."""
    masks = []
    for free in combinations(range(BYTES), distance):
        mask = 2**64 - 1
        for position in free:
            mask ^= 0xFF << 8 * position
        masks.append(mask)
    return masks


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _flips(free: int, distance: int) -> np.ndarray:
    """All values with 1 to `distance` bits set, each in a byte that is free."""
    bits = [1 << b for b in range(64) if free >> b & 1]
    return np.array([sum(c) for n in range(1, distance + 1) for c in combinations(bits, n)], np.uint64)


def close_pairs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, free: np.ndarray,
                distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs inside each list of distinct fingerprints that differ in at most `distance` bits.

    Lists lie one after the other in `values`; `free` has the mask of a list's free bits.
    """
    lefts, rights = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    short = sizes <= SHORT_LIST
    ends = np.repeat(starts[short] + sizes[short], sizes[short])
    own = ragged(starts[short], sizes[short])
    step = 1
    while len(own):
        more = own + step < ends
        own, ends = own[more], ends[more]
        a, b = values[own], values[own + step]
        differing = (a ^ b).view(np.uint8).reshape(-1, BYTES)
        shared = (differing == 0).sum(axis=1)  # the tally of positional bytes
        close = (shared >= BYTES - distance) & (np.bitwise_count(a ^ b) <= distance)
        lefts.append(a[close])
        rights.append(b[close])
        step += 1
    for start, size, mask in zip(starts[~short], sizes[~short], free[~short], strict=True):
        own = np.sort(values[start:start + size])
        for flip in _flips(int(mask), distance):
            other = own ^ flip
            at = np.minimum(np.searchsorted(own, other), size - 1)
            hit = (own[at] == other) & (own < other)
            lefts.append(own[hit])
            rights.append(other[hit])
    return np.concatenate(lefts), np.concatenate(rights)


def _links(distance: int):
    masks = np.array([~np.uint64(m) for m in position_sets(distance)], np.uint64)

    def search(sets, keys, values):
        new = np.flatnonzero(np.r_[True, (sets[1:] != sets[:-1]) | (keys[1:] != keys[:-1])])
        sizes = np.diff(np.r_[new, len(sets)])
        several = sizes > 1
        a, b = close_pairs(values, new[several], sizes[several], masks[sets[new[several]]], distance)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b).view(np.int64)), pa.array(np.maximum(a, b).view(np.int64))], ["a", "b"])

    def run(batches):
        """Rows come sorted by key; the last list of a batch waits for the next batch."""
        waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("positions", "key", "fingerprint")]
            if waiting is not None:
                own = [np.concatenate(pair) for pair in zip(waiting, own, strict=True)]
            sets, keys, values = own
            tail = len(sets) - 1
            same = (sets == sets[tail]) & (keys == keys[tail])
            cut = len(sets) - int(same.sum())
            waiting = [x[cut:] for x in own]
            if cut:
                yield search(sets[:cut], keys[:cut], values[:cut].view(np.uint64))
        if waiting is not None:
            yield search(waiting[0], waiting[1], waiting[2].view(np.uint64))

    return run


def fingerprint_links(distinct: DataFrame, distance: int = 2) -> DataFrame:
    """Pairs a, b of distinct fingerprints that differ in at most `distance` bits, each once."""
    postings = distinct.select("fingerprint", F.explode(F.array(*[
        F.struct(F.lit(i).alias("positions"), F.col("fingerprint").bitwiseAND(F.lit(_signed(mask))).alias("key"))
        for i, mask in enumerate(position_sets(distance))])).alias("p"))
    listed = postings.select("p.positions", "p.key", "fingerprint").repartition(
        "positions", "key").sortWithinPartitions("positions", "key")
    return listed.mapInArrow(_links(distance), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, text_key (xxhash64) and group_key of every row.

    component_id is the smallest doc_id that links reach, the row itself included. Documents without
    words (NULL, empty) share fingerprint zero and are linked like any others. A NULL doc_id keeps
    its row and its links but is never the smallest; group_key, the root fingerprint as a number, tells
    groups apart that have no doc_id at all. Equal fingerprints are one node, however many
    rows hold them; no pairs of rows are made.
    """
    shared_folder(docs.sparkSession)
    rows = fingerprint_table(docs).checkpoint()
    nodes = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc"))
    roots = connected_components(fingerprint_links(nodes.select("fingerprint"), distance))
    placed = nodes.join(roots, nodes.fingerprint == roots.node, "left").select(
        "fingerprint", "first_doc", F.coalesce("root", "fingerprint").alias("root"))
    least = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    known = placed.join(least, "root").select("fingerprint", "component_id", "root")
    return rows.join(known, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", "text_key",
        F.col("root").alias("group_key"))
