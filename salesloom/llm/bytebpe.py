"""Byte-level BPE from a rank file: texts to ids with offsets, and ids back to bytes.

The rank file lists byte strings. Each byte gets a printable character, so that the tokenizers library
can hold the vocabulary as text, and every entry gets the one pair that its own merges end with. A
pair is merged in a text only if all lower ranks are merged already, so no other pair of the same
entry ever meets, and ids are those of merging by rank.

Texts are read in pieces that end where a match of the pattern must end: before white space that
follows something else. A piece without such a place stays whole, as do the merges inside one match.
Matches of the pattern are merged apart from each other, so each distinct one of a task goes through
the library once, and the ids of a text are gathered from those of its matches.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.texts import chunks, ragged, utf8

PIECE = 1 << 16  # characters
GROUP = PIECE * 4  # characters of pieces that are looked up together
REMEMBERED = 1 << 21  # characters of distinct matches that a task holds before it starts anew
# Characters with the property White_Space.
_SPACE = "\t-\r " + "".join(map(chr, (
    0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_END = re.compile(f"[^{_SPACE}](?=[{_SPACE}])")


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """A printable character for each byte: its own, or the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (chr(c) for c in range(0x100, 0x200))
    return [chr(b) if b in printable else next(others) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that merging by rank leaves of an entry before its last merge."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        merged = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        known = [(rank, place) for place, rank in enumerate(merged) if rank is not None]
        if not known:
            return None
        place = min(known)[1]
        parts[place:place + 2] = [parts[place] + parts[place + 1]]
    return parts[0], parts[1]


class Codec:
    """What tasks need of a rank file: the tokenizer as text, and the bytes of every id."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        characters = byte_characters()
        text = {token: "".join(map(characters.__getitem__, token)) for token in ranks}
        pairs = [_last_pair(token, ranks) for token in sorted(ranks, key=ranks.__getitem__) if len(token) > 1]
        merges = [(text[p[0]], text[p[1]]) for p in pairs if p]
        # An entry that its own merges never give is found only as a whole match.
        model = models.BPE(vocab={text[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
        tokenizer = Tokenizer(model)
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.state, self.pattern = tokenizer.to_str(), pattern
        values = {character: byte for byte, character in enumerate(characters)}
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for name, rank in tokenizer.get_vocab().items():
            tokens[rank] = bytes(map(values.__getitem__, name))
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([*map(len, tokens)], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes


@lru_cache(maxsize=2)
def _tokenizer(state: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(state)


def pieces(text: str, size: int = PIECE) -> list[str]:
    """Parts of a text, each encoded alone, whose ids one after the other are those of the text."""
    found, start = [], 0
    while len(text) - start > size:
        end = _END.search(text, start + size - 1)
        if not end:
            break
        found.append(text[start:end.end()])
        start = end.end()
    return [*found, text[start:]]


class Encoder:
    """Ids of texts in a task; remembers those of a bounded number of matches."""

    def __init__(self, codec: Codec):
        import regex

        self.matches, self.tokenizer = regex.compile(codec.pattern), _tokenizer(codec.state)
        self._forget()

    def _forget(self):
        self.places: dict[str, int] = {}
        self.held = 0
        self.ids, self.sizes, self.starts = (np.zeros(0, kind) for kind in (np.int32, np.int64, np.int64))

    def _learn(self, words: list[str]):
        found = [one.ids for one in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        self.places.update(zip(words, range(len(self.places), len(self.places) + len(words)), strict=True))
        self.held += sum(map(len, words))
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.int32)])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, found), np.int64, len(found))])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _group(self, parts: list[str]) -> tuple[np.ndarray, list[int]]:
        split = [self.matches.findall(part) for part in parts]
        if self.held > REMEMBERED:
            self._forget()
        new = list(dict.fromkeys(word for word in chain.from_iterable(split) if word not in self.places))
        if new:
            self._learn(new)
        words = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.places.__getitem__, chain.from_iterable(split)), np.int64, int(words.sum()))
        sizes = self.sizes[at]
        sums = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(words)]]
        return self.ids[ragged(self.starts[at], sizes)], np.diff(sums)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        parts = [(row, part) for row, text in enumerate(texts) for part in pieces(text)]
        ids, counts, start = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64), 0
        while start < len(parts):
            stop, room = start + 1, GROUP - len(parts[start][1])
            while stop < len(parts) and room > 0:
                room -= len(parts[stop][1])
                stop += 1
            own, sizes = self._group([part for _, part in parts[start:stop]])
            ids.append(own)
            np.add.at(counts, [row for row, _ in parts[start:stop]], sizes)
            start = stop
        return np.concatenate(ids), counts


def token_bytes(codec: Codec, ids: np.ndarray) -> np.ndarray:
    """The bytes of ids, one after the other."""
    return codec.data[ragged(codec.starts[ids], codec.sizes[ids])]


def character_spans(sizes: np.ndarray, text: bytes, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token in its text and the one behind its last.

    `sizes` has the bytes of the tokens of all texts, which are joined in `text`; `counts` how many
    tokens each text has. Tokens that share the bytes of one character both span it.
    """
    if not len(sizes):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    character = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80, dtype=np.int32) - np.int32(1)
    ends = np.cumsum(sizes)
    first = character[ends - sizes]
    some = counts[counts > 0]
    base = np.repeat(first[np.cumsum(some) - some], some)
    return first - base, character[ends - 1] + np.int32(1) - base


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))


def encode(docs: DataFrame, codec: Codec) -> DataFrame:
    """doc_id, ids, starts and ends of every row: the tokens of the whole text and the characters they span.

    No special tokens; their strings inside a text are ordinary text. A NULL or empty text has three
    empty arrays. One narrow pass: repeated rows stay repeated, a NULL doc_id stays NULL, other columns
    are not read. Memory depends on a chunk of texts, or on one very long text and its ids, besides what
    the longest single match of the pattern takes to merge.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)  # a vocabulary: a few megabytes

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        own = shared.value
        encoder = Encoder(own)
        for batch in chunks(batches, limit=1 << 20):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            ids, counts = encoder.encode(texts)
            starts, ends = character_spans(own.sizes[ids], b"".join(utf8(batch.column("text"))), counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(_lists(v, counts) for v in (ids, starts, ends))],
                ["doc_id", "ids", "starts", "ends"])

    kind = "array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, ids {kind}, starts {kind}, ends {kind}")


def decode(encoded: DataFrame, codec: Codec, into: str = "decoded") -> DataFrame:
    """All rows and columns of `encoded`, and the bytes of its `ids` as binary column `into`.

    Bytes are joined before anything reads them as text, so a character split over tokens comes out
    whole; `decode_text` shows those that ids leave incomplete as U+FFFD. NULL or empty ids give no
    bytes; an id NULL or outside the vocabulary stops the query.
    """
    if into in encoded.columns:
        raise ValueError(f"the rows have a column {into} already")
    shared = encoded.sparkSession.sparkContext.broadcast(codec)

    def run(batches):
        own = shared.value
        for batch in batches:
            start = 0
            lists = batch.column("ids")
            sizes = np.array([n or 0 for n in lists.value_lengths().to_pylist()], np.int64)
            ends = np.cumsum(sizes)
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + (1 << 19), "right")))
                part = batch.slice(start, stop - start)
                ids = part.column("ids").flatten().to_numpy(zero_copy_only=False)
                if ids.dtype.kind != "i" or len(ids) and not 0 <= ids.min() <= ids.max() < len(own.sizes):
                    raise ValueError("an id is not in the vocabulary")
                lengths = np.add.reduceat(np.r_[own.sizes[ids], 0], np.cumsum(sizes[start:stop]) - sizes[start:stop])
                lengths[sizes[start:stop] == 0] = 0
                offsets = np.r_[0, np.cumsum(lengths)]
                kind = pa.int64() if offsets[-1] >= 2**31 else pa.int32()
                large = kind == pa.int64()
                joined = (pa.LargeBinaryArray if large else pa.BinaryArray).from_buffers(
                    pa.large_binary() if large else pa.binary(), stop - start,
                    [None, pa.array(offsets, kind).buffers()[1], pa.py_buffer(token_bytes(own, ids).tobytes())])
                yield pa.RecordBatch.from_arrays([*part.columns, joined], [*part.schema.names, into])
                start = stop

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{kinds}, `{into}` binary")


def decode_text(data: bytes) -> str:
    """Decoded bytes as text; bytes that are no whole character become U+FFFD."""
    return data.decode("utf-8", "replace")
