"""Periodic runs of words by a suffix automaton whose link tree is kept for link-cut access.

A run is a stretch with smallest period q that no neighbouring word extends. Appending word i to the
automaton gives a path of suffix links from the whole prefix to the root: the suffixes that end at i.
Every segment of that path carries the place where its suffixes ended last. Access recolours the path
with i and meets each old segment once: if its longest suffix has L words and ended last at j, the
last L + i - j words repeat after d = i - j words. Where d <= L they hold a square with period d, and
no shorter one, as its suffix would have ended later than j. Comparing words left and right of it
gives the run; each run is met at the end of its first square at the latest.

The automaton takes microseconds a word, so it is given only stretches that can hold a run long enough:
in a run every group of `gram` words behind the first period has the same group at most q words before
it. Stretches of groups that repeat so near are found with sorted hashes; equal groups always have equal
hashes, so no run is missed, and a false stretch costs time only.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.texts import chunks, mix, run_hashes, utf8, word_hashes, word_table

LEAST = 24  # words
POWER = 3  # periods
ROUNDS = 16  # of narrowing; ending early leaves stretches wider than needed


class Automaton:
    """Suffix automaton over word numbers; preferred paths of the link tree are splay trees of one colour.

    Node 0 stands for none, node 1 is the root. The colour of a path is kept at the root of its splay
    tree: the place where the strings of all its nodes ended last.
    """

    def __init__(self):
        self.length = array("i", [-1, 0])
        self.link = array("i", [0, 0])
        # The first transition of a state; nearly all states have no other. Others are in `more`.
        self.word, self.target = array("i", [-1, -1]), array("i", [0, 0])
        self.more: dict[int, dict[int, int]] = {}
        self.left, self.right = array("i", [0, 0]), array("i", [0, 0])
        self.parent, self.colour = array("i", [0, 0]), array("i", [-1, -1])
        self.whole = 1

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(-1)
        self.target.append(0)
        self.left.append(0)
        self.right.append(0)
        self.parent.append(0)
        self.colour.append(-1)
        return len(self.length) - 1

    def _next(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.target[state]
        others = self.more.get(state)
        return others.get(word, 0) if others else 0

    def _set(self, state: int, word: int, target: int) -> None:
        if self.word[state] in (word, -1):
            self.word[state], self.target[state] = word, target
        else:
            self.more.setdefault(state, {})[word] = target

    def _splay(self, x: int) -> None:
        left, right, parent = self.left, self.right, self.parent
        top, p = x, parent[x]
        while p and (left[p] == top or right[p] == top):
            top, p = p, parent[p]
        if top == x:
            return
        self.colour[x] = self.colour[top]
        while True:
            p = parent[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = parent[p]
            if g and (left[g] == p or right[g] == p):
                self._rotate(p if (left[p] == x) == (left[g] == p) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        left, right, parent = self.left, self.right, self.parent
        p = parent[x]
        g = parent[p]
        if left[p] == x:
            child = right[x]
            left[p] = child
            right[x] = p
        else:
            child = left[x]
            right[p] = child
            left[x] = p
        if child:
            parent[child] = p
        parent[p] = x
        parent[x] = g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def _insert_above(self, new: int, node: int) -> None:
        """Make `new` the parent of `node`, below the old one; it ended last where `node` did."""
        self._splay(node)
        upper = self.left[node]
        self.left[new] = upper
        if upper:
            self.parent[upper] = new
        self.left[node] = new
        self.parent[new] = node

    def append(self, word: int, place: int) -> list[tuple[int, int]]:
        """Add a word; (longest suffix, earlier end) of every segment of the path that ended before."""
        length, link = self.length, self.link
        new = self._state(length[self.whole] + 1, 1)
        state = self.whole
        while state and not self._next(state, word):
            self._set(state, word, new)
            state = link[state]
        if state:
            found = self._next(state, word)
            if length[found] != length[state] + 1:
                copy = self._state(length[state] + 1, link[found])
                self.word[copy], self.target[copy] = self.word[found], self.target[found]
                if found in self.more:
                    self.more[copy] = dict(self.more[found])
                self._insert_above(copy, found)
                link[found] = copy
                while state and self._next(state, word) == found:
                    self._set(state, word, copy)
                    state = link[state]
                found = copy
            link[new] = found
        self.parent[new] = link[new]
        self.whole = new
        return self._access(new, place)

    def _access(self, node: int, place: int) -> list[tuple[int, int]]:
        right, parent, colour = self.right, self.parent, self.colour
        met, below, x = [], 0, node
        while x:
            self._splay(x)
            deeper = right[x]
            if deeper:
                colour[deeper] = colour[x]  # keeps its place, as a path of its own
            if colour[x] >= 0:
                met.append((self.length[x], colour[x]))
            right[x] = below
            below = x
            x = parent[x]
        colour[below] = place
        self._splay(node)
        return met


def runs_of(words: list[int], first: int, last: int, least: int, power: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs with a square in words `first` to `last`, that are long enough."""
    automaton, found, ends = Automaton(), [], {}
    total = len(words)
    for i in range(first, last):
        for suffix, j in automaton.append(words[i], i):
            period = i - j
            if period > suffix or ends.get(period, -1) >= i:
                continue
            start = i - suffix
            while start >= period and words[start] == words[start - period]:
                start -= 1
            start += 1 - period
            end = i + 1
            while end < total and words[end] == words[end - period]:
                end += 1
            ends[period] = end - 1
            if end - start >= max(least, power * period):
                found.append((start, end - start, period))
    return found


def stretches(hashes: np.ndarray, owners: np.ndarray, ends: np.ndarray, firsts: np.ndarray,
              least: int, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts of the texts, as first and last word, outside which no long enough run lies.

    `hashes` has the words of all texts; `owners`, `ends` and `firsts` tell the text of a word, and
    where each text ends and begins.
    """
    behind = least - least // power  # words of a run behind its first period, at least
    gram = max(1, behind // 2)
    none = np.zeros(0, np.int64)
    if len(hashes) < least:
        return none, none
    keys = run_hashes(hashes, gram)
    at = np.flatnonzero(np.arange(gram, len(keys) + gram) <= ends[owners[:len(keys)]])
    keys = keys[at] + mix(owners[at].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    place = at[order[same + 1]]
    gap = place - at[order[same]]
    again = np.argsort(place)
    place, gap = place[again], gap[again]
    for _ in range(ROUNDS):
        if not len(place):
            return none, none
        # A step to the next place leaves a stretch; a text has less than `gram` places fewer than words.
        new = np.r_[True, (np.diff(place) != 1) | (owners[place[1:]] != owners[place[:-1]])]
        number = np.cumsum(new) - 1
        size = np.bincount(number)
        reach = (size + gram - 1) // (power - 1)
        keep = (gap <= reach[number]) & (size[number] >= behind - gram + 1)
        if keep.all():
            break
        place, gap = place[keep], gap[keep]
    if not len(place):
        return none, none
    new = np.r_[True, (np.diff(place) != 1) | (owners[place[1:]] != owners[place[:-1]])]
    starts = place[new]
    sizes = np.diff(np.r_[np.flatnonzero(new), len(place)])
    text = owners[starts]
    low = np.maximum(starts - (sizes + gram - 1) // (power - 1), firsts[text])
    high = np.minimum(starts + sizes + gram - 1, ends[text])
    # Stretches of one text that overlap become one.
    reached = np.maximum.accumulate(high)
    apart = np.r_[True, low[1:] >= reached[:-1]]
    group = np.flatnonzero(apart)
    return np.minimum.reduceat(low, group), np.maximum.reduceat(high, group)


_RESULT = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
           "collapsed string")


def find_runs(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the collapsed text of every row.

    Words are runs of bytes other than space and 0x09 to 0x0D, compared as they are. A run has at least
    `least` words and `power` (2 or more) periods. The collapsed text has the words, joined by single
    spaces, that no run holds behind its first period. A NULL or empty text has no words and no runs.
    One narrow pass: repeated rows stay repeated, a NULL doc_id stays NULL, other columns are not read.
    Memory depends on a chunk of texts, or on one very long text and the automaton of its stretches.
    """
    if power < 2 or least < power:
        raise ValueError("a run needs two periods, and as many words as periods")

    def run(batches):
        for batch in chunks(batches):
            texts = utf8(batch.column("text"))
            table = word_table(texts)
            stops = table.firsts + table.counts
            low, high = stretches(word_hashes(table), table.owners, stops, table.firsts, least, power)
            found: list[list] = [[] for _ in texts]
            joined = [
                table.flat[table.starts[first]:table.ends[stop - 1]] if stop > first else b""
                for first, stop in zip(table.firsts.tolist(), stops.tolist(), strict=True)]
            for text in np.unique(table.owners[low]).tolist():
                words = joined[text].split(b" ")
                numbers: dict[bytes, int] = {}
                ids = [numbers.setdefault(word, len(numbers)) for word in words]
                base, own = int(table.firsts[text]), table.owners[low] == text
                several = set()
                for a, b in zip(low[own].tolist(), high[own].tolist(), strict=True):
                    several.update(runs_of(ids, a - base, b - base, least, power))
                if several:
                    found[text] = sorted(several, key=lambda r: (r[0], r[2]))
                    edges = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in found[text]:
                        edges[start + period] += 1
                        edges[start + length] -= 1
                    stays = np.cumsum(edges[:-1]) == 0
                    joined[text] = b" ".join([words[i] for i in np.flatnonzero(stays).tolist()])
            flat = np.array([r for own in found for r in own], np.int64).reshape(-1, 3)
            offsets = pa.array(np.r_[0, np.cumsum([len(own) for own in found])], pa.int32())
            triples = pa.StructArray.from_arrays(
                [pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(table.counts, pa.int64()),
                 pa.ListArray.from_arrays(offsets, triples), pa.array(joined, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _RESULT)
