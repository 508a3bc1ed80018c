"""Substring dedup, SimHash and embedding near-duplicates against brute force."""

import tracemalloc
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from salesloom.llm import components, simhash, substrings, vectors


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(7, 7), (3, None)]
    found = dict(components.connected_components(spark.createDataFrame(edges, "x long, y long")).collect())
    real = [(a, b) for a, b in edges if b is not None and a != b]
    assert found == roots_of({n for e in real for n in e}, real)
    assert components.connected_components(spark.createDataFrame([], "x long, y long")).count() == 0


def brute_repeats(rows, window):
    seen, gone = {}, {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc, text in order:
        words = (text or "").encode().split()
        gone[doc] = set()
        for start in range(len(words) - window + 1):
            key = tuple(words[start:start + window])
            if seen.setdefault(key, (doc, start)) != (doc, start):
                gone[doc].update(range(start, start + window))
    return {
        doc: (len((text or "").encode().split()), len(gone[doc]),
              b" ".join(w for i, w in enumerate((text or "").encode().split()) if i not in gone[doc]).decode())
        for doc, text in rows}


def corpus(rng, size, vocabulary=60):
    words = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(vocabulary)]
    passages = [[rng.choice(words) for _ in range(rng.randint(8, 60))] for _ in range(6)]
    rows = []
    for doc in range(size):
        text = []
        for _ in range(rng.randint(0, 5)):
            text += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randint(1, 50))]
        rows.append((doc, rng.choice([" ", "\n", "  \t"]).join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_match_brute_force(documents, seed):
    rng = random.Random(seed)
    rows = corpus(rng, 80) + [(900, "one " * 70), (901, None), (902, ""), (903, "one " * 25), (None, "two " * 30), (950, "two " * 25)]
    found = substrings.remove_repeats(documents(rows).repartition(5), 20)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "result"]
    got = {r["doc_id"]: tuple(r["result"]) for r in found.collect()}
    assert got == brute_repeats(rows, 20)


def test_passed_over_minimisers_change_nothing(documents, monkeypatch):
    monkeypatch.setattr(substrings, "COMMON", 1)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 3_000)
    rows = corpus(random.Random(4), 120, vocabulary=12)
    docs = documents(rows).repartition(6)
    assert len(substrings.survey(docs, 20)[0])
    got = {r["doc_id"]: tuple(r["result"]) for r in substrings.remove_repeats(docs, 20).collect()}
    assert got == brute_repeats(rows, 20)


def test_a_bucket_is_counted_in_parts(monkeypatch):
    """Windows are sorted for a part of a bucket at a time, and none is missed."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(40)]
    texts += [" ".join([*t.split()[:45], "x"]) for t in texts]
    batch = pa.record_batch({
        "doc_id": pa.array(range(80), pa.int64()), "text_key": pa.array(range(80), pa.int32()), "text": texts})
    sizes, whole = [], substrings.repeated_windows

    def counted(ids, places, some, window):
        sizes.append(len(some))
        return whole(ids, places, some, window)

    monkeypatch.setattr(substrings, "repeated_windows", counted)
    pieces = list(substrings._split(20, np.zeros(0, np.uint64), 1)([batch]))
    found = pa.Table.from_batches(substrings._count(20)(pieces)).to_pylist()
    assert max(sizes) < sum(sizes) / 3
    gone = {(r["doc_id"], r["place"] + i) for r in found for i in range(r["words"])}
    assert gone == {(doc, i) for doc in range(40, 80) for i in range(45)}


def test_colliding_hashes_are_told_apart(monkeypatch):
    texts = [b" ".join(b"%d" % (i * j) for i in range(25)) for j in (1, 2, 1)]
    monkeypatch.setattr(substrings, "run_hashes", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    row, place, size = substrings.repeated_windows(np.array([1, 2, 3]), np.zeros(3, int), texts, 20)
    assert (row.tolist(), place.tolist(), size.tolist()) == ([2], [0], [25])


def test_repeated_rows_are_one_document(documents, spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, text)]
    got = sorted((r["doc_id"], r["result"]["n_removed"]) for r in substrings.remove_repeats(documents(rows)).collect())
    assert got == [(1, 0), (1, 0), (2, 30)]
    assert substrings.remove_repeats(documents([])).count() == 0
    clash = documents(rows).withColumn("place", F.lit(1)).withColumn("ranges", F.lit(2)).withColumn("n_words", F.lit(3))
    assert substrings.remove_repeats(clash).columns[-4:] == ["place", "ranges", "n_words", "result"]
    with pytest.raises(ValueError):
        substrings.remove_repeats(clash.withColumn("result", F.lit(0)))


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_matches_brute_force(documents):
    rng = random.Random(6)
    rows = []
    for doc in range(60):
        words = [rng.choice("alpha Beta gamma δelta eps zeta eta theta".split()) + str(rng.randint(0, 30))
                 for _ in range(rng.randint(1, 300))]
        for copy in range(rng.randint(1, 4)):
            if copy:
                words[rng.randrange(len(words))] = "x"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "one"), (len(rows) + 3, "ONE two")]
    prints = {doc: brute_fingerprint(text) for doc, text in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = roots_of(prints, links)
    docs = documents(rows).withColumn("key", F.lit("clash")).withColumn("fingerprint", F.lit("clash"))
    found = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {
        doc: (f"{prints[doc]:016x}", roots[doc]) for doc in prints}


def test_links_between_fingerprints(spark, monkeypatch):
    rng = random.Random(8)
    values = {rng.getrandbits(64) for _ in range(40)}
    base = rng.getrandbits(64)
    values |= {base ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(1, 64, 5)}
    want = {(min(a, b), max(a, b)) for a in values for b in values if a != b and (a ^ b).bit_count() <= 2}
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    distinct = spark.createDataFrame(signed, "fingerprint long")
    for length in (128, 2):  # long lists are searched in another way
        monkeypatch.setattr(simhash, "SHORT_LIST", length)
        a_free = simhash.position_sets(2)
        assert len(a_free) == 28
        found = {(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.fingerprint_links(distinct).collect()}
        assert {(min(x), max(x)) for x in found} == want


def test_simhash_of_odd_tables(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    rows = simhash.near_duplicates(documents([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, None)])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in rows) == [(-1, -1), (-1, 5), (5, 5), (5, 5)]


def brute_vectors(rows, threshold):
    able = [(i, np.array(v, float), label) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for n, (i, v, label) in enumerate(able):
        for j, w, other in able[:n]:
            if label == other and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                links.append((i, j))
    counts = {r[0]: 0 for r in rows}
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    roots = roots_of(counts, links)
    return {i: (counts[i], roots[i], roots[i] == i) for i in counts}


def vector_rows(rng, groups, spread):
    rows = []
    for group in range(groups):
        centre = rng.standard_normal(32)
        for _ in range(rng.integers(1, 12)):
            v = (centre + spread * rng.standard_normal(32)).tolist()
            rows.append((len(rows), v, int(group % 3)))
    return rows


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = vector_rows(rng, 60, 0.08)
    rows += [(900, rows[0][1], rows[0][2]), (901, rows[0][1], None), (902, None, 1), (903, [0.0] * 32, 1),
             (904, [float("nan")] * 32, 1), (905, [None] * 32, 1), (906, [1.0] * 7, 1), (907, [1.0] * 7, 1),
             (908, [float("inf")] + [0.0] * 31, 1), (909, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1))
    got = {r["vec_id"]: tuple(r)[1:] for r in vectors.near_duplicates(frame, 0.93).collect()}
    assert got == brute_vectors(rows, 0.93)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold are the hardest to meet."""
    rng = np.random.default_rng(10)
    rows = []
    for _ in range(700):
        a = rng.standard_normal(32)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(32)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        cosine = 0.931
        rows.append((len(rows), a.tolist(), 1))
        rows.append((len(rows), (cosine * a + np.sqrt(1 - cosine**2) * b).tolist(), 1))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute_vectors(rows, 0.93)
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(frame, 0.93).collect()}
    assert all(got[i] <= want[i][0] for i in got)
    assert sum(got.values()) >= 0.95 * sum(w[0] for w in want.values())


def test_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 4)
    rows = vector_rows(np.random.default_rng(12), 20, 0.05)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: tuple(r)[1:] for r in vectors.near_duplicates(frame, 0.93).collect()}
    assert got == brute_vectors(rows, 0.93)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(13)
    units = vectors._units(rng.standard_normal((400, 64)))
    rotated, codes, factors = vectors.encode(units, vectors.rotation(64))
    exact = units @ units.T
    off = ~np.eye(400, dtype=bool)
    assert abs((rotated @ codes.T / factors - exact)[off].mean()) < 0.005
    assert (vectors.upper_bounds(rotated, codes, factors) >= exact - 1e-9).mean() > 0.9999


def test_digest_of_kept_text(documents):
    row = substrings.remove_repeats(documents([(1, " a\tb ")])).select(F.sha2("result.kept_text", 256)).first()
    assert row[0] == hashlib.sha256(b"a b").hexdigest()


def test_fingerprints_do_not_depend_on_pieces_and_blocks(monkeypatch):
    luck = random.Random(3)
    texts = [b"", b"a", b"a b", b"A b c", " \u00e9".encode() * 5, b"\t" * 40, b"x" * 500]
    texts += [b" ".join(luck.choice([b"ab", b"Cd", b"x" * 50, b"e"]) for _ in range(luck.randrange(300))) for _ in range(80)]
    whole = simhash.fingerprints(texts)
    for piece, block in ((7, 3), (64, 5), (300, 1000)):
        monkeypatch.setattr(simhash, "PIECE", piece)
        monkeypatch.setattr(simhash, "BLOCK", block)
        assert simhash.fingerprints(texts).tolist() == whole.tolist()


def test_memory_of_fingerprints_does_not_grow_with_a_text():
    luck = random.Random(4)
    text = b" ".join(b"%d" % luck.randrange(10**6) for _ in range(300_000))
    peaks = []
    for copies in (1, 6):
        tracemalloc.start()
        simhash.fingerprints([text * copies])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[0] < 40e6 and peaks[1] < 60e6  # two and twelve megabytes of text
