"""Token counts and packing against the libraries, and the invariants of packed sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from salesloom.llm import packing, tokens

ODD = [
    "", " ", "  a  b\n\nc\t", "Ａ ﬁ é́ \xa0x 　y", "<s></s><unk><0x0A>", "▁a▁b   ", "x" * 3000,
    "ngngng" * 300, "\0 \x01", "日本語テスト 漢字", "a <|endoftext|>b", "a  <|endoftext|> ", "it's we'll  12 3!!",
    " \n x", "tail ", "a \x1cb", " x  y", None, "same text", "same text",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    letters = "aeinngtth  hes\n▁é1.,"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 900))) for _ in range(150)]


def test_counts_are_those_of_the_library(spark, documents, tokenizer_path, texts):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = tokens.count_tokens(documents(list(enumerate(texts))), path, limit=300).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]] or ""
        size = len(model.encode(text, num_threads=1))
        assert tuple(row)[1:] == (len(text.encode()), size, size > 300)


def test_long_units_and_short_units_merge_alike(tokenizer_path):
    merges = tokens.merges_of(tokenizer_path("piece_bpe_32k.model"))
    units = ["▁" + "ngingth" * 30, "▁the", "▁▁▁▁▁a", "internationalization"]
    assert merges._count_together(units).tolist() == [merges._count_alone(u) for u in units]


def test_counts_of_nothing(documents, tokenizer_path):
    path = tokenizer_path("piece_bpe_32k.model")
    assert tokens.count_tokens(documents([]), path).count() == 0
    assert tuple(tokens.count_tokens(documents([(None, None)]), path).first()) == (None, 0, 0, False)


def ids_of(tokenizer_path, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    return [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def test_ids_are_those_of_the_library(tokenizer_path, texts):
    runs = [" " * 1000, "\n" * 1001, " \t" * 5000, "\u2003" * 2000, " " * 999 + "\x1c"]
    texts = [*texts, *(f"{a}{run}{b}" for run in runs for a in ("", "x", "é'") for b in ("", "y", "<|endoftext|>", "'s", "1"))]
    found = packing.encode(texts, tokenizer_path("byte_bpe_50k.tiktoken"))
    assert [x.tolist() for x in found] == ids_of(tokenizer_path, texts)


@pytest.mark.parametrize("window", [1024, 64])
def test_every_id_lies_in_one_piece(documents, tokenizer_path, texts, window):
    rows = packing.pack(documents(list(enumerate(texts))), tokenizer_path("byte_bpe_50k.tiktoken"), window).collect()
    ids = ids_of(tokenizer_path, texts)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row["doc_id"]].append(row)
        by_sequence[row["sequence_id"]].append(row)
    assert set(by_doc) == set(range(len(texts)))
    for doc, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids[doc])
            part = np.array(ids[doc][at:at + p["length"]], "<u4")
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
            at += p["length"]
        assert at == len(ids[doc])
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window and (at == window or at & (at - 1) == 0)


def test_packing_nothing_and_repeats(documents, tokenizer_path):
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    assert packing.pack(documents([]), path).count() == 0
    rows = packing.pack(documents([(1, "a b"), (1, "a b"), (None, None)]), path).collect()
    assert sum(r["length"] for r in rows if r["doc_id"]) == 6 and sum(r["length"] for r in rows) == 7
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)


def brute_bm25(tails, seed, idf, mean):
    """Scores of all tails for all distinct terms of a seed, one tail after the other."""
    scores = []
    for tail in tails:
        tf = np.array([(tail == t).sum() for t in np.unique(tails[seed])])
        own = idf[np.unique(tails[seed])] * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len(tail) / mean))
        scores.append(own.sum())
    return np.array(scores)


def test_windows_are_filled_with_the_best_unused_neighbours():
    rng = np.random.default_rng(1)
    chance = 1 / np.arange(1, 401)
    tails = [rng.choice(400, rng.integers(5, 60), p=chance / chance.sum()) for _ in range(60)]
    tails[40:45] = [tails[3]] * 5
    idf, mean, window = rng.random(400) + 0.1, 30.0, 64
    index = packing.ShardIndex(tails, idf, mean)
    scores = np.array([brute_bm25(tails, seed, idf, mean) for seed in range(60)])
    for seed in range(60):
        assert index.scores(seed) == pytest.approx(scores[seed])
    sizes = np.array([len(t) for t in tails])
    for last in (False, True):
        pieces, placed = packing.fill_windows(tails, idf, mean, window, last)
        assert placed.tolist() == sizes.tolist() if last else (placed <= sizes).all()
        used, want = np.zeros(60, np.int64), []
        for seed in range(60):
            def unused(of, least, members):
                found = [t for t in range(60) if t not in members and used[t] < sizes[t] and scores[of, t] > 0]
                return sorted((t for t in found if scores[of, t] >= least), key=lambda t: (-scores[of, t], t))

            members, filled = [seed], sizes[seed] - used[seed]
            if not filled or not last and not unused(seed, 0.5 * scores[seed, seed], members):
                continue
            while filled < window and unused(seed, 0, members):
                first = unused(seed, 0, members)[0]
                for tail in [first, *unused(first, 0.5 * scores[first, first], [*members, first])]:
                    if filled < window:
                        members.append(tail)
                        filled += sizes[tail] - used[tail]
            if filled < window:
                continue
            offset = 0
            for tail in members:
                take = min(sizes[tail] - used[tail], window - offset)
                want.append((tail, used[tail], used[tail] + take, offset))
                used[tail], offset = used[tail] + take, offset + take
        assert len(want) > 10
        assert [(t, a, b, offset) for t, a, b, _, offset in pieces[:len(want)]] == want
        assert last or len(pieces) == len(want)


def test_tails_that_fill_their_windows_exactly_leave_nothing():
    tails = [np.full(32, 7)] * 4
    pieces, placed = packing.fill_windows(tails, np.ones(10), 32.0, 64, True)
    assert placed.tolist() == [32] * 4 and {p[3] for p in pieces} == {0, 1}


def test_a_bound_never_hides_a_close_neighbour():
    rng = np.random.default_rng(2)
    tails = [rng.integers(0, 90, rng.integers(1, 40)) for _ in range(80)]
    index = packing.ShardIndex(tails, rng.random(90), 20.0)
    for seed in range(80):
        for need in index.own[seed] * np.array([0.1, 0.4, 0.8, 1.0]):
            open_tails = rng.random(80) < 0.5
            others = open_tails & (np.arange(80) != seed)
            found = index.reached(seed, need, open_tails)
            if (index.scores(seed)[others] >= need).any():
                assert found is not None
            assert found is None or found == pytest.approx(index.scores(seed))


def test_lists_are_short_and_common_terms_count_in_full():
    """Terms of most tails are summed once; a seed reads no list of more than a part of the shard."""
    rng = np.random.default_rng(4)
    tails = [np.r_[np.arange(20), rng.integers(20, 4000, 60)] for _ in range(320)]
    idf = rng.random(4000) + 0.1
    index = packing.ShardIndex(tails, idf, 80.0)
    for seed in (0, 100, 319):
        assert index.scores(seed) == pytest.approx(brute_bm25(tails, seed, idf, 80.0))
    assert index.sizes.max() <= 320 // 16


def test_keys_agree_as_often_as_weighted_terms():
    rng = np.random.default_rng(3)
    idf = rng.random(3000) * 8 + 0.1
    one = rng.choice(3000, 100, replace=False)
    two = np.r_[one[:80], rng.choice(3000, 20)]
    same = 0
    for search in range(60):
        ranks = packing.content_hashes(idf, search)
        a, b = packing.content_keys([one, two], ranks).view(np.uint64)
        same += sum(int(a) >> s & 0xFFFF == int(b) >> s & 0xFFFF for s in (0, 16, 32, 48))
    both, either = np.intersect1d(one, two), np.union1d(one, two)
    assert same / 240 == pytest.approx(idf[both].sum() / idf[either].sum(), abs=0.1)
    assert len(packing.content_keys([], ranks)) == 0


def test_neighbours_are_found_over_all_shards(documents, tokenizer_path):
    """Pairs of near copies among more tails than a shard holds stand side by side."""
    rng = random.Random(5)
    words = [f"{a}{b}{c}" for a in "bdgklm" for b in "aeiou" for c in "bdgklmnprst"]
    rows = []
    for pair in range(200):
        text = " ".join(rng.choice(words) for _ in range(30))
        rows += [(2 * pair, text), (2 * pair + 1, text + " " + rng.choice(words))]
    found = packing.pack(documents(rows), tokenizer_path("byte_bpe_50k.tiktoken"), 128, shard=32).collect()
    of_doc = defaultdict(set)
    for row in found:
        of_doc[row["doc_id"]].add(row["sequence_id"])
    together = sum(bool(of_doc[2 * pair] & of_doc[2 * pair + 1]) for pair in range(200))
    print("pairs together", together)
    assert together >= 180
    ids = ids_of(tokenizer_path, [text for _, text in rows])
    assert sum(r["length"] for r in found) == sum(map(len, ids))
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)
    by_sequence = defaultdict(int)
    for row in found:
        by_sequence[row["sequence_id"]] += row["length"]
        part = np.array(ids[row["doc_id"]][row["start"]:row["start"] + row["length"]], "<u4")
        assert row["ids_crc32"] == zlib.crc32(part.tobytes())
    assert all(n == 128 or n & (n - 1) == 0 for n in by_sequence.values())


def test_one_huge_document_copies_and_clashing_columns(spark, tokenizer_path):
    """A long text, many copies of one tail over several shards, and columns with names of the operator's own."""
    rows = [(0, "long text " * 40_000, 1, "x"), *((i, "the same short text", 2, "y") for i in range(1, 301))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, unit int, sequence_id string")
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    found = packing.pack(docs, path, 64, shard=16).collect()
    sizes = [len(i) for i in ids_of(tokenizer_path, [r[1] for r in rows])]
    lengths = defaultdict(int)
    for row in found:
        lengths[row["doc_id"]] += row["length"]
    assert [lengths[i] for i in range(301)] == sizes
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)
