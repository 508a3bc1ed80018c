"""Periodic runs, phrase collocations and byte-level BPE against brute force and the tiktoken library."""

import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

from salesloom.llm import bytebpe, collocations, runs

ODD = ["", None, " \n\t ", "a", "x" * 3000, "été été. ÉTÉ", "日本語のテキスト🙂🙂 end", "a\x00b \x1c c d\u0085e  f", "<|endoftext|> don't 12ab"]


def all_runs(words, least, power):
    found = {}
    for q in range(1, len(words) // power + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(least, power * q):
                found.setdefault((i - q, j - i + q), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_texts(seed, count):
    luck = random.Random(seed)
    for _ in range(count):
        words = [luck.choice("abcdefgh"[:luck.choice([1, 2, 3, 6])]) for _ in range(luck.randrange(150))]
        if words and luck.random() < 0.7:
            a = luck.randrange(len(words))
            p = 1 + (len(words) - a) // luck.randint(2, 6)
            words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
            if luck.random() < 0.3:
                words[luck.randrange(len(words))] = "other"
        yield " ".join(words)


@pytest.mark.parametrize("least, power", [(24, 3), (2, 2), (9, 3), (6, 2)])
def test_runs_are_those_of_brute_force(spark, documents, least, power):
    rows = [*enumerate([*periodic_texts(least, 250), *ODD]), (None, "b " * 30), (3, "c " * 30), (3, "c " * 30)]
    found = runs.find_runs(documents(rows), least, power).collect()
    assert len(found) == len(rows)
    expected = Counter()
    for doc_id, text in rows:
        words = (text or "").encode().split()
        own = all_runs(words, least, power)
        gone = {i for s, n, q in own for i in range(s + q, s + n)}
        expected[doc_id, len(words), tuple(own), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()] += 1
    assert Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in found) == expected


def test_runs_of_one_long_text(spark, documents):
    part = [str(i) for i in range(20_000)]
    row = runs.find_runs(documents([(1, " ".join(["head", *part * 3, *part[:7], "tail"]))])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 60_007, 20_000)] and row["n_words"] == 60_009
    assert row["collapsed"] == " ".join(["head", *part, "tail"])
    assert runs.find_runs(documents([])).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(documents([]), power=1)


def all_phrases(rows, least, longest, share, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    result = []
    for lang, own in counts.items():
        kept = {p: a for p, a in own.items() if a >= least and len(p) > 1}
        longer = defaultdict(int)
        for p, a in kept.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i:i + k]] = max(longer[p[i:i + k]], a)
        scored = []
        for p, a in kept.items():
            if 100 * longer[p] < share * a:
                score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        result += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s)
                   for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(result)


@pytest.mark.parametrize("least, longest, share, top", [(3, 4, 80, 2000), (2, 2, 100, 5), (4, 5, 60, 40)])
def test_collocations_are_those_of_brute_force(spark, documents, least, longest, share, top):
    luck = random.Random(least)
    rows = []
    for i in range(300):
        words = [luck.choice(["de", "la", "New", "york", "a\x01", "a", "é", "zz\x00", "hot"]) for _ in range(luck.randrange(40))]
        rows.append((i, luck.choice([" ", "  ", "\t"]).join(words).replace("zz", "z.z"), luck.choice(["en", "fr", None, "und"])))
    rows += [(1, "hot hot hot hot " * 200, "en"), (None, "la la", "fr"), *((None, t, "xx") for t in ODD)]
    found = collocations.collocations(documents(rows), least, longest, share, top).collect()
    assert sorted(map(tuple, found)) == all_phrases([(t, lang) for _, t, lang in rows], least, longest, share, top)


def test_collocations_do_not_depend_on_the_ranges(spark, documents):
    rows = [(i, " ".join(f"w{(i * 7 + j) % 23}" for j in range(60)), "en") for i in range(80)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for parts in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            results.append(sorted(map(tuple, collocations.collocations(documents(rows)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == all_phrases([(t, lang) for _, t, lang in rows], 30, 4, 80, 2000)
    assert collocations.collocations(documents([])).count() == 0


@pytest.fixture(scope="module")
def rank_file(tokenizer_path):
    return tokenizer_path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec(rank_file):
    return bytebpe.Codec(rank_file, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(rank_file):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.read_ranks(rank_file), special_tokens={})


def random_texts(count):
    luck = random.Random(13)
    letters = "abcdeEé ñß  \n\t'sdvre0123.,!-\x00\x1c\u0085   　日本語ไทย한글🙂👨‍👩‍👧́ا"
    return ["".join(luck.choice(letters) for _ in range(luck.randrange(80))) for _ in range(count)]


def test_ids_and_spans_are_those_of_the_library(spark, documents, codec, library):
    rows = [*enumerate([*random_texts(1500), *ODD]), (None, "a b"), (7, "twice"), (7, "twice")]
    encoded = bytebpe.encode(documents(rows), codec)
    found = bytebpe.decode(encoded, codec).collect()
    expected = Counter((d, tuple(library.encode_ordinary(t or ""))) for d, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in found) == expected
    texts = {tuple(library.encode_ordinary(t or "")): t or "" for _, t in rows}
    for row in found:
        text = texts[tuple(row["ids"])]
        assert bytes(row["decoded"]) == text.encode()
        for token, start, end in zip(row["ids"], row["starts"], row["ends"], strict=True):
            assert library.decode_single_token_bytes(token) in text[start:end].encode()
        assert [*row["starts"]] == sorted(row["starts"])
        assert not text or (row["starts"][0], row["ends"][-1]) == (0, len(text))


def test_every_character_class_is_split_alike(codec, library):
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}1" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    ids, counts = bytebpe.Encoder(codec).encode(texts)
    assert ids.tolist() == [i for t in texts for i in library.encode_ordinary(t)] and counts.sum() == len(ids)


def test_long_texts_are_cut_where_matches_end(monkeypatch, codec, library):
    text = " ".join(random_texts(300))
    monkeypatch.setattr(bytebpe, "PIECE", 50)
    parts = bytebpe.pieces(text, 50)
    assert "".join(parts) == text and len(parts) > 50
    for group, remembered in ((1, 1), (400, 100), (10**6, 10**6)):
        monkeypatch.setattr(bytebpe, "GROUP", group)
        monkeypatch.setattr(bytebpe, "REMEMBERED", remembered)
        ids, counts = bytebpe.Encoder(codec).encode([text, "", text])
        assert ids.tolist() == library.encode_ordinary(text) * 2 and counts.tolist() == [len(ids) // 2, 0, len(ids) // 2]
    assert bytebpe.pieces("x" * 200, 50) == ["x" * 200]


def test_decoding_of_incomplete_characters_and_odd_rows(spark, codec, library):
    whole = library.encode_ordinary("🙂")
    assert len(whole) > 1
    rows = spark.createDataFrame([(1, whole[:1]), (2, []), (3, None), (4, whole)], "k int, ids array<int>")
    found = {r["k"]: bytes(r["decoded"]) for r in bytebpe.decode(rows, codec).collect()}
    assert found[2] == found[3] == b"" and found[4] == "🙂".encode()
    assert "�" in bytebpe.decode_text(found[1])
    with pytest.raises(ValueError):
        bytebpe.decode(rows, codec, into="k")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bytebpe.decode(spark.createDataFrame([(10**6,)], "i int").selectExpr("array(i) AS ids"), codec).collect()
