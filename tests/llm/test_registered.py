"""Registered queries against their SQL, and the pipeline's stages."""

from collections import Counter
from pathlib import Path

import pytest

from compare import connect, difference
from salesloom.llm.oracle import ORACLE
from salesloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) is None


def test_entry_registers_everything():
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


def test_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = docs.checkpoint()


def test_stages_do_what_their_operators_say(spark, documents):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, "one of the words in this text"), (2, "one of the words in this text"), (2, "one of the words in this text"),
            (3, f"start {passage} end"), (4, f"other {passage} stop"), (5, None)]
    kept = stages["near_duplicates"](spark, documents(rows), FOLDER)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5]
    same = "some words of one text"
    odd = [(None, same)] * 50 + [(None, None), (None, ""), (7, "this text is by itself"), (7, "and so is that other one"),
           (None, "one of the words in this text"), (9, "one of the words in this text")]
    kept = stages["near_duplicates"](spark, documents(odd), FOLDER).collect()
    assert Counter((r["doc_id"], r["text"] or "") for r in kept) == Counter([(None, same), (None, ""), *odd[52:54], odd[55]])
    cut = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages["repeated_passages"](spark, documents(rows), FOLDER).collect()}
    assert cut[4] == ("other stop", 10) and cut[3][0] == rows[3][1] and cut[1][0] == rows[0][1]
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first()["text"]
    clean = stages["benchmark_passages"](spark, documents([(1, f"x {item} y"), (2, "clean words"), (3, None)]), FOLDER)
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 3]
    sequences = stages["sequences"](spark, documents(rows), FOLDER)
    assert {r["doc_id"] for r in sequences.collect()} == {1, 2, 3, 4, 5}
