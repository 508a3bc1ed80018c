"""The corpus pipeline: documents to training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Between stages
the documents are written and read again, so that a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm import decontamination, langid, packing, simhash, substrings
from salesloom.llm.queries import language_model, table, tokenizer
from salesloom.session import scratch_path

LEAST_SCORE = 0.5  # of the predicted language


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language the model is sure of; those without letters go."""
    name = _free(docs, "language")
    found = langid.identify(docs, language_model(docs), into=name)
    sure = (F.col(f"{name}.lang_pred") != "und") & (F.col(f"{name}.score") >= LEAST_SCORE)
    return found.where(sure).select(*[found[c] for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group the document with the smallest doc_id; without any id, that with the smallest text hash.

    Rows equal in doc_id and text are one document. Rows that share a doc_id but neither text nor
    group are different documents.
    """
    doc, key, place = (_free(docs, n) for n in ("kept_doc", "kept_key", "place"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    kept = simhash.near_duplicates(docs).groupBy("group_key").agg(F.min(first).alias("first")).select(
        F.col("first.doc_id").alias(doc), F.col("first.text_key").alias(key))
    own = F.xxhash64(docs["text"])
    stays = docs.join(kept, docs["doc_id"].eqNullSafe(F.col(doc)) & (own == F.col(key)), "left_semi")
    # Ids that are NULL are dealt by text; of copies, Spark sends one row per task to the window.
    one = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("text")
    placed = stays.withColumn(place, F.row_number().over(one))
    return placed.where(F.col(place) == 1).select(*[placed[c] for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that start earlier; others keep their text as it is."""
    name = _free(docs, "result")
    found = substrings.remove_repeats(docs, into=name)
    changed = F.col(f"{name}.n_removed") > 0
    text = F.when(changed, F.col(f"{name}.kept_text")).otherwise(F.col("text"))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length(F.col(f"{name}.kept_text")).cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.select(*[columns[c].alias(c) if c in columns else found[c] for c in docs.columns])


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; the others go whole."""
    doc, key = _free(docs, "hit_doc"), _free(docs, "hit_key")
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = found.where("contaminated").select(F.col("doc_id").alias(doc), F.col("text_key").alias(key)).distinct()
    own = F.xxhash64(docs["text"])
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(doc)) & (own == F.col(key)), "left_anti")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, as the packing operator returns them."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("sequences", sequences),
]

#: SimHash needs a hash that SQL does not have; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
