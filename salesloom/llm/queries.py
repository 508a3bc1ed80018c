"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import (
    bytebpe, collocations, decontamination, langid, packing, quality, runs, simhash, substrings, tokens, urls,
    vectors, warc,
)
from salesloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_warc_archive(spark, folder):
    path = scratch_path(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), path)
    return warc.read_index(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


@query
def op3_substring_dedup(spark, folder):
    result = substrings.remove_repeats(table(spark, folder, "documents"))
    return result.select(
        "doc_id", "result.n_words", "result.n_removed",
        F.sha2("result.kept_text", 256).alias("kept_sha256"))


@query
def op4_simhash(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def language_model(docs: DataFrame) -> langid.Model:
    """Fitted on labelled documents of the folds that are not held out."""
    learned = ~F.coalesce(fold(4) == 2, F.lit(True))
    return langid.fit(docs.where(learned), tokenizer("piece_bpe_32k.model"))


def fold(parts: int):
    """CRC-32 of doc_id as text, modulo `parts`."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


@query
def op5_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(fold(4) == 2, F.lit(True))
    return langid.identify(docs.select("doc_id", "text"), language_model(docs)).select(
        "doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


@query
def op6_quality(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(fold(3) == 1, F.lit(True))
    labels = table(spark, folder, "labels").where(~held_out)
    model = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    scored = quality.score(docs.select("doc_id", "text", "n_chars"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("quality").alias("score"),
        (F.col("quality") >= 0.5).cast("int").alias("predicted"))


@query
def op7_embedding_dedup(spark, folder):
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


#: Host and path rules of the query; they come before the pattern rules.
URL_RULES = [
    urls.host_rule("com/", "allow"),
    urls.host_rule("example.com/en/", "block"),
    urls.host_rule("www.example.com/en/", "allow"),
    urls.host_rule("net/es/", "block"),
    urls.host_rule("net/fr/", "block"),
]


@query
def op8_url_filter(spark, folder):
    return urls.filter_urls(table(spark, folder, "pages"), URL_RULES)


@query
def op9_decontamination(spark, folder):
    found = decontamination.find_contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query
def op10_token_counts(spark, folder):
    return tokens.count_tokens(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents all words from some place on repeat the first few of them."""
    words = F.filter(F.split("text", "[ \\x09-\\x0D]+"), lambda word: word != "")
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.select("doc_id", "text", hashed.alias("h"), F.when(hashed % 10 == 0, words).alias("words"))
    g, n = F.expr("h div 10"), F.size("words").cast("long")
    places = split.withColumns({"n": n, "a": F.when(n > 0, g % n)})
    places = places.withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    repeated = F.flatten(F.array_repeat(
        F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int")), F.expr("int((n - a) div p + 1)")))
    planted = F.concat(
        F.slice("words", 1, F.col("a").cast("int")), F.slice(repeated, 1, (F.col("n") - F.col("a")).cast("int")))
    return places.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, folder):
    found = runs.find_runs(planted_periods(table(spark, folder, "documents")))
    # Runs come by start, then period, so that the first of equal exponents stays.
    best = F.expr("""aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>),
        (most, one) -> if(most is null or cast(one.length as decimal(38, 0)) * most.period
                                        > cast(most.length as decimal(38, 0)) * one.period, one, most))""")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


@query
def op13_byte_bpe(spark, folder):
    import public_tokenizers

    codec = bytebpe.Codec(tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = bytebpe.encode(table(spark, folder, "documents"), codec).select("doc_id", "ids")
    return bytebpe.decode(encoded, codec).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
