"""Content-addressed WARC archive: payloads once by digest, exact headers apart, records by joins.

`write_archive` writes two Parquet tables: `payloads` has every distinct payload under its SHA-256,
and `records` has one row per page with the exact header block. A payload found under its digest is
checked against it on reading, so that a broken store cannot give wrong bytes. Everything is built
from column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BREAK = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, as WARC headers carry it; 160 bits need no padding."""
    digits = F.sha1(payload)
    letters = []
    for group in range(8):
        twenty_bits = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(twenty_bits, shift).bitwiseAND(31) + 1
            letters.append(F.lit(_BASE32).substr(place, F.lit(1)))
    return F.concat(*letters)


def record_uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """One header line, or nothing for NULL; line breaks inside a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(BREAK)), F.lit(""))


def _headers() -> Column:
    digest = F.concat(F.lit("sha1:"), "payload_digest")
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", record_uri(F.col("page_id"))),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Refers-To", F.when(F.col("record_type") == "revisit", record_uri(F.col("refers_to")))),
        _header("WARC-Payload-Digest", digest),
        _header("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit(BREAK),
    )


def payload_of(pages: DataFrame) -> DataFrame:
    """page_id, url and the UTF-8 bytes of html; NULL html is the empty payload."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), payload.alias("payload"))


def plan_records(pages: DataFrame, revisit_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Records without payloads, and the distinct payloads.

    Of equal payloads of at least `revisit_bytes` bytes, the row with the largest page_id is the
    response and the others revisit it; rows that repeat that page_id are responses too. Smaller
    payloads are all responses, stored once as well. A NULL page_id is smaller than any other.
    """
    source = payload_of(pages)
    keys = source.select(
        "page_id", "url",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.sha2("payload", 256).alias("digest"),
    )
    newest = keys.groupBy("digest").agg(F.max("page_id").alias("newest"))
    first = (F.col("payload_bytes") < revisit_bytes) | F.col("page_id").eqNullSafe(F.col("newest"))
    records = keys.join(newest, "digest").select(
        "page_id", "url", "payload_bytes", "payload_digest", "digest",
        F.when(first, "response").otherwise("revisit").alias("record_type"),
        F.when(~first, F.col("newest")).alias("refers_to"),
    ).select("*", _headers().alias("headers"))
    # The bytes meet their keys by page, never by digest: page numbers are even, digests are not.
    holders = newest.select("newest", F.col("digest").alias("held"))
    bytes_of = source.select("page_id", "payload", F.sha2("payload", 256).alias("digest"))
    payloads = bytes_of.join(
        holders, F.col("page_id").eqNullSafe(F.col("newest")) & (F.col("digest") == F.col("held")), "left_semi",
    ).select("digest", "payload")
    return records, payloads


def write_archive(pages: DataFrame, path: str, revisit_bytes: int = 0) -> None:
    records, payloads = plan_records(pages, revisit_bytes)
    payloads.write.mode("overwrite").parquet(f"{path}/payloads")
    records.select("page_id", "digest", "headers").write.mode("overwrite").parquet(f"{path}/records")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """digest and payload, each checked against its digest. Rows of one digest are equal bytes."""
    stored = spark.read.parquet(f"{path}/payloads")
    broken = F.raise_error(F.concat(F.lit("payload does not fit its digest "), "digest"))
    return stored.withColumn(
        "payload", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(broken.cast("binary")))


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """page_id and the exact bytes of every record, its full payload included."""
    payloads = read_payloads(spark, path).dropDuplicates(["digest"])
    records = spark.read.parquet(f"{path}/records")
    ending = F.encode(F.lit(BREAK * 2), "UTF-8")
    return records.join(payloads, "digest").select(
        "page_id", F.concat(F.encode("headers", "UTF-8"), "payload", ending).alias("record"))


def _value(name: str) -> Column:
    """Value of the first header line of a name; only CR LF ends a line, as `_header` escapes both."""
    return F.regexp_extract("headers", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """What the archive says of every record, with size and digest taken from the stored payload.

    page_id, payload_bytes, payload_digest, record_type, refers_to, url. Payload bytes are read and
    checked once per payload and stay where they are: only their sizes and digests are joined.
    """
    facts = read_payloads(spark, path).groupBy("digest").agg(
        F.max(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.max(base32_sha1(F.col("payload"))).alias("payload_digest"))
    records = spark.read.parquet(f"{path}/records")
    page = F.regexp_extract(_value("WARC-Refers-To"), r"^<urn:page:(-?\d+)>$", 1)
    joined = records.join(facts, "digest")
    broken = F.raise_error(F.concat(F.lit("header and payload differ at "), "digest")).cast("string")
    fits = F.concat(F.lit("sha1:"), "payload_digest") == _value("WARC-Payload-Digest")
    url = _value("WARC-Target-URI")
    return joined.select(
        "page_id", "payload_bytes",
        F.when(fits, F.col("payload_digest")).otherwise(broken).alias("payload_digest"),
        _value("WARC-Type").alias("record_type"),
        F.when(page != "", page).cast("long").alias("refers_to"),
        F.when(F.contains("headers", F.lit("WARC-Target-URI: ")), url).alias("url"),
    )
