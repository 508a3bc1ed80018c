import public_tokenizers
import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang) tuples."""
    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def tokenizer_path():
    return public_tokenizers.path
