import pytest
from pyspark.sql import functions as F

ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again", "en", "a"),
    (2, "", "en", None),
    (3, None, None, "b"),
    (4, "the quick brown fox jumps over the lazy dog again", "en", "a"),
    (4, "the quick brown fox jumps over the lazy dog again", "en", "a"),
    (5, "word", "de", "b"),
    (6, "ünïcödé 日本語 \x00   𐍈 end", "fr", "c"),
    (7, "long tail of words " * 3000, "en", "a"),
    (None, "row without an id of its own", "en", "a"),
    (8, " \n\t ", "es", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and extra columns with the names of results."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    for name in ("score", "predicted", "features", "n_words", "failed", "kept", "tokens", "probability", "ids", "decoded", "media", "audio", "size", "shard", "slot", "template", "start", "n_tokens", "component_id", "signature", "id", "bucket"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def corpus(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
