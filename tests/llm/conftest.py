import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def table(spark):
    """Rows as a DataFrame, dealt over a few partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


@pytest.fixture(scope="session")
def awkward(table):
    """Documents with nulls everywhere, empty and long texts, repeated rows, and columns named like outputs."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, "the quick brown fox jumps over the lazy dog again", "en", "a"), (2, "", "en", "a"), (3, None, None, None),
            (4, " \n\t ", "de", "b"), (5, long, "de", "b"), (6, long + " tail", "de", "b"), (7, "x" * 20_000, "fr", None),
            (None, "the quick brown fox jumps over the lazy dog again", "en", "a"), (8, "one", "en", "c"), (8, "one", "en", "c"),
            (9, "it's <|endoftext|>odd\x1cthing été naïve ΑΣ 日本語 12", "en", "c")]
    df = table(rows, "doc_id long, text string, lang string, source string")
    for name in ("shard", "slot", "ids", "decoded", "score", "copies", "target", "size", "host", "rule", "rank", "key", "n", "sig"):
        df = df.withColumn(name, F.lit(name))
    return df


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
