"""A training-data pipeline over ``documents``: quality, near-duplicates, mixing, BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``; the last
returns a row for each row of the mix with its ids' and decoded text's digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, classifier, jaccard, mixing
from quarry.llm.frames import col, prepare, read
from quarry.llm.q_tokens import tokenizer_path
from quarry.operators.util import checkpoint
from quarry.session import ensure_checkpoint_dir, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones that are not held out, does not reject."""
    return classifier.accept(docs, classifier.train(docs, read(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-gram Jaccard similarities of 0.8 or more connect it."""
    return jaccard.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the targets of their sources ask for: none, one or two rows each."""
    # the row travels whole, so that no column of it can clash with one of the mix's
    rows = docs.select("doc_id", "source", mixing.word_count("text").alias("size"), F.struct(*[col(c) for c in docs.columns]).alias("row"))
    return mixing.emit(mixing.mix(rows)).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's BPE ids and their decoding, as digests."""
    encoded = bpe.encode_decode(docs, tokenizer_path())
    return encoded.select("doc_id", "source", *bpe.digests(encoded))


def _ready(fn):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        prepare(spark)
        return fn(spark, docs, sf_dir)

    return run


STAGES = [("quality classifier", _ready(quality)), ("n-gram Jaccard join", _ready(deduplicate)), ("mixing to target weights", _ready(mix)),
          ("BPE encoding and decoding", _ready(encode))]

#: No SQL: the classifier's weights and the mix's offsets have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written and read again, over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
