"""Derived inputs shared by the registered queries (stand-ins of SURVEY 7.5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.lexicon import lexicon_from_pairs
from quarry.plans import fixtures as FX
from quarry.sources.tables import Tables, dealt_by_key


def year_of(doc_id) -> F.Column:
    """Stand-in year of a document: 1900 + doc_id % 100."""
    return (F.lit(1900) + (F.col(doc_id) % 100)).cast("int")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    d = Tables(spark, sf).documents
    return d.withColumn("year", year_of("doc_id"))


def doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` with TXT2 tokens (lower-cased word runs)."""
    return documents(spark, sf).select("doc_id", "source", "lang", "year",
                                       T.word_tokens("text").alias("tokens"))


def dealt_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, tokens)`` as ``doc_tokens`` has them, dealt out by document: for counts by document and term."""
    return dealt_by_key(spark, sf, "documents").select("doc_id", T.word_tokens("text").alias("tokens"))


def valence(spark: SparkSession) -> DataFrame:
    return lexicon_from_pairs(spark, FX.VALENCE)


def categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FX.CATEGORIES, "term string, polarity int")


def stopwords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in FX.STOPWORDS], "term string")


def category_dictionary(spark: SparkSession) -> DataFrame:
    raw = spark.createDataFrame([(w,) for w in FX.CATEGORY_DICTIONARY], "raw string")
    return raw.select(T.strip_dictionary_suffix("raw").alias("term")).distinct()
