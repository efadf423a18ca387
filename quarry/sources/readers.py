"""Readers with explicit schemas (SRC1-SRC6, SRC12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T

SPEECH_JSON_SCHEMA = "array<string>"
LEXICON_SCHEMA = "term string, valence int"
RESULTS_SCHEMA = "analysis_num int, max_singular_values int, AA double, AB double, BB double"


def parse_json_speech(value) -> list:
    """SRC1: a positional JSON array ``[year, author, text]`` -> three named columns."""
    arr = F.from_json(F.col(value) if isinstance(value, str) else value, SPEECH_JSON_SCHEMA)
    return [F.get(arr, 0).try_cast("int").alias("year"), F.get(arr, 1).alias("author"),
            F.get(arr, 2).alias("text")]


def read_json_speeches(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: one speech per file, each file a JSON array (whole-file records)."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.input_file_name().alias("path"), *parse_json_speech("value"))


def read_speech_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC1 for many speeches: JSON arrays, one a line, in files of any size that split between tasks."""
    return spark.read.text(path).select(*parse_json_speech("value"))


def read_corpus_text(spark: SparkSession, path: str, delimiter: str = "**********_") -> DataFrame:
    """SRC2: a large delimited corpus, split at read time.

    ``lineSep`` makes each record one speech, so the split is done by the
    (splittable) text source on every executor; the empty record before the
    first delimiter is dropped, the last speech is kept (q3, q4).
    """
    raw = spark.read.option("lineSep", delimiter).text(path)
    return raw.where(F.length(F.trim(F.col("value"))) > 0).withColumnRenamed("value", "record")


def stopwords_from_df(words: DataFrame, min_len_exclusive: int = 2, stem: bool = False) -> DataFrame:
    """SRC3: keep words longer than ``n``; optionally stem; distinct."""
    out = words.select(F.trim(F.col(words.columns[0])).alias("term")).where(F.length("term") > min_len_exclusive)
    if stem:
        from quarry.functions.stemmer import stem_terms

        out = stem_terms(out, "term", "term")
    return out.distinct()


def read_stopwords(spark: SparkSession, path: str, min_len_exclusive: int = 2, stem: bool = False) -> DataFrame:
    """SRC3 from a file with one word per line."""
    return stopwords_from_df(spark.read.text(path), min_len_exclusive, stem)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: tab-separated ``term<TAB>score``, no header, no quoting; last line wins (q18).

    Line order is (file path, position in the file): a folder of lexicon
    files reads as their concatenation in path order. Within one file split
    ``monotonically_increasing_id`` follows the line order (a lexicon file
    is far below one split).
    """
    raw = (spark.read.option("sep", "\t").option("quote", "").option("header", "false")
           .option("encoding", "UTF-8").option("recursiveFileLookup", "true").schema(LEXICON_SCHEMA).csv(path))
    raw = raw.withColumn("line_no", F.struct(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")))
    return raw.groupBy("term").agg(F.max_by("valence", "line_no").alias("valence"))


def read_category_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: ';'-separated with a header; first column, suffix stripped, lower, distinct."""
    raw = spark.read.option("sep", ";").option("header", "true").csv(path)
    first = raw.columns[0]
    return (raw.select(T.strip_dictionary_suffix(first).alias("term"))
            .where(F.col("term") != "").distinct())


def read_results_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: the similarity result CSV with its fixed schema."""
    return spark.read.option("header", "true").schema(RESULTS_SCHEMA).csv(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """SRC12: a stored long matrix (parquet)."""
    return spark.read.parquet(path)


def read_topic_model(path: str):
    """SRC12: a stored topic model."""
    from pyspark.ml.clustering import LocalLDAModel

    return LocalLDAModel.load(path)
