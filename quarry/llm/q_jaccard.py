"""Query of operator 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import jaccard
from quarry.llm.frames import read


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_classes(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", "n_texts")


QUERIES = {"op1_jaccard_join": op1_jaccard_join}
