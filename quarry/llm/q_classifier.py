"""Query of operator 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import classifier
from quarry.llm.frames import read


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = classifier.train(docs, read(spark, sf_dir, "labels"))
    scored = classifier.score(docs, model)
    return scored.select("doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= classifier.THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op8_quality_classifier": op8_quality_classifier}
