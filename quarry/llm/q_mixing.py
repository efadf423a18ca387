"""Query of operator 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import mixing
from quarry.llm.frames import read
from quarry.operators.util import checkpoint


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # sizes are counted once: the range partitioning samples its input besides
    sized = checkpoint(docs.select("doc_id", "source", mixing.word_count("text").alias("size")))
    mixed = mixing.mix(sized)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "source", "copies")


QUERIES = {"op3_mix_sources": op3_mix_sources}
