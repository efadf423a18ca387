"""Query of operator 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import permutation
from quarry.llm.frames import read


def op9_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return permutation.neighbours(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


QUERIES = {"op9_permutation_index": op9_permutation_index}
