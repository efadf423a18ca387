"""Query of operator 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import sharding
from quarry.llm.frames import read


def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    slots = sharding.with_slots(sharding.assign_shards(docs, ("doc_id",), 24))
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return slots.select("doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
                        "law", "shard", "slot", "grown_shard")


QUERIES = {"op4_jump_shards": op4_jump_shards}
