"""Query of operator 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import orderhash as oh
from quarry.llm.frames import read


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = oh.fingerprints(read(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.withColumn("edited", edited)
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "entries", "next_entries",
                       oh.order_minhash(F.col("edited")).alias("edited_entries"))
    return rows.select("doc_id", "n_chars", "edited_sha256", oh.as_string(F.col("entries")).alias("fingerprint"),
                       oh.as_string(F.col("edited_entries")).alias("edited_fingerprint"),
                       oh.likeness(F.col("entries"), F.col("edited_entries")).alias("near_edited"),
                       oh.likeness(F.col("entries"), F.col("next_entries")).alias("near_next"))


QUERIES = {"op7_order_minhash": op7_order_minhash}
