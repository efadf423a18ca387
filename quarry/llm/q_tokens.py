"""Queries of operators 2, 6 and 10: the tokenizer ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, tokencount, tokenfile
from quarry.llm.frames import read
from quarry.session import scratch_path

END_ID = 2
LIMIT = 2048


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer of this name is, on the driver and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = scratch_path(spark, "tokens")
    tokenfile.write_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"), to, tokenizer_path(), END_ID)
    return tokenfile.token_digests(spark, to)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencount.token_counts(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)


def op10_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_decode(docs, tokenizer_path())
    return encoded.select("doc_id", *bpe.digests(encoded))


QUERIES = {"op2_token_files": op2_token_files, "op6_token_counts": op6_token_counts, "op10_bpe_trie": op10_bpe_trie}
