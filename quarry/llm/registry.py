"""Queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import q_classifier, q_fingerprint, q_hardneg, q_jaccard, q_merkle, q_mixing, q_neighbours, q_sharding, q_tokens, q_urls, q_warc
from quarry.llm.frames import prepare


def _prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


_ALL = {**q_jaccard.QUERIES, **q_tokens.QUERIES, **q_mixing.QUERIES, **q_sharding.QUERIES, **q_urls.QUERIES, **q_classifier.QUERIES, **q_neighbours.QUERIES, **q_fingerprint.QUERIES, **q_merkle.QUERIES, **q_hardneg.QUERIES, **q_warc.QUERIES}
QUERIES = {name: _prepared(q) for name, q in _ALL.items()}
ORACLE = {**q_urls.ORACLE, **q_merkle.ORACLE, **q_hardneg.ORACLE, **q_warc.ORACLE}
