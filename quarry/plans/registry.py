"""Registry of named queries: Spark builder + (optional) DuckDB oracle SQL.

A query is ``f(spark, sf_dir) -> DataFrame``. The oracle, when given, is an
independent SQL formulation over the same parquet tables; column names match
the Spark result exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
INVENTORY: dict[str, str] = {}


def register(name: str, ids: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``ids`` names the SURVEY inventory rows it covers."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        INVENTORY[name] = ids
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that the registry is complete."""
    from quarry.plans import (  # noqa: F401
        q_features,
        q_html,
        q_ingest,
        q_io,
        q_matrix,
        q_models,
        q_segment,
        q_similarity,
        q_text,
    )
