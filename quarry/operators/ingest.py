"""Incremental ingestion and record state as batch DataFrame jobs (ING*, SNK7-9, JON4-5, JON11).

State lives in tables (parquet folders or DataFrames); every step is a join
or an aggregation over them, never a per-row lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.util import bounded_broadcast


def new_keys_only(candidates: DataFrame, known: DataFrame, key: str, known_key: str | None = None) -> DataFrame:
    """JON4 / SET4: candidate rows whose key is not known yet (left anti join)."""
    k = known.select(F.col(known_key or key).alias(key)).distinct()
    return candidates.join(k, key, "left_anti")


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """SNK7 / JON5: the table after inserting rows of ``new`` whose key is absent."""
    return existing.unionByName(new_keys_only(new, existing, key))


def upsert_by_key(base: DataFrame, updates: DataFrame, key: str, cols: list[str], order_col: str | None = None) -> DataFrame:
    """SNK8 / JON11: update ``cols`` of ``base`` from ``updates`` by key.

    Left join + ``coalesce(update, base)``: a NULL in the update keeps the
    base value. Keys only in ``updates`` are not inserted. Of several updates
    of one key the last by ``order_col`` counts (without it, the greatest row),
    so base rows are never multiplied. Write the result to a new version
    folder; never overwrite the folder being read.
    """
    order = [F.col(order_col).alias("_order")] if order_col else []
    last = F.max(F.struct(*order, *[F.col(c).alias(f"_u_{c}") for c in cols])).alias("_u")
    u = updates.groupBy(key).agg(last).select(key, *[F.col(f"_u._u_{c}").alias(f"_u_{c}") for c in cols])
    j = base.join(u, key, "left")
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(f"_u_{c}"), F.col(c)))
    return j.drop(*[f"_u_{c}" for c in cols])


def quarantine(df: DataFrame, checks: dict[str, F.Column], as_of_ts=None) -> tuple[DataFrame, DataFrame]:
    """SNK9: split rows into (good, errors).

    ``checks`` maps a reason to a boolean Column that is true for a bad row;
    the first failing reason is recorded. Failures never stop the job.
    """
    reason = None
    for name, bad in checks.items():
        reason = F.when(bad, F.lit(name)) if reason is None else reason.when(bad, F.lit(name))
    tagged = df.withColumn("_reason", reason)
    good = tagged.where(F.col("_reason").isNull()).drop("_reason")
    ts = F.lit(as_of_ts).cast("timestamp") if as_of_ts else F.current_timestamp()
    errors = tagged.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason").withColumn("logged_at", ts)
    return good, errors


def dedupe_first(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """Keep, per key, the row with the smallest ``order_col`` (ties: smallest full row).

    Written as ``min(struct(order, row))`` per key: partial aggregation
    before the shuffle, so a key repeated a million times costs one row per
    map task, and the result is deterministic (unlike ``dropDuplicates``).
    """
    others = [c for c in df.columns if c not in (key, order_col)]
    agg = df.groupBy(key).agg(F.min(F.struct(order_col, *others)).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in [order_col] + others]).select(*df.columns)


def ingest_batch(batch: DataFrame, known_keys: DataFrame, key: str, order_col: str,
                 checks: dict[str, F.Column] | None = None, as_of_ts=None) -> tuple[DataFrame, DataFrame]:
    """ING3: dedupe the batch, skip keys already stored, quarantine bad rows.

    Returns (rows to append, error rows). Re-running with the same inputs
    yields the same rows (idempotent).
    """
    fresh = new_keys_only(dedupe_first(batch, key, order_col), known_keys, key)
    if not checks:
        return fresh, fresh.limit(0)
    return quarantine(fresh, checks, as_of_ts)


def completed_partitions(records: DataFrame, key: str, ok: F.Column) -> DataFrame:
    """ING2: keys all of whose records succeeded (``bool_and`` per key)."""
    return (records.groupBy(key).agg(F.bool_and(ok).alias("completed"), F.count(F.lit(1)).alias("n_records"))
            .where("completed"))


def pending_partitions(keys: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """ING1: work list = keys without a completed ledger entry."""
    done = ledger.where(F.col("completed")).select(key)
    return keys.join(done, key, "left_anti")


def status_refresh(observations: DataFrame, key: str, ts: str, removed: F.Column, let_agreed: F.Column) -> DataFrame:
    """ING4: per key the first flagging observation fixes both flags and the time.

    Flags are sticky: once flagged, a record is not polled again, so later
    observations never change it. In one observation ``removed`` hides
    ``let_agreed``. ``min`` is a partial aggregate: hot keys are fine.
    """
    obs = observations.select(key, ts, removed.alias("removed"), (~removed & let_agreed).alias("let_agreed"))
    flagged = obs.where(F.col("removed") | F.col("let_agreed"))
    # the whole struct in order: of two observations at one time ``removed`` comes first, on every run
    first = flagged.groupBy(key).agg(F.min(F.struct(F.col(ts), (~F.col("removed")).alias("_kept"), "removed", "let_agreed")).alias("_f"))
    return first.select(key, F.col("_f.removed").alias("removed"), F.col("_f.let_agreed").alias("let_agreed"),
                        F.col(f"_f.{ts}").alias("flagged_ts"))


def enrich_missing(base: DataFrame, values: DataFrame, key: str, col: str) -> DataFrame:
    """ING5: fill ``col`` only where it is NULL, from ``values(key, col)`` (the greatest of several values of a key)."""
    v = values.groupBy(key).agg(F.max(col).alias("_v"))
    out = base.join(v, key, "left")
    return out.withColumn(col, F.coalesce(F.col(col), F.col("_v"))).drop("_v")


def select_keys(df: DataFrame, key: str, arg: str) -> DataFrame:
    """ING7: rows whose key is in a blank-separated list (blanks ignored)."""
    spark = df.sparkSession
    keys = spark.range(1).select(F.explode(F.filter(F.split(F.lit(arg), " "), lambda x: x != "")).alias("_k"))
    keys = keys.select(F.col("_k").try_cast(df.schema[key].dataType).alias(key)).where(F.col(key).isNotNull())
    return df.join(bounded_broadcast(keys.distinct()), key, "left_semi")


def first_seen(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """TOP7: for each key the smallest ``order_cols`` tuple where it was seen.

    ``min(struct(...))`` per key (partial aggregation), not a window: a key
    seen on a third of all pages still costs one row per map task.
    """
    agg = df.groupBy(key).agg(F.min(F.struct(*order_cols)).alias("_f"))
    return agg.select(key, *[F.col(f"_f.{c}").alias(c) for c in order_cols])
