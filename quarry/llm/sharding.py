"""Sharding by jump consistent hashing.

The shard of a row is a function of its key and the number of shards alone
(law ``key``): no ring table, no state, and one more shard takes rows only
into itself. A row also gets its slot, its gapless place within the shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from quarry.llm.frames import col, without
from quarry.operators.util import checkpoint

# multiplier of the published jump hash's random sequence
STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Bucket of each 64-bit key among ``shards``: jump ahead while the next jump stays inside."""
    key = keys.astype(np.int64).view(np.uint64).copy()
    bucket = np.zeros(len(key), np.int64)
    ahead = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        bucket[live] = ahead[live]
        with np.errstate(over="ignore"):
            key[live] = key[live] * STEP + np.uint64(1)
        draw = ((key[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[live] = np.floor((bucket[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        live = live[ahead[live] < shards]
    return bucket.astype(np.int32)


def jump_shard(key, shards: int):
    """Column of shard numbers for a column of 64-bit hashes."""

    @F.pandas_udf(IntegerType())
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards))

    return of(key)


def assign_shards(df: DataFrame, key: tuple[str, ...] = ("doc_id",), shards: int = 24) -> DataFrame:
    """``df`` with ``shard`` (of ``shards``), ``grown_shard`` (of one more) and ``law``.

    Keys of equal value share a shard, null keys too (they hash as a value of
    their own). Lazy and row-local: no shuffle. Input columns named like the
    output are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    df = without(df, *({"shard", "grown_shard", "law", "_h"} - set(key)))
    h = df.withColumn("_h", F.xxhash64(*[col(k) for k in key]))
    return (h.withColumn("shard", jump_shard(F.col("_h"), shards))
            .withColumn("grown_shard", jump_shard(F.col("_h"), shards + 1))
            .withColumn("law", F.lit("key")).drop("_h"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """The rows as one folder of Parquet files per shard."""
    assigned.write.mode("error").partitionBy("shard").parquet(path)


def with_slots(assigned: DataFrame) -> DataFrame:
    """``assigned`` with ``slot``: 0, 1, 2 ... within each shard.

    The rows are written once with the number of the task that wrote them;
    a slot is the rows that earlier tasks put into the shard plus the place
    among the task's own. No window spans more than one task's rows of one
    shard, and repeated rows, even of one single key, get slots of their own.
    The counts are a row per task and shard.
    """
    fixed = checkpoint(without(assigned, "slot", "_task", "_row").withColumn("_task", F.spark_partition_id())
                       .withColumn("_row", F.monotonically_increasing_id()))
    counts = fixed.groupBy("shard", "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("shard", "_task").orderBy("_row"))
    numbered = fixed.withColumn("_place", place).join(starts, ["shard", "_task"])
    return numbered.withColumn("slot", (F.col("_start") + F.col("_place") - 1).cast("long")).drop("_task", "_row", "_place", "_start")
