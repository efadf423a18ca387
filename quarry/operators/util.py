"""Shared plan helpers: size-checked broadcast, global index, lineage cuts."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A side is broadcast only when it has at most this many rows; the check is
# a bounded action (``limit(n + 1).count()``), never a full count.
DEFAULT_BROADCAST_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    Beyond the bound the DataFrame is returned as is and the join shuffles
    (AQE may still pick a broadcast at runtime from real sizes).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def one_row(df: DataFrame) -> DataFrame:
    """Mark a global aggregate (exactly one row) for broadcast; bounded by construction."""
    return F.broadcast(df)


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` as a parquet table under the cluster's ``spark.checkpoint.dir``.

    A written table in the shared folder: survives executor loss (unlike a
    local checkpoint), cuts lineage, and is columnar and compressed, which
    makes it cheaper to write and to re-read (with column pruning) than an
    RDD checkpoint of serialized rows. ``eager=False`` falls back to Spark's
    lazy reliable checkpoint.
    """
    from quarry.session import ensure_checkpoint_dir, scratch_path

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not eager:
        return df.checkpoint(eager=False)
    path = scratch_path(spark, "ckpt")
    df.write.mode("error").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # a known schema needs no job to find it
    out._checkpoint_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Remove the table that :func:`checkpoint` wrote for ``df``, once nothing reads it any more (an iteration's last state)."""
    path = getattr(df, "_checkpoint_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_removed(spark):
    """Inside, a query's shuffle files go when it ends, not when the driver happens to collect its garbage.

    For iterations, whose every query is planned once and writes its result.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def with_global_index(df: DataFrame, order_cols: list[str], index_col: str = "idx") -> DataFrame:
    """Dense 0-based position of each row in ``order_cols`` order.

    Avoids ``row_number().over(Window.orderBy(...))``, which pulls every row
    into one task: rows are range-partitioned and sorted per partition, the
    result is checkpointed so partition ids stay fixed, per-partition counts
    (one row per partition) give the offsets.
    """
    ranged = (df.repartitionByRange(*order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = checkpoint(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    # one row per partition: a single-task window here is bounded by the partition count
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = ranged.join(F.broadcast(offsets.select("_pid", "_off", "_first")), "_pid")
    out = out.withColumn(index_col, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long"))
    return out.drop("_pid", "_mid", "_off", "_first")


def explode_nonempty(df: DataFrame, keep: list, arr, alias: str, pos_alias: str | None = None) -> DataFrame:
    """``explode`` / ``posexplode`` that keeps the array expression above any exchange.

    A plain ``explode`` makes the optimizer infer ``size(arr) > 0`` and push
    that predicate down to the scan, which evaluates the (costly) array
    expression twice and before a repartition that spreads the work. The
    outer generator infers nothing; its NULL row for empty input is dropped
    right after.
    """
    a = F.col(arr) if isinstance(arr, str) else arr
    if pos_alias:
        out = df.select(*keep, F.posexplode_outer(a).alias(pos_alias, alias))
        return out.where(F.col(pos_alias).isNotNull())
    out = df.select(*keep, F.explode_outer(a).alias(alias))
    return out.where(F.col(alias).isNotNull())


# Keys occurring at least total / MAX_HOT_KEYS times on the big side of a
# join are "hot": there are at most MAX_HOT_KEYS of them (their counts sum to
# at most the total), so their rows of the small side can always be broadcast.
MAX_HOT_KEYS = 100_000


def split_hot_join(big: DataFrame, small: DataFrame, key: str, key_counts: DataFrame, total: int,
                   how: str = "inner", max_hot: int = MAX_HOT_KEYS) -> DataFrame:
    """Equi-join that splits hot keys off into a broadcast join.

    ``key_counts`` is ``(key, n)``: how often each key occurs in ``big``
    (``total`` rows in all); ``small`` has one row per key. Rows of ``big``
    with a hot key (n >= total / max_hot) join a broadcast of the matching
    ``small`` rows, at most ``max_hot`` by construction, on the map side; the
    remaining rows shuffle-join ``small``, where no key holds more than
    total / max_hot rows, so no task receives a hot group. Exact: every row
    of ``big`` goes to exactly one of the two joins. ``key_counts`` and
    ``small`` are read more than once: written tables, unless they are small.
    """
    threshold = max(1, -(-total // max_hot))  # ceil: at most max_hot keys reach it
    hot_keys = key_counts.where(F.col("n") >= threshold).select(key)
    hot_small = small.join(F.broadcast(hot_keys), key, "left_semi")
    # an inner join with the hot rows keeps the hot keys alone
    big_hot = big if how == "inner" else big.join(F.broadcast(hot_keys), key, "left_semi")
    big_cold = big.join(F.broadcast(hot_keys), key, "left_anti")
    a = big_hot.join(F.broadcast(hot_small), key, how)
    b = big_cold.join(small, key, how)
    return a.unionByName(b)
