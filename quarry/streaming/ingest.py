"""Ingestion as Structured Streaming (ING3, ING4).

A file source is drained with ``availableNow``; each micro-batch goes through
the batch operators in ``foreachBatch`` and is written to a folder of its own
(``batch=N``), so a replayed batch overwrites only itself and nothing that is
stored is rewritten. What has been seen is in files of keys by bucket, not in
a state store that grows without bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import ingest as I
from quarry.operators.commits import SeenKeys
from quarry.operators.util import checkpoint as checkpoint_table


def _stored(spark: SparkSession, sink: str, schema) -> DataFrame:
    """All batches under ``sink`` with their number; empty before the first."""
    from pyspark.sql.types import LongType, StructField, StructType

    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(sink)
    full = StructType([*schema.fields, StructField("batch", LongType())])
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(sink)


def ingest_stream(spark: SparkSession, source_dir: str, schema, sink: str, checkpoint: str, key: str, order_col: str,
                  known_keys: DataFrame | None = None, checks: dict | None = None, errors: str | None = None) -> tuple[DataFrame, DataFrame]:
    """ING3 + SNK9: drain every file now in ``source_dir``; returns the stored rows and the quarantined rows.

    A micro-batch is deduplicated (first by ``order_col``), rows whose key is
    in ``known_keys``, ``sink`` or ``errors`` are skipped, rows that fail a check
    go to ``errors`` with the reason. What ``sink`` and ``errors`` hold is known
    from files of their keys by bucket (``SeenKeys``, beside ``sink``), of which
    a batch reads only its own keys' buckets. Run it again after new files
    arrive.
    """
    from pyspark.sql.types import StringType, StructField, StructType, TimestampType

    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    errors = errors or f"{sink.rstrip('/')}-errors"
    error_schema = StructType([*schema.fields, StructField("reason", StringType()), StructField("logged_at", TimestampType())])

    def write_batch(batch: DataFrame, number: int) -> None:
        batch = checkpoint_table(batch)
        keys = SeenKeys(batch.sparkSession, f"{sink.rstrip('/')}-seen", key, schema[key].dataType.simpleString())
        known = keys.among(batch, number)
        if known_keys is not None:
            known = known.unionByName(known_keys.select(key))
        good, bad = I.ingest_batch(batch, known, key, order_col, checks or {"": F.lit(False)})
        good.write.mode("overwrite").parquet(f"{sink}/batch={number}")
        bad.write.mode("overwrite").parquet(f"{errors}/batch={number}")
        stored = [batch.sparkSession.read.schema(schema).parquet(f"{p}/batch={number}").select(key) for p in (sink, errors)]
        keys.add(stored[0].unionByName(stored[1]), number)

    q = (spark.readStream.schema(schema).parquet(source_dir).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return _stored(spark, sink, schema).drop("batch"), _stored(spark, errors, error_schema).drop("batch")


def status_refresh_stream(spark: SparkSession, source_dir: str, schema, sink: str, checkpoint: str, key: str,
                          ts: str, removed_expr: str, let_expr: str) -> DataFrame:
    """ING4: the first flagging observation of each key, as files arrive.

    A micro-batch writes its own first observations; the current state is the
    first of those over all batches (one row a key and batch is read, nothing
    stored is rewritten). Returns the current state.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        found = I.status_refresh(batch, key, ts, F.expr(removed_expr), F.expr(let_expr))
        found.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    q = (spark.readStream.schema(schema).parquet(source_dir).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    parts = spark.read.parquet(sink)
    return I.status_refresh(parts, key, "flagged_ts", F.col("removed"), F.col("let_agreed"))
