"""Access to the parquet tables the engine runs on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Tables whose rows carry long text, with their key: per-row work (regex
# tokenizing, HTML parsing) dominates, so a scan must not run on fewer tasks
# than cores.
# A conversation may be long: its lines are dealt out without a key, so that it is not one task.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id", "conversations": None, "benchmark": "item_id"}


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_small_scan(df, TEXT_TABLES[name]) if spread and name in TEXT_TABLES else df


def row_count(spark: SparkSession, sf_dir: str, name: str, alias: str = "n_docs") -> DataFrame:
    """One-row DataFrame with the table's row count (no spreading shuffle)."""
    from pyspark.sql import functions as F

    return table(spark, sf_dir, name, spread=False).agg(F.count(F.lit(1)).alias(alias))


# A scan is spread only when it has at most this many splits: each split is
# at most ``spark.sql.files.maxPartitionBytes``, so the extra shuffle moves a
# few GB at most; bigger tables keep their scan parallelism as it is.
SPREAD_MAX_SPLITS = 32


def spread_small_scan(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread a small scan that yields fewer splits than the cluster has cores.

    Hash-partitioned by the table key (where it has one here), so that later per-document
    aggregations (``groupBy(doc_id, ...)``, windows by document) find their
    distribution already satisfied and skip an exchange.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    if n < cores and n <= SPREAD_MAX_SPLITS:
        return df.repartition(cores, key) if key else df.repartition(cores)
    return df


# Parts per split of a table dealt out by key, so that what a task counts by
# document and term fits its memory; a table of more splits is left as it is.
DEALT_PARTS = 8
DEALT_MAX_SPLITS = 4_000


def dealt_by_key(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The text table hash-partitioned by its key, whatever its size.

    The texts move before they are cut up: what is then aggregated by document
    (and term) needs no exchange, and the cells, far more than the texts, stay.
    """
    df = table(spark, sf_dir, name, spread=False)
    splits = df.rdd.getNumPartitions()
    if splits > DEALT_MAX_SPLITS:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, DEALT_PARTS * splits), TEXT_TABLES[name])


class Tables:
    """Attribute access to the tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
