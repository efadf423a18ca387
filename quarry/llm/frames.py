"""Small DataFrame helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of an Arrow batch at most: a row here is a whole text.
BATCH_ROWS = 2_000


def prepare(spark: SparkSession) -> None:
    """Sets the session up for operators that hand whole texts to Python in batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, str(min(BATCH_ROWS, int(spark.conf.get(name)))))


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less every column that the caller is about to add (names compare without case, as Spark's do)."""
    taken = {n.lower() for n in names}
    return df.select(*[col(c) for c in df.columns if c.lower() not in taken])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the scan's splits are left as they are."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(df: DataFrame) -> Column:
    """A hash of the whole row: ties between rows that agree in all other sort keys are only ties of equal rows."""
    plain = [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*[col(c) for c in plain]) if plain else F.lit(0).cast("long")
