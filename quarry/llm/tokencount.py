"""Token counts by a join: pieces per distinct pre-token, pre-tokens per document.

Each distinct unit of the corpus is put through the tokenizer once. The most
frequent units (at most ``HEAD``, of at most ``HEAD_LENGTH`` characters, so
their table has a fixed bound) join by broadcast where the documents are; what
is left of a document, its rare units with their frequencies, joins by
shuffle. No unit that is left is frequent, so no task gets a hot key, and ids
are never made for any document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.frames import col
from quarry.llm.pieces import SPACE, Cutter, held
from quarry.operators.util import checkpoint

#: Bound of the table that is broadcast: rows, and characters of a unit.
HEAD = 400_000
HEAD_LENGTH = 64


def units(text: Column) -> Column:
    """Runs free of white space; an empty array for null and for blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda x: x != "")


class PieceCounter:
    """Pieces of a unit, by the library's model on each of its pre-tokens."""

    def __init__(self, path: str):
        self.cut = Cutter(path)

    def __call__(self, unit: str) -> int:
        cut, model = self.cut, self.cut.tokenizer.model
        return sum(1 if u in cut.special else sum(len(model.tokenize(p)) for p in cut.pieces(u)) for u in cut.units(unit))


def piece_counter(path: str) -> PieceCounter:
    """The Python worker's counter for this file."""
    return held(("count", path), lambda: PieceCounter(path))


def piece_counts(words: DataFrame, path: str) -> DataFrame:
    """``(unit, n, pieces)`` for distinct units ``(unit, n)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = piece_counter(path)
        for b in batches:
            pieces = pa.array([count(u) for u in b.column("unit").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, pieces], names=["unit", "n", "pieces"])

    return words.mapInArrow(run, "unit string, n long, pieces long")


def frequent(table: DataFrame, most: int = HEAD) -> DataFrame:
    """The units of ``(unit, n, pieces)`` from the least frequency down to which there are at most ``most`` of them."""
    table = table.where(F.length("unit") <= HEAD_LENGTH)
    # counts by frequency, all beyond 4,096 together: at most 4,096 rows
    by = table.groupBy(F.least(F.col("n"), F.lit(4096)).alias("f")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("f")).collect()
    least, held = None, 0
    for f, k in by:
        held += k
        if held > most:
            break
        least = f
    if least is None and by:  # more than ``most`` units are that frequent: their share of all tokens is spread over them
        return table.where(F.col("n") >= 4096).orderBy(F.desc("n"), "unit").limit(most)
    return table.where(F.col("n") >= F.lit(least))


def token_counts(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row: UTF-8 bytes, and tokens without added special tokens.

    A null or empty text counts 0 and 0. Special strings in a text count one
    token each. Repeated rows, and rows that share an id, are counted each on
    its own. Other columns are left behind.
    """
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    table = checkpoint(piece_counts(rows.select(F.explode(units(F.col("text"))).alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("n")), path))
    head = frequent(table).select("unit", F.col("pieces").alias("_head"))
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    listed = numbered.select("row", "doc_id", "n_bytes", F.posexplode_outer(units(F.col("text"))).alias("at", "unit"))
    met = listed.join(F.broadcast(head), "unit", "left")
    rare = F.col("unit").isNotNull() & F.col("_head").isNull()
    # a document's frequent units meet in one row, under a key that no unit can have
    key = F.when(rare, F.col("unit")).otherwise(F.concat(F.lit(" "), F.col("row").cast("string")))
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    freq = met.groupBy("row", key.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.sum("_head").alias("known"),
                                                    F.max(F.when(first, F.struct("doc_id", "n_bytes"))).alias("doc"))
    tail = table.select(F.col("unit").alias("key"), "pieces")
    summed = freq.join(tail, "key", "left").groupBy("row").agg(
        F.max("doc").alias("doc"), F.sum(F.coalesce(F.col("n") * F.col("pieces"), F.col("known"), F.lit(0))).cast("long").alias("n_tokens"))
    return summed.select("doc.doc_id", "doc.n_bytes", "n_tokens")
