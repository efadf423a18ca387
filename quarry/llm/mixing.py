"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

A source whose documents are to be taken ``r`` times on average gives every
document the expected count ``r``. With the documents of a source in a fixed
order, the running sum of expected counts before and after document ``i`` is
``i r`` and ``(i + 1) r``; one random offset ``u`` in [0, 1) per source shifts
that line, and the document goes out once per whole number in
``(u + i r, u + (i + 1) r]``: ``floor(r)`` or ``ceil(r)`` times, and the source
as a whole ``n r`` times to within one.

The order is by size, so neighbours on the line have nearly equal sizes and
the words taken follow the target as closely as the number of documents does.
Positions come from a range partitioning (``with_global_index``): a source
with a third of all rows is spread over many tasks like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.frames import col, row_key, without
from quarry.operators.util import bounded_broadcast, checkpoint, with_global_index

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SEED = 20240901


def word_count(text):
    """Number of runs free of ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(docs: DataFrame, source: str = "source", size: str = "size", share: float = 1.5,
                   most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``(source, source_size, target)``: how much each source is to give.

    Sources in code point order, null last, weigh ``weights`` over and over,
    and share ``share`` times all sizes. No source gives more than ``most``
    times its own size: what it would have had beyond is shared again by
    weight among the others, until none is above. Each pass is one aggregate
    over the table of sources (the driver holds two numbers); every pass but
    the last stops at least one more source. An empty table gives no rows; a
    source of size 0 has target 0.
    """
    sums = docs.groupBy(col(source).alias("source")).agg(F.sum(col(size)).cast("long").alias("source_size"))
    ranked = with_global_index(sums.withColumn("_none", F.col("source").isNull()), ["_none", "source"], "_at")
    by_place = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int"))
    table = checkpoint(ranked.select("source", "source_size", by_place.alias("_w"), (F.col("source_size") * most).alias("_cap")))
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped = 0.0, -1
    while True:
        full = F.col("_w") * level >= F.col("_cap")
        n, kept, free = table.agg(F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)),
                                  F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0.0))).first()
        if n == stopped or free <= 0:
            break
        stopped, level = n, (total - kept) / free
    target = F.when(F.col("_w") * level >= F.col("_cap"), F.col("_cap")).otherwise(F.col("_w") * level)
    return table.select("source", "source_size", target.alias("target"))


def systematic_copies(docs: DataFrame, targets: DataFrame, source: str = "source", size: str = "size",
                      order: tuple[str, ...] = ("doc_id",), seed: int = SEED) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies``: how many times the mix takes each row.

    Every row of ``docs`` comes back once. Order on the line: size, then
    ``order``, then a hash of the row, so reruns agree and rows that tie are
    equal rows. Null sources form one source; null sizes and ids sort first.
    Input columns named like the output are replaced. One shuffle and one
    written copy of the columns given.
    """
    docs = without(docs, *({"source_size", "target", "copies", "_src", "_key", "_at", "_first"} - {source, size, *order}))
    keyed = docs.withColumn("_src", col(source)).withColumn("_key", row_key(docs))
    placed = with_global_index(keyed, ["_src", size, *order, "_key"], "_at")
    firsts = placed.groupBy("_src").agg(F.min("_at").alias("_first"))
    plan = (firsts.join(targets.withColumnRenamed("source", "_t"), F.col("_src").eqNullSafe(F.col("_t")))
            .select(F.col("_src").alias("_s"), "_first", "source_size", "target"))
    joined = placed.join(bounded_broadcast(plan), F.col("_src").eqNullSafe(F.col("_s")))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col("_src")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    at = (F.col("_at") - F.col("_first")).cast("double")
    copies = F.floor(offset + (at + 1) * rate) - F.floor(offset + at * rate)
    # rounding of a long running sum must not add a copy beyond the next whole number
    copies = F.least(copies, F.ceil(rate)).cast("long")
    return joined.withColumn("copies", copies).drop("_src", "_key", "_at", "_first", "_s")


def mix(docs: DataFrame, size: str = "size", source: str = "source", **targets_of) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies`` for the standard targets."""
    return systematic_copies(docs, source_targets(docs, source, size, **targets_of), source, size)


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as ``copies`` says."""
    out = mixed.where(F.col("copies") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.drop("_copy", "copies", "source_size", "target")
