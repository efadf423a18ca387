"""Nearest neighbours by a permutation index.

A vector is represented by the order in which it sees a fixed set of pivots,
nearest first. The index is an inverted file: for each pivot and block of
vectors the vectors that post it, in the order of the rank it has for them.
A query goes through its own pivots' lists and sums, vector by vector, the
difference of ranks (Spearman's footrule; a pivot that is not posted counts as
ranked behind all posted ones). The vectors with the smallest footrule are
reranked by their exact cosine.

Vectors of equal components form one class, which is indexed and asked for
once, so a vector with a third of all rows is one entry. Blocks of the index
meet blocks of queries; nothing is emitted per pair but the few best of each
block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.frames import col
from quarry.operators.util import checkpoint

#: Pivots, all of them posted; taken farthest-first from a bounded sample, the vectors with the smallest hash of their id.
PIVOTS, SAMPLE = 128, 4096
#: Vectors in a block of the index, queries in a block of queries.
BLOCK, QUERY_BLOCK = 2048, 2048
#: Candidates that a query reranks: this many times the square root of the number of vectors.
RERANK = 8.0


def usable(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``(vec_id, v)`` of vectors without null or non-finite components that are not zero; rows without an id are left out."""
    v = col(embedding)
    clean = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.select(col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(clean, F.lit(False)))


def classes(rows: DataFrame, least: int) -> DataFrame:
    """``(vec, v, ids)``: a row for each distinct vector, named by its smallest id, with its ``least`` smallest ids.

    The limit is taken before the shuffle, so a class of any size sends a few rows a task.
    """
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("_r", first).where(F.col("_r") <= least)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("vec"), "v", "ids")


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64)


def farthest_first(x: np.ndarray, most: int) -> np.ndarray:
    """``most`` rows of ``x``, scaled to length 1: the first, then always the one whose nearest taken one is farthest by cosine.

    A group of near copies gives one pivot until all else is as near to one;
    rows in the direction of a taken one are left out.
    """
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    taken = [0] if len(x) else []
    nearest = np.full(len(x), -np.inf)
    while taken and len(taken) < min(most, len(x)):
        nearest = np.maximum(nearest, x @ x[taken[-1]])
        k = int(np.argmin(nearest))
        if nearest[k] > 1 - 1e-12:
            break
        taken.append(k)
    return x[taken]


def permutations(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Rank of each pivot for each vector, the nearest (by cosine) first; ties to the earlier pivot."""
    near = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ pivots.T
    order = np.argsort(-near, axis=1, kind="stable")
    ranks = np.empty(order.shape, np.int16)
    np.put_along_axis(ranks, order, np.arange(len(pivots), dtype=np.int16)[None, :], 1)
    return ranks


INDEX = "block int, pivot int, members binary, posted binary"


def build_index(table: DataFrame, pivots: np.ndarray, blocks: int, posted: int, kind: str = "<f4") -> DataFrame:
    """The inverted file of ``(vec, v)``: a row for each block and pivot, its members and their ranks for it in the
    order of rank; under pivot -1 the block's ids and vectors, as numbers of ``kind``."""

    def build(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("vec")
        x = matrix(batch["v"])
        ranks = permutations(x, pivots)
        rows = [(-1, batch["vec"].to_numpy("<i8").tobytes(), x.astype(kind).tobytes())]
        for p in range(len(pivots)):
            of = np.flatnonzero(ranks[:, p] < posted)
            of = of[np.argsort(ranks[of, p], kind="stable")]
            rows.append((p, of.astype("<i4").tobytes(), ranks[of, p].astype("<i2").tobytes()))
        out = pd.DataFrame(rows, columns=["pivot", "members", "posted"])
        out.insert(0, "block", int(batch["block"].iloc[0]))
        return out

    placed = table.select(F.pmod(F.xxhash64("vec"), F.lit(blocks)).cast("int").alias("block"), "vec", "v")
    return placed.groupBy("block").applyInPandas(build, INDEX)


def search_block(index: pd.DataFrame, queries: pd.DataFrame, pivots: np.ndarray, posted: int, share: float, keep: int, kind: str = "<f4") -> pd.DataFrame:
    """The ``keep`` best of one index block for each query of one query block: ``(query, vec, score)``."""
    lists = index.set_index("pivot")
    ids = np.frombuffer(lists.at[-1, "members"], "<i8")
    x = np.frombuffer(lists.at[-1, "posted"], kind).reshape(len(ids), -1).astype(np.float64)
    norms = np.sqrt((x * x).sum(1))
    ranks = np.full((len(ids), len(pivots)), posted, np.int16)
    for p in range(len(pivots)):
        ranks[np.frombuffer(lists.at[p, "members"], "<i4"), p] = np.frombuffer(lists.at[p, "posted"], "<i2")
    q = matrix(queries["v"])
    asked = np.minimum(permutations(q, pivots), posted)
    # a block's part of the candidates, with room for an uneven deal
    expected = share * len(ids)
    most = min(len(ids), math.ceil(expected + 2 * math.sqrt(expected)) + keep)
    found = []
    for name, vector, own in zip(queries["vec"], q, asked):
        footrule = np.abs(ranks - own).sum(1, dtype=np.int32)
        # rows are in the order of their ids, so among equals of the last candidate's footrule the smaller ids are in
        near = np.argsort(footrule, kind="stable")[:most]
        score = (x[near] * vector).sum(1) / (norms[near] * math.sqrt((vector * vector).sum()))
        best = np.lexsort((ids[near], -score))[:keep]
        found.append(pd.DataFrame({"query": name, "vec": ids[near][best], "score": score[best]}))
    return pd.concat(found)


def neighbours(rows: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
               pivots: int = PIVOTS, posted: int | None = None, rerank: float = RERANK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` its ``k`` nearest of ``rows`` by cosine.

    Nearest first, ties to the smaller id; a query's own id is no candidate of
    its. Fewer than ``k`` candidates give fewer rows; a query that takes no
    part (see ``usable``) gives none; an empty table gives none. Repeated rows
    of one id and vector count once. Vectors meet only those of as many
    components: each number of components has an index of its own. They keep
    their precision, so a score is the cosine of the vectors as they are. The
    driver holds the pivots' sample and two counts. The query set meets every
    block of the index, so work grows with queries times rows, at a few
    nanoseconds a pivot.
    """
    every, asked = (usable(r, vec_id, embedding).withColumn("_d", F.size("v")) for r in (rows, queries))
    lengths = [r[0] for r in every.select("_d").distinct().orderBy("_d").collect()]
    kind = "<f4" if rows.schema[embedding].dataType.simpleString() == "array<float>" else "<f8"
    parts = [_of_length(every.where(F.col("_d") == d).drop("_d"), asked.where(F.col("_d") == d).drop("_d"), d, k, pivots, posted, rerank, kind) for d in lengths or [1]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _of_length(every: DataFrame, asked: DataFrame, length: int, k: int, pivots: int, posted: int | None, rerank: float, kind: str) -> DataFrame:
    """``neighbours`` among usable vectors of one number of components."""
    every, asked = every.distinct(), asked.distinct()
    table = checkpoint(classes(every, k + 1))
    total = table.count()
    sample = table.orderBy(F.xxhash64("vec"), "vec").limit(max(pivots, SAMPLE)).select("v").collect()
    centre = farthest_first(np.array([r["v"] for r in sample], np.float64).reshape(len(sample), length), pivots)
    posted = min(posted or pivots, max(1, len(centre)))
    blocks = max(1, -(-total // BLOCK))
    share = min(1.0, rerank / math.sqrt(max(1, total)))
    index = checkpoint(build_index(table, centre, blocks, posted, kind))
    wanted = checkpoint(asked.groupBy("v").agg(F.min("vec_id").alias("vec")))  # each distinct query vector once
    query_blocks = max(1, -(-wanted.count() // QUERY_BLOCK))
    dealt = wanted.withColumn("part", F.pmod(F.xxhash64("vec"), F.lit(query_blocks)).cast("int"))
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(lists: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(lists) or not len(own):
            return pd.DataFrame({"query": [], "vec": [], "score": []})
        return search_block(lists, own, centre, posted, share, k + 1, kind)

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(search, "query long, vec long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec")
    top = found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r")
    spread = top.join(table.select("vec", "ids"), "vec").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = (spread.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1)
             .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("_r", "vec_id", "score"))).alias("best")))
    # every query id of a class gets the class's list, less itself
    named = asked.join(wanted.withColumnRenamed("vec", "query"), "v").select(F.col("vec_id").alias("query_id"), "query")
    own = named.join(lists, "query").withColumn("best", F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k))
    out = own.select("query_id", F.posexplode("best").alias("at", "b"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))
