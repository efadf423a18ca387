"""Hard-negative mining by coordinate pruning (LEMP).

Rows of whole-number vectors are sorted by label and length and cut into
*length buckets* of ``BUCKET`` rows. A bucket holds, for each coordinate, its
rows in order of that coordinate of their unit vectors. For an anchor ``q``
and a score ``t`` that a row must reach, only rows whose unit vector has a
cosine of at least ``t / (|q| * longest)`` with ``q`` count, so each
coordinate of theirs lies in a range about that of ``q``. The ranges of the
``FOCUS`` coordinates in which ``q`` is largest are cut out of the sorted
lists by binary search and intersected; only what is left is verified, by
whole-number inner products. A bucket whose longest row cannot reach ``t`` is
skipped. ``t`` rises while an anchor's best rows are found.

Blocks of anchors meet groups of buckets in tasks of bounded size, whatever
one label or one vector holds: first the groups that hold their labels, for
the positives, then all of them for the negatives. Results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.frames import col
from quarry.operators.util import bounded_broadcast, checkpoint, with_global_index

BUCKET = 4096  # rows of a length bucket
GROUP = 4  # buckets that a task searches
ANCHORS = 4096  # anchors that a task searches for
FOCUS = 4  # coordinates whose ranges are intersected
SLACK = 1e-9  # cosines are doubles: ranges and thresholds are this much wider
NO_ID = np.iinfo(np.int64).max  # a null id, after all others


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return vector.isNotNull() & fine


def whole(vector: Column, scale: int = 256) -> Column:
    """Components as whole numbers: ``floor(scale * x)``, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


# ---------------------------------------------------------------- buckets

_INDEX = "grp long, bucket long, d int, n int, kind string, vectors binary, lengths binary, ids binary, labels binary, uids binary, lists binary"


def _matrix(vectors: pa.ChunkedArray, d: int) -> np.ndarray:
    return np.concatenate([np.asarray(c.flatten(), np.int64) for c in vectors.chunks]).reshape(len(vectors), d)


def _pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The buckets of one block of rows: one for each number of components."""
    out: dict[str, list] = {f.split()[0]: [] for f in _INDEX.split(", ")}
    rows = rows.sort_by("_idx")
    dims = rows.column("_d").to_numpy()
    for d in np.unique(dims):
        part = rows.filter(pa.array(dims == d))
        v = _matrix(part.column("_v"), int(d))
        kind = "<i2" if np.abs(v).max(initial=0) < 1 << 15 else "<i8"
        length = np.sqrt((v.astype(float) ** 2).sum(axis=1))
        unit = v / np.maximum(length, 1e-300)[:, None]
        bucket = key[0].as_py()
        ids = part.column("_id").fill_null(NO_ID).to_numpy()
        for name, value in (("grp", bucket // GROUP), ("bucket", bucket), ("d", int(d)), ("n", len(v)), ("kind", kind), ("vectors", v.astype(kind).tobytes()),
                            ("lengths", length.tobytes()), ("ids", ids.tobytes()), ("labels", part.column("_label").to_numpy().tobytes()),
                            ("uids", part.column("_idx").to_numpy().tobytes()), ("lists", np.argsort(unit, axis=0, kind="stable").T.astype("<u2").tobytes())):
            out[name].append(value)
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.table({f.split()[0]: pa.array(out[f.split()[0]], types[f.split()[1]]) for f in _INDEX.split(", ")})


class Bucket:
    """A length bucket, ready to be searched."""

    def __init__(self, row: dict):
        n, self.d = row["n"], row["d"]
        whole_numbers = np.frombuffer(row["vectors"], row["kind"]).reshape(n, self.d).astype(np.int64)
        self.lengths = np.frombuffer(row["lengths"], float)
        self.longest = float(self.lengths.max(initial=0.0))
        self.ids, self.labels, self.uids = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "uids"))
        self.lists = np.frombuffer(row["lists"], "<u2").reshape(self.d, n).astype(np.int64)
        self.unit = whole_numbers / np.maximum(self.lengths, 1e-300)[:, None]
        self.values = np.take_along_axis(self.unit.T, self.lists, axis=1)
        self.whole, self.doubles = whole_numbers, whole_numbers.astype(float)

    def feasible(self, unit: np.ndarray, focus: np.ndarray, length: float, least: int | None) -> np.ndarray:
        """Rows whose score with an anchor of this direction and length may reach ``least`` (None: all)."""
        every = np.arange(len(self.ids))
        if least is None or least <= 0:
            return every
        reach = length * self.longest
        if reach * (1 + SLACK) < least:
            return every[:0]
        cosine = min(1.0, least / reach) - SLACK
        if cosine <= 0:
            return every
        q = unit[focus]
        wide = np.sqrt(np.maximum(0.0, (1 - q**2) * (1 - cosine**2)))
        low = np.where(q <= -cosine, -1.0, q * cosine - wide) - SLACK
        high = np.where(q >= cosine, 1.0, q * cosine + wide) + SLACK
        spans = [(int(np.searchsorted(self.values[f], a)), int(np.searchsorted(self.values[f], b, side="right"))) for f, a, b in zip(focus, low, high)]
        order = sorted(range(len(focus)), key=lambda i: spans[i][1] - spans[i][0])
        if not order:
            return every
        a, b = spans[order[0]]
        left = self.lists[focus[order[0]], a:b]
        for i in order[1:]:  # the others' spans, as the values that bound them
            x = self.unit[left, focus[i]]
            left = left[(x >= low[i]) & (x <= high[i])]
        return left

    def scores(self, rows: np.ndarray, vector: np.ndarray, length: float) -> np.ndarray:
        """Exact inner products: in doubles where every partial sum is a whole number that they hold."""
        if length * self.longest < 1 << 52:
            return (self.doubles[rows] @ vector.astype(float)).astype(np.int64)
        return self.whole[rows] @ vector


class Best:
    """The ``k`` best rows so far: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k = k
        self.score = self.id = self.uid = np.zeros(0, np.int64)

    def least(self) -> int | None:
        """What a new row must score to matter; None while there is room."""
        return int(self.score[-1]) if len(self.score) == self.k else None

    def add(self, score: np.ndarray, id: np.ndarray, uid: np.ndarray) -> None:
        if len(score) > self.k:
            keep = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, id, uid = score[keep], id[keep], uid[keep]
        s, i, u = (np.concatenate(p) for p in ((self.score, score), (self.id, id), (self.uid, uid)))
        first = np.lexsort((u, i, -s))[: self.k]
        self.score, self.id, self.uid = s[first], i[first], u[first]


def _anchors(table: pa.Table) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray, float]]:
    """Of each anchor: its row, vector, direction, focus coordinates and length."""
    for a in table.to_pylist():
        v = np.array(a["_v"], np.int64)
        length = math.sqrt(float((v.astype(float) ** 2).sum()))
        unit = v / max(length, 1e-300)
        yield a, v, unit, np.argsort(-np.abs(unit), kind="stable")[:FOCUS], length


def _buckets(table: pa.Table) -> list[Bucket]:
    return sorted((Bucket(r) for r in table.to_pylist()), key=lambda b: -b.longest)


def _found(columns: dict[str, tuple[list, pa.DataType]]) -> pa.Table:
    return pa.table({c: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), t) for c, (v, t) in columns.items()})


def _positives(k: int):
    def search(anchors: pa.Table, index: pa.Table) -> pa.Table:
        buckets, out = _buckets(index), [[], [], [], []]
        for a, v, unit, focus, length in _anchors(anchors):
            best = Best(k)
            for b in buckets:
                if b.d != a["_d"]:
                    continue
                rows = b.feasible(unit, focus, length, best.least())
                rows = rows[(b.labels[rows] == a["_label"]) & (b.uids[rows] != a["_idx"])]
                best.add(b.scores(rows, v, length), b.ids[rows], b.uids[rows])
            for o, x in zip(out, (np.full(len(best.score), a["_idx"]), best.uid, best.id, best.score)):
                o.append(x)
        return _found({c: (o, pa.int64()) for c, o in zip(("anchor", "uid", "id", "score"), out)})

    return search


def _negatives(k: int, low: int, high: int):
    def search(anchors: pa.Table, index: pa.Table) -> pa.Table:
        buckets, out = _buckets(index), [[], [], [], [], []]
        for a, v, unit, focus, length in _anchors(anchors):
            # bands of scores that are low to high hundredths of a positive's
            bands = [(p["rank"], -(-low * p["score"] // 100), high * p["score"] // 100, Best(k)) for p in a["_found"]]
            bands = [b for b in bands if b[1] <= b[2]]
            for b in buckets if bands else []:
                if b.d != a["_d"]:
                    continue
                need = [lo if best.least() is None else max(lo, best.least()) for _, lo, _, best in bands]
                rows = b.feasible(unit, focus, length, min(need))
                rows = rows[b.labels[rows] != a["_label"]]
                score = b.scores(rows, v, length)
                for (_, _, hi, best), t in zip(bands, need):
                    fits = (score >= t) & (score <= hi)
                    best.add(score[fits], b.ids[rows[fits]], b.uids[rows[fits]])
            for rank, _, _, best in bands:
                for o, x in zip(out, (np.full(len(best.score), a["_idx"]), np.full(len(best.score), rank), best.uid, best.id, best.score)):
                    o.append(x)
        return _found({c: (o, pa.int64()) for c, o in zip(("anchor", "positive", "uid", "id", "score"), out)})

    return search


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` of each key's rows from all tasks, with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"), F.asc("uid"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))


def _meet(anchors: DataFrame, buckets: DataFrame, pairs: DataFrame, search, schema: str) -> DataFrame:
    """``search`` on every pair of a block of anchors and a group of buckets."""
    pairs = checkpoint(pairs)
    left = anchors.join(pairs, "_block").groupBy("_block", "grp")
    right = buckets.join(pairs, "grp").groupBy("_block", "grp")
    return left.cogroup(right).applyInArrow(search, schema)


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Each anchor's positives, and for each of them the hardest negatives in a band under its score.

    ``rows`` has whole numbers: an id, a ``label`` and ``vector array<bigint>``;
    ``anchor`` marks the anchors. Rows with a null label, vector or component
    take no part. Scores are inner products; higher ones come first, ties by
    smaller id (null last). Positives are an anchor's first ``positives``
    other rows of its label; negatives the first rows of other labels with
    ``low * positive <= 100 * score <= high * positive``. Returns
    ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``; a positive without negatives has no row. Repeated rows
    and ids are rows of their own; vectors meet only those of as many
    components. Scores that do not fit 64 bits raise ``ValueError``. Extra
    columns are ignored; an empty table gives no rows.
    """
    v = col(vector)
    plain = rows.select(col(id_col).cast("long").alias("_id"), col(label).cast("long").alias("_label"), v.cast("array<bigint>").alias("_v"),
                        F.coalesce(anchor, F.lit(False)).alias("_anchor"))
    plain = plain.where(F.col("_label").isNotNull() & F.col("_v").isNotNull() & F.forall("_v", lambda x: x.isNotNull()))
    square = F.aggregate("_v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ordered = plain.withColumn("_d", F.size("_v")).withColumn("_short", -square).withColumn("_tie", F.monotonically_increasing_id())
    placed = with_global_index(ordered, ["_d", "_label", "_short", "_id", "_tie"], "_idx")
    most = placed.agg(F.min("_short")).first()[0]
    if most is not None and -most >= 2.0**62:
        raise ValueError("inner products beyond 64 bits")
    placed = placed.withColumn("bucket", F.expr(f"_idx div {BUCKET}")).drop("_tie", "_short")
    light = placed.select("bucket", "_idx", "_id", "_label", "_d", "_v")
    buckets = checkpoint(light.groupBy("bucket").applyInArrow(_pack, _INDEX))
    held = checkpoint(placed.select("_d", "_label", F.expr(f"bucket div {GROUP}").alias("grp")).distinct())
    some = placed.where("_anchor").select("_id", "_label", "_d", "_v", F.col("_idx"))
    some = checkpoint(with_global_index(some, ["_idx"], "_block").withColumn("_block", F.expr(f"_block div {ANCHORS}")))

    like = some.select("_block", "_d", "_label").distinct().join(bounded_broadcast(held), ["_d", "_label"]).select("_block", "grp").distinct()
    found = _meet(some, buckets, like, _positives(positives), "anchor long, uid long, id long, score long")
    best = checkpoint(_best(found, ["anchor"], positives).select("anchor", F.col("rank").cast("long").alias("rank"), "id", "score"))

    known = best.groupBy("anchor").agg(F.collect_list(F.struct("rank", "score")).alias("_found"))  # at most ``positives`` of them
    asked = some.join(known, some["_idx"] == known["anchor"]).drop("anchor")
    all_ = some.select("_block", "_d").distinct().join(bounded_broadcast(held.select("_d", "grp").distinct()), "_d").select("_block", "grp").distinct()
    hard = _meet(asked, buckets, all_, _negatives(negatives, low, high), "anchor long, positive long, uid long, id long, score long")
    hard = _best(hard, ["anchor", "positive"], negatives)
    named = best.select("anchor", F.col("rank").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = hard.join(named, ["anchor", "positive"]).join(some.select(F.col("_idx").alias("anchor"), F.col("_id").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
                      F.col("score").alias("negative_score"))
