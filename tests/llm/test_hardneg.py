"""Operator 11 against every pair's score."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import hardneg


def brute(rows, positives=5, negatives=10, low=30, high=90):
    """rows: (id, label, vector, anchor)."""
    big = 1 << 62
    out = []
    use = [(i if i is not None else big, lab, v, a) for i, lab, v, a in rows if lab is not None and v is not None and None not in v]
    length = np.array([len(v) for _, _, v, _ in use])
    whole = {d: np.array([v for _, _, v, _ in use if len(v) == d], np.int64).reshape(int((length == d).sum()), d) for d in set(length)}
    for n, (i, lab, v, anchor) in enumerate(use):
        if not anchor:
            continue
        at = np.flatnonzero(length == len(v))
        scores = whole[len(v)] @ np.array(v, np.int64)
        others = [(-int(s), use[k][0], int(k), use[k][1]) for k, s in zip(at, scores) if k != n]
        same = sorted(o for o in others if o[3] == lab)[:positives]
        unlike = sorted(o for o in others if o[3] != lab)
        for p in same:
            fit = [o for o in unlike if low * -p[0] <= 100 * -o[0] <= high * -p[0]][:negatives]
            out += [(i, p[1], r + 1, o[1], -p[0], -o[0]) for r, o in enumerate(fit)]
    null = lambda x: None if x == big else x
    return sorted([(null(a), null(b), r, null(c), s, t) for a, b, r, c, s, t in out], key=repr)


def mined(df, **args):
    got = hardneg.mine(df, F.col("anchor"), **args).collect()
    return sorted([(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in got], key=repr)


SCHEMA = "vec_id long, label int, embedding array<bigint>, anchor boolean"


def test_random_rows(table):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 12))
    rows = [(i, int(c), [int(x) for x in np.floor(80 * (centres[c] + 0.9 * rng.normal(size=12)))], i % 60 == 0) for i, c in enumerate(rng.integers(0, 6, 9000))]
    assert mined(table(rows, SCHEMA)) == brute(rows)


def test_ties_copies_and_odd_rows(table):
    """A third of the rows one vector of one label, repeated ids, null ids, zero and empty vectors, two lengths, one label each."""
    rng = np.random.default_rng(2)
    rows = [(i, 1, [3, 4, 0], i % 50 == 0) for i in range(300)]
    rows += [(300 + i, int(rng.integers(0, 4)), [int(x) for x in rng.integers(-5, 6, 3)], i % 25 == 0) for i in range(300)]
    rows += [(1000 + i, i, [int(x) for x in rng.integers(0, 6, 2)], i % 10 == 0) for i in range(60)]
    rows += [(7, 2, [3, 3, 0], True), (7, 2, [3, 3, 0], True), (None, 2, [2, 3, 0], True), (None, 1, [2, 3, 0], None), (8, None, [1, 1, 1], True), (9, 1, None, True),
             (10, 1, [1, None, 1], True), (11, 1, [0, 0, 0], True), (12, 3, [], True), (13, 3, [], False), (14, 4, [], False), (15, 1, [-3, -4, 0], True)]
    df = table(rows, SCHEMA)
    for name in ("rank", "grp", "bucket", "uid", "score", "id"):
        df = df.withColumn(name, F.lit("x"))
    assert mined(df) == brute(rows)


def test_wide_numbers_and_bounds(table):
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 3), [int(x) for x in rng.integers(0, 1 << 29, 4)], i % 10 == 0) for i in range(120)]
    assert mined(table(rows, SCHEMA)) == brute(rows)
    with pytest.raises(ValueError):
        hardneg.mine(table([(1, 1, [1 << 31, 1 << 31], True)], SCHEMA), F.col("anchor"))


def test_nothing(spark, table):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(table([(1, 1, [1, 2], False), (2, 1, [1, 2], False)], SCHEMA)) == []


def test_preparation(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, [None, 1.0]), (6, []), (7, [-inf, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    assert {r["id"] for r in df.where(hardneg.usable(F.col("v"))).collect()} == {1, 6}
    assert df.where("id = 1").select(hardneg.whole(F.col("v")).alias("w")).first()["w"] == [128, -1]


def test_pruning_loses_nothing_and_prunes():
    """A bucket's feasible rows hold every row that reaches the score, and far fewer where the score is high."""
    rng = np.random.default_rng(4)
    v = np.floor(200 * rng.normal(size=(3000, 16))).astype(np.int64)
    n = len(v)
    table = pa.table({"bucket": [0] * n, "_idx": range(n), "_id": range(n), "_label": [1] * n, "_d": pa.array([16] * n, pa.int32()), "_v": v.tolist()})
    bucket = hardneg.Bucket(hardneg._pack((pa.scalar(0),), table).to_pylist()[0])
    for q in v[:50]:
        length = float(np.sqrt((q.astype(float) ** 2).sum()))
        unit = q / length
        focus = np.argsort(-np.abs(unit))[: hardneg.FOCUS]
        scores = v @ q
        for least in (int(np.sort(scores)[-k]) for k in (1, 2, 10, 500)):
            rows = bucket.feasible(unit, focus, length, least)
            assert set(np.flatnonzero(scores >= least)) <= set(rows)
        assert len(bucket.feasible(unit, focus, length, int(0.95 * length * bucket.longest))) < n / 10
        assert len(bucket.feasible(unit, focus, length, int(1.1 * length * bucket.longest))) == 0
