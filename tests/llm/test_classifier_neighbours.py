"""Operators 8 and 9: held-out accuracy, plain updates, recall against brute force."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import classifier as cl
from quarry.llm import permutation as pm


def test_held_out(table):
    ids = [*range(50), None, -3]
    got = {r["i"]: r["h"] for r in table([(i,) for i in ids], "i long").select("i", cl.held_out(F.col("i")).alias("h")).collect()}
    assert got == {i: i is None or zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


def test_features_of_a_batch_are_those_of_each_text():
    texts = ["one two two THREE!!", None, "", "a", "x y z " * 40, "one two"]
    index, n = cl.features(texts)
    assert n.tolist() == [4, 0, 0, 1, 120, 2]
    at = np.cumsum(n) - n
    for t, a, k in zip(texts, at, n):
        alone, m = cl.features([t])
        assert m.tolist() == [k] and (alone == index[:, a:a + k]).all()
    assert (cl.features(["ABC!!"])[0][1] == cl.features(["DE!!"])[0][1]).all()  # one form


def test_scores_are_sparse_dot_products():
    rng = np.random.default_rng(1)
    w, bias = rng.normal(size=1 << cl.BITS), 0.3
    texts = ["one two two THREE!!", None, "a b", " ".join(f"w{i}" for i in range(500))]
    want = []
    for t in texts:
        index, _ = cl.features([t])
        used = index[index >= 0]
        x = bias + (cl.SCALE * w[used].sum() / len(used) if len(used) else 0)
        want.append(1 / (1 + math.exp(-max(-35, min(35, x)))))
    assert cl.score_texts(texts, w, bias) == pytest.approx(want)


def test_ftrl_step_by_step():
    """The update written out coordinate by coordinate."""
    model = cl.Ftrl(4)
    z, n = [0.0] * 4, [0.0] * 4
    rng = np.random.default_rng(0)
    for _ in range(50):
        at = np.sort(rng.choice(4, 2, replace=False))
        x, y = rng.random(2) * 3, float(rng.integers(0, 2))
        w = [0.0 if abs(z[i]) <= cl.L1 else -(z[i] - math.copysign(cl.L1, z[i])) / ((cl.BETA + math.sqrt(n[i])) / cl.ALPHA + cl.L2) for i in at]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
        for k, i in enumerate(at):
            g = (p - y) * x[k]
            s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / cl.ALPHA
            z[i] += g - s * w[k]
            n[i] += g * g
        model.update(at, x, y)
    assert model.z.tolist() == pytest.approx(z) and model.n.tolist() == pytest.approx(n)


def test_held_out_accuracy(spark):
    from quarry.llm.q_classifier import op8_quality_classifier

    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op8_quality_classifier(spark, sf).collect()
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(rows) == 1000 and len(held) > 50
    assert sum(p == q for p, q in held) >= 0.97 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_training_on_odd_labels(awkward, no_documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    w, bias = cl.train(awkward, none)
    assert not w.any() and bias == 0
    assert {r["score"] for r in cl.score(awkward, (w, bias)).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 0), (7, 0), (7, 0)], "doc_id long, quality int")
    model = cl.train(awkward, odd)
    again = cl.train(awkward.repartition(1), odd)
    assert (model[0] == again[0]).all() and model[1] == again[1]
    assert cl.score(no_documents, model).collect() == []
    kept = cl.accept(awkward, model, 0.0)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def brute(rows, queries, k=5):
    out = {}
    for q, x in queries:
        s = sorted((-(float(np.dot(x, y)) / (math.sqrt(np.dot(x, x)) * math.sqrt(np.dot(y, y)))), i) for i, y in rows if i != q)
        out[q] = [(i, -v) for v, i in s[:k]]
    return out


def answer(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_neighbours_of_a_small_table(table):
    """As many candidates as there are rows: the exact answer, copies and ties included."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 8)).astype(np.float32).astype(float)
    x[20:35] = x[3]
    x[40] = 2 * x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(100, None), (101, [0.0] * 8), (102, [1.0] * 7 + [None]), (103, [float("nan")] * 8), (104, [float("inf")] + [0.0] * 7), (105, [1.0]), (None, [1.0] * 8)]
    df = table(rows + odd + rows[:5], "vec_id long, embedding array<float>")
    got = answer(pm.neighbours(df, df.where("vec_id % 5 = 0"), rerank=100.0))
    want = brute([(i, np.array(v)) for i, v in rows], [(i, np.array(v)) for i, v in rows if i % 5 == 0])
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_few_and_no_vectors(spark, table):
    df = table([(0, [1.0, 0.0]), (50, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert answer(pm.neighbours(df, df)) == {0: [(50, 0.0)], 50: [(0, 0.0)]}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pm.neighbours(empty, empty).collect() == []


def test_blocks_and_posted_prefixes(table, monkeypatch):
    monkeypatch.setattr(pm, "BLOCK", 16)
    monkeypatch.setattr(pm, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(90, 6)).astype(np.float32).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = table(rows, "vec_id long, embedding array<float>")
    want = brute([(i, np.array(v)) for i, v in rows], [(i, np.array(v)) for i, v in rows if i % 5 == 0])
    for posted in (None, 12):
        got = answer(pm.neighbours(df, df.where("vec_id % 5 = 0"), pivots=32, posted=posted, rerank=100.0))
        assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_recall(spark):
    from quarry.llm.q_neighbours import op9_permutation_index

    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = answer(op9_permutation_index(spark, "/root/testdata/sf0.1"))
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_recall_with_a_third_of_near_copies(table):
    """Near copies are unlike vectors, so each is an entry; they must not fill the pivots."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(3000, 64))
    x[:1000] = x[0] + 0.05 * rng.normal(size=(1000, 64))
    x = x[rng.permutation(3000)].astype(np.float32).astype(float)
    df = table([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = answer(pm.neighbours(df, df.where("vec_id % 20 = 0")))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 20):
        near = u @ u[q]
        near[q] = -2
        hits += len(set(np.argsort(-near)[:5].tolist()) & {i for i, _ in got[q]})
    assert hits >= 0.93 * 5 * 150


def test_pivots_are_far_from_each_other():
    rng = np.random.default_rng(13)
    x = rng.normal(size=(300, 16))
    x[:100] = x[0] + 0.01 * rng.normal(size=(100, 16))
    pivots = pm.farthest_first(x, 40)
    assert pivots.shape == (40, 16) and np.linalg.norm(pivots, axis=1) == pytest.approx(1)
    assert (pivots @ (x[0] / np.linalg.norm(x[0])) > 0.99).sum() == 1
    assert len(pm.farthest_first(np.outer([1.0, 2.0, 3.0], [1.0, 1.0]), 3)) == 1
    assert pm.farthest_first(np.empty((0, 1)), 5).shape == (0, 1)


def test_permutations():
    rng = np.random.default_rng(8)
    x, pivots = rng.normal(size=(5, 4)), rng.normal(size=(7, 4))
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    ranks = pm.permutations(x, pivots)
    for v, r in zip(x, ranks):
        assert list(np.argsort(r)) == sorted(range(7), key=lambda p: -float(v @ pivots[p]))


def test_doubles_keep_their_precision(table):
    rng = np.random.default_rng(21)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(300)]
    df = table(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")).withColumn("score", F.lit(1)).withColumn("block", F.lit(0))
    got = answer(pm.neighbours(df, df.where("vec_id % 50 = 0"), rerank=100.0))
    want = brute([(i, np.array(v)) for i, v in rows], [(i, np.array(v)) for i, v in rows if i % 50 == 0])
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(a - b) <= 1e-15 for q in want for (_, a), (_, b) in zip(got[q], want[q]))


def test_each_length_has_an_index_of_its_own(table):
    rng = np.random.default_rng(22)
    rows = [(i, rng.normal(size=8 if i < 140 else 16).astype(np.float32).astype(float).tolist()) for i in range(300)]
    df = table(rows, "vec_id long, embedding array<float>")
    got = answer(pm.neighbours(df, df.where("vec_id % 50 = 0"), rerank=100.0))
    assert sorted(got) == [0, 50, 100, 150, 200, 250]
    for low, high in ((0, 140), (140, 300)):
        part = [(i, np.array(v)) for i, v in rows if low <= i < high]
        want = brute(part, [r for r in part if r[0] % 50 == 0])
        assert {q: [i for i, _ in got[q]] for q in want} == {q: [i for i, _ in v] for q, v in want.items()}


def test_training_takes_one_row_an_id(table):
    """An id whose rows are a third of the table trains as one row."""
    rows = [(i, f"word{i} good text" if i % 2 else f"word{i} bad lines") for i in range(60)]
    labels = table([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    once = cl.train(table(rows, "doc_id long, text string"), labels)
    again = cl.train(table(rows + [rows[1]] * 30, "doc_id long, text string"), labels)
    assert (once[0] == again[0]).all() and once[1] == again[1]
