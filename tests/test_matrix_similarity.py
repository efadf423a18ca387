import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import matrix as M
from quarry.operators import similarity as SIM
from quarry.operators.util import with_global_index


def test_tfidf_definition(spark):
    docs = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["a", "c"]), (3, [])], "doc_id long, tokens array<string>")
    n = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    got = {(r.doc_id, r.term): r.tfidf for r in M.tf_idf(M.doc_term_matrix(docs), n).collect()}
    assert got[(1, "a")] == pytest.approx((1 + math.log(2)) * math.log(3 / 2))
    assert got[(1, "b")] == pytest.approx(math.log(3))
    assert got[(2, "c")] == pytest.approx(math.log(3))
    assert len(got) == 4


def test_global_index_matches_sorted_order(spark):
    words = [f"w{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(w,) for w in reversed(words)], "term string").repartition(7)
    got = sorted((r.idx, r.term) for r in with_global_index(df, ["term"], "idx").collect())
    assert got == list(enumerate(words))


def _brute(vectors, ga, gb):
    unit = {}
    for d, v in vectors.items():
        n = np.linalg.norm(v)
        if n > 0:
            unit[d] = v / n
    vals = [unit[i] @ unit[j] for i in ga if i in unit for j in gb if j in unit and i != j]
    return float(np.mean(vals)) if vals else 0.0


def test_group_cosine_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = {d: rng.random(5) * (rng.random(5) > 0.4) for d in range(1, 7)}
    vectors[6] = np.zeros(5)  # zero vector (q8)
    cells = [(d, f"t{k}", float(x)) for d, v in vectors.items() for k, x in enumerate(v) if x != 0]
    df = spark.createDataFrame(cells, "doc_id long, term string, tfidf double")
    groups = {"A": [1, 2, 3, 6], "B": [3, 4, 5], "C": [5]}  # overlap 3; C is a single doc
    gdf = spark.createDataFrame([(d, g) for g, ds in groups.items() for d in ds], "doc_id long, grp string")
    out = {(r.group_a, r.group_b): r.mean_cos for r in SIM.group_cosine(SIM.unit_rows(df), gdf).collect()}
    for a in groups:
        for b in groups:
            assert out[(a, b)] == pytest.approx(_brute(vectors, groups[a], groups[b]), abs=1e-12)
    assert out[("C", "C")] == 0.0  # no pair


def test_pair_cosine(spark):
    cells = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (2, "a", 2.0), (3, "c", 1.0)],
                                  "doc_id long, term string, tfidf double")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (4, 1), (2, 2)], "a long, b long")
    got = {(r.a, r.b): r.cosine for r in SIM.pair_cosine(SIM.unit_rows(cells), pairs, "a", "b").collect()}
    assert got[(1, 2)] == pytest.approx(1 / math.sqrt(2))
    assert got[(1, 3)] == 0.0
    assert got[(1, 4)] is None and got[(4, 1)] is None  # zero vector on either side
    assert got[(2, 2)] == pytest.approx(1.0)
    assert len(got) == 5


def test_split_hot_join_is_exact(spark):
    from quarry.operators.util import split_hot_join

    big_rows = [(i, "hot") for i in range(300)] + [(i, f"k{i % 7}") for i in range(70)] + [(1, "missing")]
    big = spark.createDataFrame(big_rows, "id long, key string")
    small = spark.createDataFrame([("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(7)], "key string, v double")
    counts = big.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    for how in ("inner", "left"):
        got = sorted(tuple(r) for r in split_hot_join(big, small, "key", counts, big.count(), how=how, max_hot=3).collect())
        want = sorted(tuple(r) for r in big.join(small, "key", how).collect())
        assert got == want


def test_stem_join_fallback_without_broadcast(spark):
    from quarry.functions.stemmer import stem_token_arrays

    df = spark.createDataFrame([(1, ["ponies", "cats", "ponies"]), (2, ["cats"])], "doc_id long, tokens array<string>")
    got = {r.doc_id: r.tokens for r in stem_token_arrays(df, "tokens", max_broadcast_terms=1).collect()}
    assert got == {1: ["poni", "cat", "poni"], 2: ["cat"]}


def test_lsa_embed_matches_numpy(spark):
    rng = np.random.default_rng(11)
    x = rng.random((8, 12)) * (rng.random((8, 12)) > 0.5)
    cells = [(d, f"t{j:02d}", float(x[d, j])) for d in range(8) for j in range(12) if x[d, j] != 0]
    df = spark.createDataFrame(cells, "doc_id long, term string, tfidf double")
    us, s = SIM.lsa_embed(df, 3)
    assert s == sorted(s, reverse=True)
    u, sv, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(s, sv[:3], rtol=1e-6)
    got = {}
    for r in us.collect():
        got.setdefault(r.doc_id, {})[r.comp] = r.value
    emb = np.array([[got[d][c] for c in range(3)] for d in range(8)])
    xk = (u[:, :3] * sv[:3]) @ vt[:3]

    def cos(m):
        n = m / np.linalg.norm(m, axis=1, keepdims=True)
        return n @ n.T

    assert np.allclose(cos(emb), cos(xk), atol=1e-6)  # U_k S_k rows = rank-k reconstruction cosines


def test_lsa_sweep_k0_is_full_space(spark):
    rng = np.random.default_rng(5)
    cells = [(d, f"t{j}", float(v)) for d in range(10) for j, v in enumerate(rng.random(6)) if v > 0.3]
    df = spark.createDataFrame(cells, "doc_id long, term string, tfidf double")
    groups = spark.createDataFrame([(d, "A" if d < 5 else "B") for d in range(10)], "doc_id long, grp string")
    us, _ = SIM.lsa_embed(df, 4)
    unit = SIM.unit_rows(df)
    sweep = {r.max_singular_values: r for r in SIM.lsa_group_sweep(us, unit, groups, "A", "B", [0, 2, 4]).collect()}
    full = {(r.group_a, r.group_b): r.mean_cos for r in SIM.group_cosine(unit, groups).collect()}
    assert sweep[0].AA == pytest.approx(full[("A", "A")]) and sweep[0].AB == pytest.approx(full[("A", "B")])
    assert set(sweep) == {0, 2, 4}


def test_lsa_analyses_over_all_ranks_equal_numpy(spark):
    """All k up to the number of documents, two analyses, overlapping groups, against the SVD's reconstructions."""
    rng = np.random.default_rng(15)
    x = rng.random((30, 40)) * (rng.random((30, 40)) > 0.5)
    df = spark.createDataFrame([(d, f"t{j}", float(x[d, j])) for d in range(30) for j in range(40)], "doc_id long, term string, tfidf double")
    of = {"A": range(12), "B": range(8, 25), "C": range(20, 30), "D": []}
    groups = spark.createDataFrame([(d, g) for g, ids in of.items() for d in ids], "doc_id long, grp string")
    analyses = {1: ("A", "B"), 2: ("C", "A"), 3: ("D", "B")}
    rows = SIM.lsa_analyses(SIM.lsa_embed_whole(df), SIM.unit_rows(df), groups, analyses, [0, 10, 20, 30]).collect()
    assert [(r.analysis_num, r.max_singular_values) for r in rows] == [(a, k) for a in (1, 2, 3) for k in (0, 10, 20, 30)]
    u, sv, vt = np.linalg.svd(x, full_matrices=False)
    for r in rows:
        k = r.max_singular_values
        xk = (u[:, :k] * sv[:k]) @ vt[:k] if k else x
        unit = xk / np.linalg.norm(xk, axis=1, keepdims=True)
        a, b = (of[g] for g in analyses[r.analysis_num])
        for got, p, q in ((r.AA, a, a), (r.AB, a, b), (r.BB, b, b)):
            cos = [unit[i] @ unit[j] for i in p for j in q if i != j]
            assert got == pytest.approx(np.mean(cos) if cos else 0.0, abs=1e-8)


def test_lsa_sweep_goes_up_to_the_number_of_documents(spark):
    from quarry.plans.q_models import lsa_group_sweep

    rows = lsa_group_sweep(spark, "/root/testdata/sf0.001").collect()
    assert [(r.analysis_num, r.max_singular_values) for r in rows] == [(a, k) for a in (1, 2, 3) for k in range(0, 201, 10)]


def test_group_cosine_join_path_equals_pivot_path(spark, monkeypatch):
    rng = np.random.default_rng(9)
    cells = [(d, f"t{j}", float(v)) for d in range(12) for j, v in enumerate(rng.random(5)) if v > 0.4]
    df = spark.createDataFrame(cells, "doc_id long, term string, tfidf double")
    gdf = spark.createDataFrame([(d, g) for d in range(12) for g in ("A", "B", "C") if (d + ord(g)) % 3],
                                "doc_id long, grp string")
    unit = SIM.unit_rows(df)
    pivot = {(r.group_a, r.group_b): (r.n_a, r.n_b, r.n_common, r.mean_cos) for r in SIM.group_cosine(unit, gdf).collect()}
    monkeypatch.setattr(SIM, "MAX_PIVOT_GROUPS", 0)
    joined = {(r.group_a, r.group_b): (r.n_a, r.n_b, r.n_common, r.mean_cos) for r in SIM.group_cosine(unit, gdf).collect()}
    assert pivot.keys() == joined.keys() and len(pivot) == 9
    for k in pivot:
        assert pivot[k][:3] == joined[k][:3]
        assert pivot[k][3] == pytest.approx(joined[k][3], abs=1e-12)


@pytest.mark.parametrize("k,block", [(10, None), (60, 25), (None, 64)])
def test_range_finder_equals_numpy(spark, k, block):
    """Singular values and rows of U S of 200 documents, few and all of them, with blocks that end early."""
    from quarry.operators.svd import truncated_svd

    rng = np.random.default_rng(0)
    x = np.where(rng.random((200, 900)) < 0.05, rng.gamma(2.0, size=(200, 900)), 0)
    x[7], x[9] = 0, x[8]
    df = spark.createDataFrame([(int(i), f"t{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x))], "doc_id long, term string, tfidf double")
    us, s = truncated_svd(df, k, block=block)
    u, sv, _ = np.linalg.svd(x, full_matrices=False)
    assert len(s) == (k or np.linalg.matrix_rank(x)) and np.allclose(s, sv[: len(s)], rtol=0, atol=1e-9)
    rows = np.zeros((200, len(s)))
    for r in us.collect():
        rows[r["doc_id"]] = r["us"]
    assert np.allclose(rows @ rows.T, (u[:, : len(s)] * sv[: len(s)] ** 2) @ u[:, : len(s)].T, atol=1e-7)


def test_range_finder_adds_blocks_until_the_range_is_exhausted(spark, monkeypatch):
    """No number of blocks ends the whole SVD early."""
    from quarry.operators import svd

    monkeypatch.setattr(svd, "BLOCKS", 3, raising=False)
    x = np.random.default_rng(4).random((12, 20))
    df = spark.createDataFrame([(i, f"t{j}", float(x[i, j])) for i in range(12) for j in range(20)], "doc_id long, term string, tfidf double")
    _, s = svd.truncated_svd(df, None, block=2)
    assert len(s) == 12 and np.allclose(s, np.linalg.svd(x, compute_uv=False), rtol=0, atol=1e-9)


def test_columns_travel_a_few_at_a_time(spark, monkeypatch):
    """A bound on what is on its way cuts a block's columns, not the result."""
    from quarry.operators import svd

    x = np.random.default_rng(8).random((9, 14))
    df = spark.createDataFrame([(i, f"t{j:02d}", float(x[i, j])) for i in range(9) for j in range(14)], "doc_id long, term string, tfidf double")
    sent, matrix = [], svd._through

    def through(docs, table, old, width, columns):
        def counted(a, b):
            sent.append(b - a)
            return columns(a, b)

        return matrix(docs, table, old, width, counted)

    monkeypatch.setattr(svd, "_through", through)
    monkeypatch.setattr(svd, "MOVED", 14 * 8 * 3)
    us, s = svd.truncated_svd(df, None, block=5)
    assert set(sent) <= {1, 2, 3} and 3 in sent and 2 in sent
    u, sv, _ = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(s, sv, rtol=0, atol=1e-9)
    rows = np.zeros((9, len(s)))
    for r in us.collect():
        rows[r["doc_id"]] = r["us"]
    assert np.allclose(rows @ rows.T, x @ x.T, atol=1e-7)


def test_range_finder_of_nothing(spark):
    from quarry.operators.svd import truncated_svd

    us, s = truncated_svd(spark.createDataFrame([(1, "a", 0.0)], "doc_id long, term string, tfidf double"), 3)
    assert us.collect() == [] and s == []


def test_groups_that_no_pair_asks_for_are_not_written(spark, monkeypatch):
    from quarry.operators import similarity

    unit = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.6), (2, "b", 0.8), (3, "b", 1.0), (4, "a", 1.0)], "doc_id long, term string, u double")
    groups = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "z"), (1, "z")], "doc_id long, grp string")
    every = {(r["group_a"], r["group_b"]): r["mean_cos"] for r in similarity.group_cosine(unit, groups).collect()}
    written, write = [], similarity.checkpoint
    monkeypatch.setattr(similarity, "checkpoint", lambda df: written.append(write(df)) or written[-1])
    got = {(r["group_a"], r["group_b"]): r["mean_cos"] for r in similarity.group_cosine(unit, groups, pairs=[("x", "x"), ("x", "y")]).collect()}
    assert got == {p: every[p] for p in (("x", "x"), ("x", "y"))}
    assert {r["grp"] for r in written[0].collect()} == {"x", "y"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_document_frequencies_are_counted_once(spark, monkeypatch):
    # beyond the broadcast bound the IDF table is read by several joins: it is written, not worked out for each
    docs = spark.createDataFrame([(i, [f"t{j}" for j in range(20) if i % (j + 1) == 0] * 2) for i in range(60)], "doc_id long, tokens array<string>")
    n = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    want = {tuple(r) for r in M.tf_idf(M.doc_term_matrix(docs), n).select("doc_id", "term", "tf", F.round("tfidf", 9)).collect()}
    monkeypatch.setattr(M, "IDF_BROADCAST_ROWS", 5)
    for drop in (False, True):
        cells = M.tf_idf(M.doc_term_matrix(docs), n, drop_zero=drop)
        assert "HashAggregate" not in _plan(cells)
        got = {tuple(r) for r in cells.select("doc_id", "term", "tf", F.round("tfidf", 9)).collect()}
        assert got == {r for r in want if r[3] or not drop}


def test_counts_by_document_and_term_need_one_exchange_of_the_texts(spark):
    from quarry.plans.q_matrix import _dtm

    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # as many splits as cores: the scan is not spread for its own sake
    try:
        dtm = _dtm(spark, "/root/testdata/sf0.01")
        assert _plan(dtm).count("Exchange") == 1 and re.search(r"Exchange hashpartitioning\(doc_id#\d+L, \d+\)", _plan(dtm))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_frobenius_norm_by_group_joins_rows_not_cells(spark):
    cells = spark.createDataFrame([(1, "a", 3.0), (1, "b", 4.0), (2, "a", 2.0), (3, "c", 1.0)], "doc_id long, term string, v double")
    groups = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y"), (4, "y")], "doc_id long, grp string")
    got = dict(M.frobenius_norm(cells, "v", ["grp"], groups).collect())
    assert got == pytest.approx({"x": 29 ** 0.5, "y": 2.0})
    assert got == pytest.approx(dict(M.frobenius_norm(cells.join(groups, "doc_id"), "v", ["grp"]).collect()))
