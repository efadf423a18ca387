"""Property-based checks (hypothesis) of the exact rewrites against brute force."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import similarity as SIM
from quarry.operators.util import split_hot_join

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(seed=st.integers(0, 10_000), n_docs=st.integers(2, 9), n_terms=st.integers(1, 6))
def test_group_cosine_identity(spark, seed, n_docs, n_terms):
    rng = np.random.default_rng(seed)
    x = rng.random((n_docs, n_terms)) * (rng.random((n_docs, n_terms)) > 0.5)
    cells = [(d, f"t{j}", float(x[d, j])) for d in range(n_docs) for j in range(n_terms) if x[d, j] != 0]
    if not cells:
        return
    groups = [(d, g) for d in range(n_docs) for g in ("A", "B") if rng.random() < 0.6]
    if not groups:
        return
    df = spark.createDataFrame(cells, "doc_id long, term string, tfidf double")
    gdf = spark.createDataFrame(groups, "doc_id long, grp string")
    got = {(r.group_a, r.group_b): r.mean_cos for r in SIM.group_cosine(SIM.unit_rows(df), gdf).collect()}
    norms = np.linalg.norm(x, axis=1)
    members = {g: [d for d, gg in groups if gg == g and norms[d] > 0] for g in ("A", "B")}
    for (ga, gb), v in got.items():
        vals = [x[i] @ x[j] / (norms[i] * norms[j]) for i in members[ga] for j in members[gb] if i != j]
        assert v == pytest.approx(float(np.mean(vals)) if vals else 0.0, abs=1e-9)


@SETTINGS
@given(seed=st.integers(0, 10_000), max_hot=st.integers(1, 5), how=st.sampled_from(["inner", "left"]))
def test_split_hot_join_equals_plain_join(spark, seed, max_hot, how):
    rng = np.random.default_rng(seed)
    keys = [f"k{int(v)}" for v in rng.zipf(1.6, 200) % 12]
    big = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, key string")
    small = spark.createDataFrame([(f"k{i}", float(i)) for i in range(0, 12, 2)], "key string, v double")
    counts = big.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    a = sorted(repr(sorted(r.asDict().items())) for r in
               split_hot_join(big, small, "key", counts, big.count(), how=how, max_hot=max_hot).collect())
    b = sorted(repr(sorted(r.asDict().items())) for r in big.join(small, "key", how).collect())
    assert a == b
