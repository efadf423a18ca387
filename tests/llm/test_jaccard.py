"""Operator 1 against all pairs of whole shingle sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import jaccard


def brute(docs):
    """``(doc_id, class_id, n_links, n_texts)`` of each row by comparing all rows."""
    sets = []
    for _, t in docs:
        w = (t or "").split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    linked = [[k for k in range(len(docs)) if k != i and len(sets[i] & sets[k]) >= 0.8 * len(sets[i] | sets[k]) - 1e-9] for i in range(len(docs))]
    root = list(range(len(docs)))
    for _ in docs:
        root = [min([root[i], *(root[k] for k in linked[i])]) for i in range(len(docs))]
    out = []
    for i, (d, t) in enumerate(docs):
        ids = [docs[k][0] for k in range(len(docs)) if root[k] == root[i] and docs[k][0] is not None]
        out.append((d, min(ids) if ids else None, len(linked[i]), len({docs[k][1] or "" for k in linked[i]} - {t or ""})))
    return out


def found(df):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"], r["n_texts"]) for r in jaccard.similar_classes(df).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    """Groups of copies and of near copies around and above the threshold, and unlike texts."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: [rnd.choice(words) for _ in range(n)]
    docs = []
    for size, copies, edits in ((120, 12, 2), (60, 40, 1), (200, 6, 5), (30, 8, 1), (90, 25, 3)):
        base = text(size)
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randint(0, edits)):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            docs.append(" ".join(w))
    docs += [" ".join(text(rnd.randint(1, 80))) for _ in range(60)] + ["", " ", None, "a b", "a  b", "a b c"]
    rnd.shuffle(docs)
    return list(enumerate(docs))


def test_all_links(table, corpus):
    assert found(table(corpus, "doc_id long, text string")) == sorted(brute(corpus), key=str)


def test_blocks_of_any_size_give_the_same(table, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 7)
    monkeypatch.setattr(jaccard, "PAIRS", 50)
    monkeypatch.setattr(jaccard, "COLUMNS", 16)
    assert found(table(corpus, "doc_id long, text string")) == sorted(brute(corpus), key=str)


def test_passages_repeated_inside_a_text(table):
    """Similarity is one of sets: how often a text says a passage does not count."""
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for size in (200, 120, 45, 9):
        w = [rnd.choice(words) for _ in range(size)]
        docs += [" ".join(w * times) for times in (1, 2, 3, 7)] + [" ".join(w * 2 + [rnd.choice(words) for _ in range(6)])]
    docs += [" ".join(["buy now"] * times) for times in (3, 4, 9, 40, 500)]
    rnd.shuffle(docs)
    docs = list(enumerate(docs))
    want = sorted(brute(docs), key=str)
    assert sum(links for _, _, links, _ in want) > 50
    assert found(table(docs, "doc_id long, text string")) == want


def test_set_sizes():
    passage = " ".join(f"w{i}" for i in range(200))
    _, n = jaccard.signatures([passage, f"{passage} {passage}", "buy now " * 50, None, "a b"])
    assert n.tolist() == [196, 200, 2, 0, 1]


def test_awkward_rows(awkward, no_documents):
    docs = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert found(awkward) == sorted(brute(docs), key=str)
    assert found(no_documents) == []


def test_one_row_of_each_class_stays(awkward, table, corpus):
    kept = jaccard.keep_first(awkward).collect()
    assert {r["sig"] for r in kept} == {"sig"}
    classes = {(r[1] if r[1] is not None else (r[0], "nameless")) for r in brute([(r["doc_id"], r["text"]) for r in awkward.collect()])}
    assert len(kept) == len(classes)
    rows = jaccard.keep_first(table(corpus, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted({c for _, c, _, _ in brute(corpus)})


def test_one_id_with_unlike_texts(table):
    rows = table([(5, "a b c d e f g h"), (5, "q r s t u v w x"), (6, "q r s t u v w x")], "doc_id long, text string")
    assert sorted(r["text"][0] for r in jaccard.keep_first(rows).collect()) == ["a", "q"]


def test_pruning_bound():
    least = jaccard.least_matches()
    assert list(least) == list(range(16, 97, 16))
    assert all(least[n] < 0.8 * n for n in least) and least[96] > 48
    rng = np.random.default_rng(2)
    draws = rng.binomial(96, 0.8, 200_000)
    assert (draws < least[96]).mean() < 1e-4


def test_intersections_both_ways():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, 30).astype(np.uint64)) for _ in range(12)]
    a, b = map(np.array, zip(*[(x, y) for x in range(12) for y in range(x)]))
    want = [len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b)]
    assert jaccard.shared(sets, a, b).tolist() == want
    assert jaccard.shared(sets, a[:5], b[:5]).tolist() == want[:5]


def test_components(table):
    rnd = random.Random(9)
    edges = [(f"{i:03d}", f"{rnd.randrange(max(1, i - 9), i + 1) if i % 17 else i:03d}") for i in range(400)]
    rows = {r["key"]: r["root"] for r in jaccard.components(table(edges, "key string, other string")).collect()}
    root = {k: k for e in edges for k in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    names = {}
    for k, r in rows.items():
        assert names.setdefault(root[k], r) == r
    assert len(set(names.values())) == len(names)


def test_signatures_estimate_similarity():
    base = [f"w{i}" for i in range(400)]
    sig, n = jaccard.signatures([" ".join(base), " ".join(base[:380]), None, "a b"])
    assert n.tolist() == [396, 376, 0, 1]
    assert abs((sig[0] == sig[1]).mean() - 376 / 396) < 0.12
    assert (sig[2] == 0xFFFFFFFF).all()


def test_result_columns(table):
    df = jaccard.similar_classes(table([(1, "x")], "doc_id int, text string"))
    assert df.select(F.typeof("doc_id")).first()[0] == "bigint"
