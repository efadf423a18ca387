"""Operator 7 against a plain Python rendering of the same definition."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from quarry.llm import orderhash as oh


def hashes(spark, values):
    """Spark's xxhash64 of long pairs, looked up in one job."""
    rows = spark.createDataFrame(sorted(values), "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()
    return {(r["a"], r["b"]): r["h"] for r in rows}


def test_kmers_are_numbered_and_ordered(spark, table):
    """The occurrence numbers and text order that the arrays carry."""
    text = "a b a b a c a b"
    row = table([(text,)], "t string").select(oh.kmers(F.col("t")).alias("k"), oh.let(oh.kmers(F.col("t")), oh.numbered).alias("e")).first()
    pairs = list(zip(text.split(), text.split()[1:]))
    positions = sorted(x & oh.POSITION for x in row["k"])
    assert positions == list(range(len(pairs)))
    by_position = {x & oh.POSITION: x >> oh.POSITION_BITS for x in row["k"]}
    assert all((by_position[i] == by_position[j]) == (pairs[i] == pairs[j]) for i in range(7) for j in range(7))
    assert sorted(x & oh.POSITION for x in row["e"]) == positions
    assert len({x >> oh.POSITION_BITS for x in row["e"]}) == len(pairs)  # all occurrences differ now
    assert row["e"] == sorted(row["e"])


def test_sketch_takes_the_smallest_in_each_order(spark, table):
    rnd = random.Random(1)
    e = sorted((rnd.getrandbits(64) - (1 << 63)) & ~oh.POSITION | i for i in range(50))
    got = table([(e,)], "e array<bigint>").select(oh.sketch(F.col("e")).alias("s")).first()["s"]
    picks = []
    for j in range(oh.SKETCHES):
        edge = (j << (64 - oh.ARC_BITS)) - (1 << 63)
        ring = sorted(e, key=lambda x: (x < edge, x))[: oh.TUPLE]
        picks.append([(x % (1 << 64)) >> oh.POSITION_BITS for x in sorted(ring, key=lambda x: x & oh.POSITION)])
    first = hashes(spark, {(0, p[0]) for p in picks})
    second = hashes(spark, {(first[0, p[0]], p[1]) for p in picks})
    assert got == [second[first[0, p[0]], p[1]] & 0xFFFFFFFF for p in picks]


def test_order_counts(table):
    """The same pairs of words in another order are less alike than the same text, and edits cost by their size."""
    rnd = random.Random(2)
    w = [f"w{rnd.randrange(500)}" for _ in range(400)]
    blocks = [w[i:i + 20] for i in range(0, 400, 20)]
    swapped = [x for b in blocks[::-1] for x in b]
    light, heavy = list(w), list(w)
    for k in (3, 200):
        light[k] = "new"
    for k in range(0, 400, 8):
        heavy[k] = "new"
    texts = [" ".join(x) for x in (w, w, light, heavy, swapped)]
    df = table([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", oh.order_minhash(F.col("t")).alias("e"))
    base = df.where("i = 0").select(F.col("e").alias("b"))
    like = {r["i"]: r["l"] for r in df.crossJoin(F.broadcast(base)).select("i", oh.likeness(F.col("e"), F.col("b")).alias("l")).collect()}
    assert like[1] == 1 and like[1] > like[2] > like[3] and like[4] < 0.75


def test_next_document(awkward, table, monkeypatch):
    for rows in (7, 2048):
        monkeypatch.setattr(oh, "RUN_ROWS", rows)
        docs = table([(i * 3, f"t{i}") for i in range(100)], "doc_id long, text string")
        got = {r["doc_id"]: r["n"] for r in oh.next_in_order(docs, "doc_id", {"text": "n"}).collect()}
        assert got == {i * 3: f"t{(i + 1) % 100}" for i in range(100)}
    one = table([(1, "only")], "doc_id long, text string")
    assert oh.next_in_order(one, "doc_id", {"text": "n"}).first()["n"] == "only"
    assert oh.next_in_order(one.where("doc_id = 2"), "doc_id", {"text": "n"}).collect() == []
    assert oh.next_in_order(awkward, "doc_id", {"text": "n"}).count() == awkward.count()


def test_fingerprints_of_awkward_rows(awkward, no_documents):
    rows = oh.fingerprints(awkward).select("doc_id", "text", oh.as_string(F.col("entries")).alias("f"), "next_text").collect()
    assert len(rows) == awkward.count()
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"], r["f"]) == r["f"]
        assert re.fullmatch(r"([0-9a-f]{256})?", r["f"]) and bool(r["f"]) == bool(r["text"].strip())
    assert oh.fingerprints(no_documents).collect() == []


def test_query(spark):
    from quarry.llm.q_fingerprint import op7_order_minhash

    sf = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = {r["doc_id"]: r for r in op7_order_minhash(spark, sf).collect()}
    for i, (d, t) in enumerate(docs):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + docs[(i + 1) % len(docs)][1][:cut]
        assert rows[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and rows[d]["n_chars"] == len(t)
    assert sum(r["near_edited"] > r["near_next"] for r in rows.values()) > 0.95 * len(rows)


def test_no_python_runs(spark):
    from quarry.llm.q_fingerprint import op7_order_minhash
    from quarry.llm.q_mixing import op3_mix_sources

    for q in (op7_order_minhash, op3_mix_sources):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
