"""Operators 3, 4 and 5 against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing, sharding, urls
from quarry.llm.q_urls import RULES


def fill(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """Targets by plain repeated sharing."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level >= most * sizes[s]}
        if not full:
            out |= {s: w[s] * level for s in open_}
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.fixture(scope="module")
def sized(table):
    rng = np.random.default_rng(5)
    rows = [(i, ["a", "b", "é", "Z", None][min(4, int(rng.exponential()))], int(rng.integers(0, 400))) for i in range(2000)]
    return table(rows, "doc_id long, source string, size long")


def test_targets(sized):
    sizes = {r["source"]: r["s"] for r in sized.groupBy("source").agg(F.sum("size").alias("s")).collect()}
    got = {r["source"]: r["target"] for r in mixing.source_targets(sized).collect()}
    assert got == pytest.approx(fill(sizes))
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_words_taken(sized):
    rows = mixing.mix(sized).collect()
    assert len(rows) == 2000
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        taken = sum(r["copies"] * r["size"] for r in own)
        rate = own[0]["target"] / own[0]["source_size"]
        assert abs(sum(r["copies"] for r in own) - rate * len(own)) <= 1
        assert abs(taken - own[0]["target"]) <= 2 * max(r["size"] for r in own)
        assert {r["copies"] for r in own} <= {int(rate), int(np.ceil(rate))} and max(r["copies"] for r in own) <= 2
    again = {r["doc_id"]: r["copies"] for r in mixing.mix(sized.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in rows}


def test_systematic_line(sized):
    """Copies are the whole numbers that the shifted running sum crosses."""
    rows = [r for r in mixing.mix(sized).collect() if r["source"] == "a"]
    rows.sort(key=lambda r: (r["size"], r["doc_id"]))
    rate = rows[0]["target"] / rows[0]["source_size"]
    total = np.cumsum([r["copies"] for r in rows])
    assert np.abs(total - rate * np.arange(1, len(rows) + 1)).max() <= 1


def test_emit_and_awkward_rows(awkward):
    sized = awkward.withColumn("size", mixing.word_count("text"))
    mixed = mixing.mix(sized)
    assert mixed.count() == awkward.count()
    out = mixing.emit(mixed)
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]
    assert "target" not in out.columns and "shard" in out.columns


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.mix(empty).collect() == []
    blank = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert [r["copies"] for r in mixing.mix(blank).collect()] == [0, 0]


def test_word_count(table):
    texts = [None, "", " a\tb\x0bc\n", "été   x", " one two"]
    got = {r["t"]: r["n"] for r in table([(t,) for t in texts], "t string").select("t", mixing.word_count("t").alias("n")).collect()}
    assert got == {t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts}


def slow_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 3000, dtype=np.int64)
    for shards in (1, 2, 24, 1000):
        assert sharding.jump(keys, shards).tolist() == [slow_jump(int(k) % 2**64, shards) for k in keys]
    assert sharding.jump(np.array([], np.int64), 5).tolist() == []


def test_shards_grow_only_into_the_new_one(table):
    rows = table([(i, "t") for i in range(5000)], "doc_id long, text string")
    got = sharding.with_slots(sharding.assign_shards(rows, shards=24)).collect()
    assert all(r["grown_shard"] in (r["shard"], 24) for r in got)
    assert 100 < sum(r["grown_shard"] == 24 for r in got) < 320
    for s in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_shards_of_awkward_rows(spark, awkward, no_documents, tmp_path):
    got = sharding.with_slots(sharding.assign_shards(awkward, shards=3)).collect()
    assert len(got) == awkward.count() and {r["sig"] for r in got} == {"sig"}
    assert len({(r["shard"], r["slot"]) for r in got}) == len(got)
    assert len({r["shard"] for r in got if r["doc_id"] == 8}) == 1
    hot = awkward.sparkSession.createDataFrame([(1, "same")] * 500, "doc_id long, text string")
    assert sorted(r["slot"] for r in sharding.with_slots(sharding.assign_shards(hot)).collect()) == list(range(500))
    assert sharding.with_slots(sharding.assign_shards(no_documents)).collect() == []
    sharding.write_shards(sharding.assign_shards(awkward, shards=3).select("doc_id", "text", "shard"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(got)
    with pytest.raises(ValueError):
        sharding.assign_shards(awkward, shards=0)


def judge(url, rules):
    """Every rule tried on every URL."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for verdict, rule in rules:
        h, _, p = rule.partition("/")
        body = ".*".join(map(re.escape, ("/" + p).split("*")))
        if (not h or host == h or host.endswith("." + h)) and re.match(body, path, re.S):
            fits.append((len(rule), verdict, rule))
    _, verdict, rule = max(fits, default=(0, "allow", None))
    return host, path, rule, verdict


URLS = ["http://example.org/es/1", "https://a.b.Example.ORG/es/x?q#f", "http://notexample.org/es/", "http://example.org/en/12", "http://example.org/en/2",
        "http://x.com/fr/", "http://x.com/FR/", "http://com/de/a", "http://x.com", "http://x.org", "http://x.org?/", "no scheme", "", None, "://", "a://b/://c.org/",
        "http://example.org/es/1", "http://x.org:80/", "http://é.com/fr/\nü", "http://ads.net/a/track/b", "http://q.net/z/track", "http://.org/"]


def test_url_rules(table):
    rules = [*RULES, ("block", "/a/*/b"), ("allow", "ads.net/"), ("block", "ads.net/"), ("block", "net/z/trac"), ("block", "*zzz*")]
    pages = table([(i, u, "mine") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    for some in (RULES, rules):
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.url_filter(pages, some).collect()}
        assert got == {i: judge(u, some) for i, u in enumerate(URLS)}


def test_url_rules_on_nothing(spark, table):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.url_filter(empty, RULES).collect() == []
    repeated = table([(1, "http://a.org/")] * 40, "page_id long, url string")
    assert {(r["rule"], r["verdict"]) for r in urls.url_filter(repeated, RULES).collect()} == {("org/", "allow")}
    assert urls.url_filter(repeated, RULES).count() == 40


def test_rules_are_filed_under_their_rarest_token(table):
    pages = table([("common.org", "/es/"), ("common.org", "/en/"), ("rare.org", "/en/")], "host string, path string")
    index = {r["rule"]: r["token"] for r in urls.rule_index([("block", "common.org/es/"), ("allow", "rare.org/en/")], pages).collect()}
    assert index == {"common.org/es/": "p:es", "rare.org/en/": "h:rare"}
    assert urls.literal_tokens("example.org/en/1") == ["h:example", "h:org", "p:en"]
