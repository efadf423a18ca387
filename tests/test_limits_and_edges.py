"""Inputs on both sides of former limits, and shapes that regular inputs never have."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import dates as D
from quarry.functions import html as H
from quarry.functions import numeric as N
from quarry.functions import text as T
from quarry.operators import features as FE
from quarry.operators import html_text as HT
from quarry.operators import ingest as I
from quarry.operators import lexicon as L
from quarry.operators import similarity as SIM


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_right_justify_never_cuts(spark):
    assert one(spark, "abc", lambda v: T.right_justify(v, 15)) == " " * 12 + "abc"
    assert one(spark, "x" * 26, lambda v: T.right_justify(v, 15)) == "x" * 26


def test_single_match_over_lines(spark):
    assert one(spark, "Price: 1\n2 end", lambda v: T.regex_single_match(v, "Price: (.*) end")) == "1\n2"
    assert one(spark, "a\nb=3\nc", lambda v: T.regex_single_match(v, "^b=(.)$")) == "3"


def test_html_attributes_quotes_and_several_articles(spark):
    assert one(spark, "<p class='x'>a</p><p>b</p><pre>c</pre>", H.paragraphs) == ["a", "b"]
    assert one(spark, """<a href='/x'>1</a><a HREF = "/y">2</a>""", H.links) == ["/x", "/y"]
    assert one(spark, "<article>a</article><p>no</p><article id=2>b</article>", H.main_text) == "a b"


def test_dates_need_their_suffix_unless_asked(spark):
    for text, strict, bare in (("4 June 1996 (3 days ago)", "1996-06-04", "1996-06-04"), ("4 June 1996", None, "1996-06-04"), ("31/12/1999 x", "1999-12-31", "1999-12-31"),
                               ("Yesterday", "2001-07-31", "2001-07-31"), ("rubbish", None, None), (None, None, None)):
        got = [str(r) if (r := one(spark, text, lambda v, b=b: D.parse_flexible_date(v, "2001-08-01", b))) else None for b in (False, True)]
        assert got == [strict, bare], text


def test_train_fraction_of_any_id(spark):
    df = spark.createDataFrame([(2**62,), (-5,), (None,), (7,)], "id long").select(N.train_fraction("id").alias("u"))
    assert all(r["u"] is None or 0 <= r["u"] < 1 for r in df.collect())
    mean = spark.range(5000).select(F.avg(N.train_fraction("id"))).first()[0]
    assert 0.48 < mean < 0.52


def test_stopwords_either_side_of_the_inline_limit(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (1, ["c", "a"]), (2, None), (3, []), (4, ["a"])], "doc_id long, tokens array<string>")
    stop = spark.createDataFrame([("a",), ("z",)], "term string")
    rows = [sorted(map(str, L.stopword_remove(docs, stop, inline=n).collect())) for n in (50_000, 1)]
    assert rows[0] == rows[1] and len(rows[0]) == 5


def test_stemming_keeps_rows_of_one_id_apart(spark):
    from quarry.functions.stemmer import stem_token_arrays

    docs = spark.createDataFrame([(1, ["running"]), (1, ["cats", "dogs"])], "doc_id long, tokens array<string>")
    assert sorted(r["tokens"] for r in stem_token_arrays(docs).collect()) == [["cat", "dog"], ["run"]]


@pytest.mark.parametrize("most", [16, 1])
def test_rows_without_a_group_are_in_none(spark, monkeypatch, most):
    monkeypatch.setattr(SIM, "MAX_PIVOT_GROUPS", most)
    unit = spark.createDataFrame([(1, "a", 1.0), (2, "a", 1.0), (3, "b", 1.0)], "doc_id long, term string, u double")
    groups = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "doc_id long, grp string")
    got = {(r["group_a"], r["group_b"]): r["mean_cos"] for r in SIM.group_cosine(unit, groups).collect()}
    assert got == {("x", "x"): 0.0, ("x", "y"): 1.0, ("y", "x"): 1.0, ("y", "y"): 0.0}


def test_pair_cosine_of_missing_and_equal_ids(spark):
    unit = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.8), (2, "a", 1.0), (4, "z", 1.0)], "doc_id long, term string, u double")
    pairs = spark.createDataFrame([(1, 2), (1, 1), (1, 3), (1, 4), (1, 2)], "a long, b long")
    got = {(r["a"], r["b"]): r["cosine"] for r in SIM.pair_cosine(unit, pairs, "a", "b").collect()}
    assert got == {(1, 2): pytest.approx(0.6), (1, 1): pytest.approx(1.0), (1, 3): None, (1, 4): 0.0}


def test_more_cities_than_were_once_allowed(spark):
    cities = [("London", 51.5, -0.1, 600.0)] + [(f"c{i}", 40.0 + (i % 40) * 0.5, -20.0 + (i // 40) * 0.7, float(i % 97 + 1)) for i in range(1500)]
    cdf = spark.createDataFrame(cities, "name string, lat double, long double, sq_mi double")
    points = [(i, 40.0 + (i * 37 % 2000) / 100.0, -20.0 + (i * 53 % 2600) / 100.0) for i in range(300)] + [(900, None, 1.0), (901, 51.5, -0.1)]
    got = {r["id"]: (r["is_home"], r["near_other_city"]) for r in FE.geo_flags(spark.createDataFrame(points, "id long, latitude double, longitude double"), cdf).collect()}
    radii = {r["name"]: (r["lat"], r["long"], r["radius_deg"]) for r in FE.city_radii(cdf).collect()}
    inside = lambda x, y, c: ((x - c[0]) ** 2 + (y - c[1]) ** 2) ** 0.5 < c[2]
    for i, x, y in points:
        want = (None, None) if x is None else (inside(x, y, radii["London"]), any(inside(x, y, c) for n, c in radii.items() if n != "London"))
        assert got[i] == want


def test_upsert_with_repeated_update_keys(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    upd = spark.createDataFrame([(1, "x", 1), (1, "c", 2), (3, "q", 1)], "id long, v string, at int")
    assert sorted(map(tuple, I.upsert_by_key(base, upd, "id", ["v"], "at").collect())) == [(1, "c"), (2, "b")]


def test_observations_at_one_time(spark):
    obs = spark.createDataFrame([(1, 5, "let"), (1, 5, "gone"), (1, 9, "let"), (2, 3, "let")], "id long, ts long, kind string")
    for parts in (1, 3):
        got = {r["id"]: (r["removed"], r["let_agreed"]) for r in I.status_refresh(obs.repartition(parts), "id", "ts", F.col("kind") == "gone", F.col("kind") == "let").collect()}
        assert got == {1: (True, False), 2: (False, True)}


def test_labels_and_values_of_any_length(spark):
    long = "v" * 500
    page = f"<ul><li>Letting type: Long &amp; short</li><li>{'k' * 90}:{long}</li><li>letting  type: last</li><li>empty: </li></ul>"
    rows = HT.label_values(spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string"), [r"(?s)>\s*([^<>:]*[^<>:\s])\s*:\s*([^<>]*[^<>\s])\s*<"]).collect()
    assert {(r["page_id"], r["label"]): r["value"] for r in rows} == {(1, "letting type"): "last", (1, "k" * 90): long}


def test_stream_skips_known_and_quarantines(spark, tmpdir_path):
    from quarry.streaming.ingest import ingest_stream

    schema = "id long, at long, v string"
    drop = lambda n, rows: spark.createDataFrame(rows, schema).write.parquet(f"{tmpdir_path}/src/drop={n}")
    kind = spark.createDataFrame([], schema).schema
    args = (f"{tmpdir_path}/src/drop=*", kind, f"{tmpdir_path}/sink", f"{tmpdir_path}/ckpt", "id", "at", spark.createDataFrame([(9,)], "id long"),
            {"no_value": F.col("v").isNull()})
    drop(1, [(1, 2, "late"), (1, 1, "first"), (2, 1, None), (9, 1, "known")])
    good, bad = ingest_stream(spark, *args)
    assert [tuple(r) for r in good.collect()] == [(1, 1, "first")] and [(r["id"], r["reason"]) for r in bad.collect()] == [(2, "no_value")]
    drop(2, [(1, 0, "again"), (2, 5, "mended"), (3, 1, "new")])
    good, bad = ingest_stream(spark, *args)
    assert sorted(r["id"] for r in good.collect()) == [1, 3] and [r["id"] for r in bad.collect()] == [2]
