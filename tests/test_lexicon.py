import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import lexicon as L

TINY = [("good", 3), ("rainy", -1), ("bad", -3), ("bad", -2), ("can't stand", -3), ("mood", 0)]


def _docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("doc_id", T.word_tokens("text").alias("tokens"))


def test_sentiment_mean_over_recognised(spark):
    lex = L.lexicon_from_pairs(spark, TINY)
    docs = _docs(spark, [(1, "Rainy day but still in a good mood"), (2, "nothing here"), (3, None),
                         (4, "bad bad"), (5, "I can't stand it")])
    out = {r.doc_id: r for r in L.lexicon_sentiment(docs, lex).collect()}
    assert (out[1].n_recognised, out[1].score_sum) == (3, 2)
    assert out[1].score_mean == pytest.approx(2 / 3)
    assert (out[2].n_recognised, out[2].score_sum, out[2].score_mean) == (0, 0, None)  # q7
    assert out[3].score_sum == 0
    assert out[4].score_sum == -4  # last duplicate wins (q18)
    assert out[5].n_recognised == 0  # phrases never match single tokens (q19)


def test_read_lexicon_last_wins(spark, tmpdir_path):
    from quarry.sources.readers import read_lexicon

    p = f"{tmpdir_path}/lex.txt"
    with open(p, "w", encoding="utf-8") as f:
        f.write("good\t3\nbad\t-3\ncan't stand\t-3\nbad\t-2\nété\t1\n")
    got = {r.term: r.valence for r in read_lexicon(spark, p).collect()}
    assert got == {"good": 3, "bad": -2, "can't stand": -3, "été": 1}


def test_polarity_subjectivity(spark):
    cats = spark.createDataFrame([("good", 1), ("bad", -1)], "term string, polarity int")
    docs = _docs(spark, [(1, "good good bad x"), (2, "")])
    out = {r.doc_id: r for r in L.polarity_subjectivity(docs, cats).collect()}
    assert (out[1].n_pos, out[1].n_neg, out[1].n_tokens) == (2, 1, 4)
    assert out[1].polarity == pytest.approx(1 / 3, rel=1e-5)
    assert out[1].subjectivity == pytest.approx(3 / 4, rel=1e-5)
    assert out[2].n_tokens == 0 and out[2].polarity == 0


def test_stopwords_inline_and_large(spark, monkeypatch):
    docs = _docs(spark, [(1, "the cat and the hat"), (2, None)])
    stop = spark.createDataFrame([("the",), ("and",)], "term string")
    got = {r.doc_id: r.tokens for r in L.stopword_remove(docs, stop).collect()}
    monkeypatch.setattr(L, "INLINE_STOPWORDS", 1)
    got2 = {r.doc_id: r.tokens for r in L.stopword_remove(docs, stop).collect()}
    assert got == got2 == {1: ["cat", "hat"], 2: None}


def test_dict_rank_keeps_zero_scores_and_ties(spark):
    m = spark.createDataFrame([(1, "a", 2.0), (2, "a", 2.0), (3, "b", 5.0)], "doc_id long, term string, w double")
    docs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "doc_id long")
    dic = spark.createDataFrame([("a",)], "term string")
    r = [(x.doc_id, x.score, x.rank) for x in L.dict_rank(m, dic, docs, "w", n=4).collect()]
    assert r == [(1, 2.0, 1), (2, 2.0, 2), (3, 0.0, 3), (4, 0.0, 4)]


def test_dict_rank_stem_dictionary(spark):
    m = spark.createDataFrame([(1, "poni", 1.0), (2, "cat", 1.0)], "doc_id long, term string, w double")
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    dic = spark.createDataFrame([("ponies",)], "term string")
    plain = [(r.doc_id, r.score) for r in L.dict_rank(m, dic, docs, "w", n=2).collect()]
    stemmed = [(r.doc_id, r.score) for r in L.dict_rank(m, dic, docs, "w", n=2, stem_dictionary=True).collect()]
    assert plain == [(1, 0.0), (2, 0.0)]  # unstemmed dictionary misses stemmed terms (q2)
    assert stemmed == [(1, 1.0), (2, 0.0)]


def test_speech_tokens_stopword_modes(spark):
    from quarry.operators.cleaning import speech_tokens

    docs = spark.createDataFrame([(1, "We ourselves were running, ourselves!")], "doc_id long, text string")
    stop = spark.createDataFrame([("ourselves",), ("were",)], "term string")
    default = speech_tokens(docs, stop=stop).first().tokens
    compat = speech_tokens(docs, stop=stop, stem_stopwords=True).first().tokens  # q1
    after = speech_tokens(docs, stop=stop, stopword_stage="after", stem_stopwords=True).first().tokens
    assert default == ["run"]
    assert compat == ["ourselv", "run", "ourselv"]  # "ourselves" escapes its stemmed entry; "were" is its own stem
    assert after == ["run"]


def test_phrase_matching_option(spark):
    lex = L.lexicon_from_pairs(spark, [("stand", 1), ("can't stand", -3), ("good", 3)])
    df = spark.createDataFrame([(1, "i can't stand it good")], "doc_id long, text string")
    docs = df.select("doc_id", T.preprocess_chars("text").alias("tokens"))
    off = L.lexicon_sentiment(docs, lex).first()
    on = L.lexicon_sentiment(docs, lex, phrases=True).first()
    assert (off.n_recognised, off.score_sum) == (2, 4)
    assert (on.n_recognised, on.score_sum) == (3, 1)


def test_phrase_matching_short_docs(spark):
    lex = L.lexicon_from_pairs(spark, [("good", 3), ("very good", 1)])
    df = spark.createDataFrame([(1, "good"), (2, ""), (3, None), (4, "very good")], "doc_id long, text string")
    docs = df.select("doc_id", T.preprocess_chars("text").alias("tokens"))
    got = {r.doc_id: r.score_sum for r in L.lexicon_sentiment(docs, lex, phrases=True).collect()}
    assert got == {1: 3, 2: 0, 3: 0, 4: 4}


def test_large_lexicon_path_equals_broadcast_path(spark):
    lex = L.lexicon_from_pairs(spark, TINY)
    docs = _docs(spark, [(1, "good good bad rainy"), (2, "nothing"), (3, None)])
    toks = docs.select("doc_id", F.explode_outer("tokens").alias("term"))
    a = sorted(repr(sorted(r.asDict().items())) for r in L.join_lexicon(toks, lex, "left").collect())
    b = sorted(repr(sorted(r.asDict().items())) for r in L.join_lexicon(toks, lex, "left", max_rows=1).collect())
    assert a == b and len(a) == 6
