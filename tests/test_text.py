from pyspark.sql import functions as F

from quarry.functions import text as T


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_tokenizers_tiny_docs(spark):
    rows = [(1, "Hello, world! Hello"), (2, ""), (3, None), (4, "Hello, world! Hello"), (5, "été naïve")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in df.select("doc_id", T.wordpunct_tokens("text").alias("wp"),
                                           T.word_tokens("text").alias("w")).collect()}
    assert out[1].wp == ["Hello", ",", "world", "!", "Hello"]
    assert out[1].w == ["hello", "world", "hello"]
    assert out[2].w == []
    assert out[3].w is None
    assert out[4].w == out[1].w
    assert out[5].w == ["été", "naïve"]  # Unicode letters are word characters


def test_preprocess_chars_and_regex(spark):
    s = 'The "quick": fox; [jumps] - over $5?'
    assert _one(spark, T.preprocess_chars("s"), s) == ["the", "quick", "fox", "jumps", "over", "5"]
    assert _one(spark, T.preprocess_regex("s"), "a-b  c\nd") == ["a", "b", "c", "d"]


def test_token_filters(spark):
    toks = ["ab", "abc", "été", "a1b", "hello", "x_y"]
    df = spark.createDataFrame([(toks,)], "t array<string>")
    r = df.select(T.token_clean("t", 2).alias("c"), T.drop_digit_tokens("t").alias("d"),
                  T.ascii_fold_tokens(F.array(F.lit("-été_"), F.lit("__"), F.lit(" ok "))).alias("f")).first()
    assert r.c == ["abc", "été", "hello"]
    assert r.d == ["ab", "abc", "été", "hello", "x_y"]
    assert r.f == ["t", "ok"]  # empties dropped (q16)


def test_min_length_gate(spark):
    df = spark.createDataFrame([(["a"] * 11,), (["a"] * 12,)], "t array<string>")
    r = [x.g for x in df.select(T.min_length_gate("t", 12).alias("g")).collect()]
    assert r[0] is None and len(r[1]) == 12


def test_regex_single_match_and_prices(spark):
    rows = [("1,200 pcm",), ("300 pw",), ("900 pcm or 1,000 pcm",), ("no price",)]
    df = spark.createDataFrame(rows, "s string")
    got = [(r.pcm, r.pw) for r in df.select(T.parse_price("s", "pcm").alias("pcm"), T.parse_price("s", "pw").alias("pw")).collect()]
    assert got == [(1200, None), (None, 300), (None, None), (None, None)]


def test_url_param_and_clean_string(spark):
    assert _one(spark, T.url_param("s", "lat"), "http://x/map?lat=51.5&lng=-0.1") == 51.5
    assert _one(spark, T.url_param("s", "lat"), "http://x/map?lat=1&lat=2") is None
    assert _one(spark, T.clean_string("s"), None) == ""
    assert _one(spark, T.clean_string("s"), "it's \"x\"") == "its x"


def test_text_bar_friendly_and_suffix(spark):
    assert _one(spark, T.text_bar("v"), 100.0, "v double") == "***"
    assert _one(spark, T.text_bar("v"), -50.0, "v double") == ""
    df = spark.createDataFrame([(1977, "Ford", "Mr. Speaker, Mr. Vice President")], "y int, a string, t string")
    assert df.select(T.friendly_string("y", "a", "t")).first()[0] == "1977 Ford r. Speaker, Mr. Vic"
    assert _one(spark, T.strip_dictionary_suffix("s"), "ABIDE#12") == "abide"
