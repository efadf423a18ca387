import json

from quarry.sources import readers as R
from quarry.sources import sinks as W


def test_category_dictionary_and_stopwords(spark, tmpdir_path):
    p = f"{tmpdir_path}/dict.csv"
    with open(p, "w") as f:
        f.write("Entry;Source;Positiv\nABIDE;H4;Positiv\nABLE#1;H4;Positiv\nABLE#2;H4;Positiv\nZEAL#12;H4;\n")
    assert sorted(r.term for r in R.read_category_dictionary(spark, p).collect()) == ["abide", "able", "zeal"]
    s = f"{tmpdir_path}/stop.txt"
    with open(s, "w") as f:
        f.write("a\nan\nthe\nthe\nourselves\n")
    assert sorted(r.term for r in R.read_stopwords(spark, s).collect()) == ["ourselves", "the"]
    assert sorted(r.term for r in R.read_stopwords(spark, s, stem=True).collect()) == ["ourselv", "the"]


def test_speech_json_roundtrip_and_whole_file_read(spark, tmpdir_path):
    text = 'Line one.' + chr(10) + 'Line "two".'
    p = f"{tmpdir_path}/speech.txt"
    with open(p, "w") as f:
        f.write(json.dumps(["1977", "Somebody", text]))
    r = R.read_json_speeches(spark, p).first()
    assert (r.year, r.author, r.text) == (1977, "Somebody", text)
    df = spark.createDataFrame([(1990, "A", "x"), (1991, "B", "y")], "year int, author string, text string")
    W.write_speeches_json(df, f"{tmpdir_path}/out", positional=True)
    back = spark.read.text(f"{tmpdir_path}/out").select(*R.parse_json_speech("value"))
    assert sorted(tuple(x) for x in back.collect()) == [(1990, "A", "x"), (1991, "B", "y")]


def test_results_csv_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([(3, 0, 0.18492656751, 0.0929481245595, 0.13153784329)], R.RESULTS_SCHEMA)
    W.write_results_csv(df, f"{tmpdir_path}/res")
    back = R.read_results_csv(spark, f"{tmpdir_path}/res").first()
    assert tuple(back) == (3, 0, 0.18492656751, 0.0929481245595, 0.13153784329)
