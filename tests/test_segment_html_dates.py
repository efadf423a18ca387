import datetime

from pyspark.sql import functions as F

from quarry.functions import dates as D
from quarry.functions import html as H
from quarry.operators import segment as G
from quarry.operators.html_text import page_blocks
from quarry.sources.readers import read_corpus_text

SPEECHES = ("**********_1790_x_George_Washington_***\nFirst line\n\nsecond para\n\n\n"
            "**********_1791_x_John_Adams_***\nAnother speech\n\n\n"
            "**********_1792_x_Thomas_Jefferson_***\nLast speech without trailing newlines")


def test_corpus_read_keeps_last_speech(spark, tmpdir_path):
    p = f"{tmpdir_path}/corpus.txt"
    with open(p, "w") as f:
        f.write(SPEECHES)
    recs = read_corpus_text(spark, p)
    out = G.segment_records(recs, pattern=r"(?s)^(\d{4})_([^_]*)_(.+?)_\*+\n(.*)$").orderBy("year").collect()
    assert [r.year for r in out] == ["1790", "1791", "1792"]  # q3 / q4
    assert out[0].author == "George_Washington"
    assert out[0].text == "First line  second para"  # newlines become spaces (q5), trimmed
    assert out[2].text == "Last speech without trailing newlines"


def test_segment_by_header(spark):
    lines = [(1, 0, "intro", False), (1, 1, "HEAD_one", True), (1, 2, " a \n\n b", False), (1, 3, "HEAD two", True),
             (2, 0, "HEAD x", True)]
    df = spark.createDataFrame(lines, "f long, n long, text string, h boolean")
    out = {(r.f, r.seg_start): r for r in G.segment_by_header(df, "f", "n", F.col("h")).collect()}
    assert set(out) == {(1, 1), (1, 3), (2, 0)}  # lines before the first header dropped
    assert out[(1, 1)].header == "HEAD one" and out[(1, 1)].body == "a\nb" and out[(1, 1)].n_lines == 2
    assert out[(1, 3)].n_lines == 0 and out[(2, 0)].body == ""  # last segment kept


def test_paragraphs(spark):
    df = spark.createDataFrame([("**********_1801_x_Jefferson_***\nP one\n\n  P two \n\n\n",)], "record string")
    r = G.segment_paragraphs(df).first()
    assert (r.year, r.author) == (1801, "Jefferson")
    assert r.paragraphs == ["P one", "P two"]


def test_flexible_dates(spark):
    as_of = "2016-03-15"
    rows = [("today",), ("Yesterday",), ("03/04/2016 x",), ("12 March 2016 (3 days ago)",), ("rubbish",), (None,),
            ("added on 1 march 2016",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.d for r in df.select(D.parse_flexible_date("s", as_of).alias("d")).collect()]
    assert got[:6] == [datetime.date(2016, 3, 15), datetime.date(2016, 3, 14), datetime.date(2016, 4, 3),
                       datetime.date(2016, 3, 12), None, None]
    assert got[6] is None  # the long form needs what follows it, unless asked otherwise
    bare = [r.d for r in df.select(D.parse_flexible_date("s", as_of, bare_long_form=True).alias("d")).collect()]
    assert bare[:6] == got[:6] and bare[6] == datetime.date(2016, 3, 1)


def test_cards_and_title(spark):
    html = ('<html><head><script>var t="</p>";</script></head><body><h1>Nice &amp; <i>big</i> flat</h1>'
            '<p><b>Premium</b> added today</p><p>Added on 12 March 2016</p><p>plain card</p></body></html>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    blocks = page_blocks(pages).orderBy("block_no").collect()
    assert [b.is_premium for b in blocks] == [True, False, False]  # per card (q12)
    assert blocks[0].block_text == "Premium added today"
    assert pages.select(H.title("html")).first()[0] == "Nice & big flat"
    assert pages.select(H.counter_total(F.lit("1 of 12"))).first()[0] == 12


def test_running_header_across_buckets(spark):
    from quarry.operators.segment import running_header

    rows = [(1, i, i in (0, 5, 17)) for i in range(40)] + [(2, i, i == 3) for i in range(10)]
    df = spark.createDataFrame(rows, "g long, n long, h boolean")
    got = {(r.g, r.n): r.seg_start for r in running_header(df, "g", "n", F.col("h"), bucket_size=4).collect()}
    for (g, n), s in got.items():
        heads = [i for (gg, i, h) in rows if gg == g and h and i <= n]
        assert s == (max(heads) if heads else None)


def test_card_added_dates(spark):
    html = ('<article><p><b>Premium</b> flat, added today.</p><p>Nice, Added on 12 March 2016.</p>'
            '<p>added yesterday</p><p>no date</p></article>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [(r.added_text, r.add_date) for r in page_blocks(pages, as_of="2016-03-20").orderBy("block_no").collect()]
    assert got == [("added today", datetime.date(2016, 3, 20)), ("Added on 12 March 2016", datetime.date(2016, 3, 12)),
                   ("added yesterday", datetime.date(2016, 3, 19)), ("", None)]
