"""Extraction by structure against a parser of the standard library."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from quarry.functions import html as H


class Plain(HTMLParser):
    """The same rules, event by event."""

    def __init__(self, marker):
        super().__init__(convert_charrefs=True)
        self.marker, self.stack, self.depth, self.heading, self.out, self.inner = marker, [], -1, "", [], []

    def handle_starttag(self, tag, attrs):
        if tag in H.VOID or self.get_starttag_text().endswith("/>"):
            self.break_(tag)
            return
        self.break_(tag)
        if self.stack and (self.stack[-1] == "p" and tag in H.ENDS_PARAGRAPH or self.stack[-1] == tag == "li"):
            self.stack.pop()
        self.stack.append(tag)
        if self.depth >= 0 and len(self.stack) < self.depth:
            self.depth = -2

    def handle_startendtag(self, tag, attrs):
        self.break_(tag)

    def break_(self, tag):
        if "article" in self.stack and tag in ("p", "br", "h1", "h2", "h3", "li", "div", "tr", "td", "article"):
            self.inner.append(" ")

    def handle_endtag(self, tag):
        self.break_(tag)
        if tag in self.stack:
            at = len(self.stack) - 1 - self.stack[::-1].index(tag)
            self.stack = self.stack[:at]
        if tag in H.HEADINGS:
            if self.depth == -1 and self.marker in self.heading.lower():
                self.depth = len(self.stack)
            self.heading = ""
        if self.depth >= 0 and len(self.stack) < self.depth:
            self.depth = -2

    def handle_data(self, data):
        if "article" in self.stack:
            self.inner.append(data)
        if set(self.stack) & set(H.HEADINGS):
            self.heading += data
        if self.depth >= 0 and len(self.stack) == self.depth:
            self.out.append(data)


def both(page, marker="about"):
    p = Plain(marker)
    p.feed(page)
    p.close()
    tidy = lambda parts, sep: " ".join(sep.join(parts).split())
    return tidy(p.out, " "), tidy(p.inner, "")


CASES = [
    "<div><h3>About</h3>one<b>no</b>two<div>no</div>three</div>four",
    "<h2>Else</h2>x<h2>All <i>about</i> it</h2>y<br>z",
    "<article>a<article>b</article>c<div>d</div></article>e<article>f</article>",
    "<div><p>open<p>two<h3>about</h3>text<p>para</p>more</div>out",
    "<div><h3>about</h3>caf&#233; &#x2014; &#xE9;&amp;lt; &nbsp;x&#65;</div>",
    "<ul><li>a<li><h3>about</h3>b<li>c</ul>d", "</div><h3>about</h3>a</b>c", "<h3>about</h3>", "", "no tags at all", "<article>never closed <p>x",
    "<div/><h3>about</h3>a<img src='x'/>b<hr>c",
]


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(6)
    tags = ["div", "p", "b", "article", "ul", "li", "h3", "span"]
    out = list(CASES)
    for _ in range(150):
        page = []
        for _ in range(rng.randrange(3, 40)):
            t = rng.choice(tags)
            page.append(rng.choice([f"<{t}>", f"<{t}>", f"</{t}>", f"</{t}>", f"w{rng.randrange(99)} ", "<h3>about</h3>", "<br>", f"&#{rng.randrange(65, 90)};"]))
        out.append("".join(page))
    return out


def test_equals_the_parser(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i long, html string")
    got = df.select("i", H.text_after_heading("html", "about").alias("d"), H.element_text("html", "article").alias("a")).collect()
    for r in got:
        want = both(pages[r["i"]])
        assert (r["d"], r["a"]) == want, pages[r["i"]]


def test_entities(spark):
    rows = ["&#65;&#x42;&#X43;", "&#0;&#55296;&#1114112;", "&amp;#65; &lt;&#62;", "&#;&#x;&# 1;", "plain", "", None, "&#128512;"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, s string")
    got = {r["i"]: r["u"] for r in df.select("i", H.unescape_all("s").alias("u")).collect()}
    assert [got[i] for i in range(8)] == ["ABC", "&#0;&#55296;&#1114112;", "&#65; <>", "&#;&#x;&# 1;", "plain", "", None, "\U0001f600"]


def test_null_pages(spark):
    df = spark.createDataFrame([(None,)], "html string")
    assert df.select(H.text_after_heading("html", "x").alias("d")).first()["d"] in ("", None)
