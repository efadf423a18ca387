"""HTML field extraction (HTM1-HTM7) as column expressions.

Regexes are RE2-compatible (no back-references, no look-around) so the
same patterns serve as SQL oracles. Script, style and comment blocks are
removed before any tag-based extraction (a ``</p>`` inside a script must
not end a paragraph).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entity replacements, applied in this order (&amp; last).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]

HREF_RE = r"""(?i)href\s*=\s*("[^"]*"|'[^']*')"""
H1_RE = r"(?s)<h1[^>]*>(.*?)</h1>"
PARA_RE = r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_non_content(html) -> Column:
    """Remove ``<script>``, ``<style>`` blocks and comments."""
    h = F.regexp_replace(_c(html), r"(?is)<script[^>]*>.*?</script>", "")
    h = F.regexp_replace(h, r"(?is)<style[^>]*>.*?</style>", "")
    return F.regexp_replace(h, r"(?s)<!--.*?-->", "")


def unescape_entities(s) -> Column:
    out = _c(s)
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def strip_tags(s) -> Column:
    return F.regexp_replace(_c(s), r"<[^>]*>", "")


def html_text(s) -> Column:
    """Tags removed, entities unescaped, whitespace runs collapsed, trimmed."""
    return F.trim(F.regexp_replace(unescape_entities(strip_tags(s)), r"\s+", " "))


def title(html) -> Column:
    """HTM3: text of the first ``<h1>``; '' when there is none."""
    return html_text(F.regexp_extract(strip_non_content(html), H1_RE, 1))


def links(html) -> Column:
    """HTM1: every ``href`` value, in single or double quotes, in document order."""
    quoted = F.regexp_extract_all(strip_non_content(html), F.lit(HREF_RE), 1)
    return F.transform(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2))


def paragraphs(html) -> Column:
    """HTM2: raw inner HTML of each ``<p ...>...</p>`` block, in order."""
    return F.regexp_extract_all(strip_non_content(html), F.lit(PARA_RE), 1)


def has_marker(html, markers: list[str]) -> Column:
    """HTM6: case-insensitive presence of any marker phrase."""
    low = F.lower(_c(html))
    out = F.lit(False)
    for m in markers:
        out = out | low.contains(m.lower())
    return out


def counter_total(text) -> Column:
    """HTM7: "1 of 12" -> 12 (third space-separated word as int, NULL if absent)."""
    return F.get(F.split(_c(text), " "), 2).try_cast("int")


ARTICLE_RE = r"(?s)<article[^>]*>(.*?)</article>"
BLOCK_TAG_RE = r"(?i)<(p|br|h[1-6]|li|div|tr|td)\b[^>]*>"


def main_text(html) -> Column:
    """HTM4: text of the ``<article>`` elements, one after the other; block tags become
    spaces, other tags vanish, entities are unescaped, whitespace is collapsed."""
    arts = F.regexp_extract_all(strip_non_content(html), F.lit(ARTICLE_RE), 1)
    return html_text(F.regexp_replace(F.array_join(arts, " "), BLOCK_TAG_RE, " "))


# ---------------------------------------------------------------- by structure (HTM4)

TOKEN_RE = r"(?s)(<[^>]*>|[^<]+|<)"
# Fixed values of the markup language: elements without an end tag, and those whose start ends an open paragraph.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
ENDS_PARAGRAPH = ["address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4",
                  "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"]
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
NUMERIC_RE = r"(?i)^&#(x[0-9a-f]{1,6}|[0-9]{1,7});"


def unescape_all(s) -> Column:
    """Named entities as :func:`unescape_entities` has them, and numeric ones, decimal or hexadecimal (of no character: left as they are)."""

    def one(part: Column) -> Column:
        digits = F.lower(F.regexp_extract(part, NUMERIC_RE, 1))
        value = F.when(digits.startswith("x"), F.conv(F.substring(digits, F.lit(2), F.length(digits)), 16, 10)).otherwise(digits).try_cast("int")
        known = (value > 0) & (value <= 0x10FFFF) & ~value.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(known, value).otherwise(F.lit(32))), 8, "0")), "UTF-32")
        return F.when(known, F.concat(char, F.regexp_replace(part, NUMERIC_RE, ""))).otherwise(part)

    # named ones first, but for the ampersand's own, so that "&amp;#65;" stays text
    out = _c(s)
    for ent, ch in ENTITIES[:-1]:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    whole = F.array_join(F.transform(F.split(out, "(?=&#)"), one), "")
    return F.replace(whole, F.lit(ENTITIES[-1][0]), F.lit(ENTITIES[-1][1]))


def tag_tokens(html) -> Column:
    """Start tags, end tags and runs of text in order, as ``struct(kind, name, text)``: kind 1, 2 and 0; void elements and odd tags are 3."""

    def token(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"^</?([A-Za-z][A-Za-z0-9]*)", 1))
        tag = t.startswith("<") & t.endswith(">") & (F.length(t) > 1)
        kind = F.when(~tag, 0).when((name == "") | name.isin(VOID) | t.endswith("/>"), 3).when(t.startswith("</"), 2).otherwise(1)
        return F.struct(kind.cast("int").alias("kind"), name.alias("name"), t.alias("text"))

    return F.transform(F.regexp_extract_all(strip_non_content(html), F.lit(TOKEN_RE), 1), token)


def open_elements(stack: Column, t: Column) -> Column:
    """The names of the open elements after one more token.

    A start that ends a paragraph closes an open one on top; an end closes its
    element and all that were left open inside it; an end without a start does
    nothing.
    """
    size = F.size(stack)
    top = F.try_element_at(stack, F.lit(-1))
    closes = ((top == "p") & t["name"].isin(ENDS_PARAGRAPH)) | ((top == "li") & (t["name"] == "li"))
    under = F.when(F.coalesce(closes, F.lit(False)), F.slice(stack, F.lit(1), size - 1)).otherwise(stack)
    back = F.array_position(F.reverse(stack), t["name"]).cast("int")
    return (F.when(t["kind"] == 1, F.concat(under, F.array(t["name"])))
            .when((t["kind"] == 2) & (back > 0), F.slice(stack, F.lit(1), size - F.when(back > 0, back).otherwise(F.lit(0)))).otherwise(stack))


_NONE = "cast(array() as array<string>)"


def text_after_heading(html, marker: str) -> Column:
    """HTM4: bare text after the first heading whose text holds ``marker``: the text siblings of that heading, up to its parent's end.

    Text inside elements that follow the heading is not taken. Pieces are
    joined by a space, entities unescaped, white space collapsed; '' without
    such a heading.
    """
    start = F.struct(F.expr(_NONE).alias("stack"), F.lit(-1).alias("depth"), F.lit("").alias("heading"), F.expr(_NONE).alias("out"))

    def step(s: Column, t: Column) -> Column:
        stack = open_elements(s["stack"], t)
        inside = F.coalesce(F.try_element_at(s["stack"], F.lit(-1)).isin(HEADINGS), F.lit(False)) | (F.size(F.array_intersect(s["stack"], F.lit(HEADINGS))) > 0)
        is_text = t["kind"] == 0
        ends_heading = (t["kind"] == 2) & t["name"].isin(HEADINGS)
        found = ends_heading & (s["depth"] == -1) & F.lower(s["heading"]).contains(marker.lower())
        # -1: not found yet, -2: the parent has ended
        depth = F.when(found, F.size(stack)).when((s["depth"] >= 0) & (F.size(stack) < s["depth"]), -2).otherwise(s["depth"])
        heading = F.when(ends_heading, "").when(is_text & inside, F.concat(s["heading"], t["text"])).otherwise(s["heading"])
        takes = is_text & (s["depth"] >= 0) & (F.size(s["stack"]) == s["depth"])
        out = F.when(takes, F.concat(s["out"], F.array(t["text"]))).otherwise(s["out"])
        return F.struct(stack.alias("stack"), depth.cast("int").alias("depth"), heading.alias("heading"), out.alias("out"))

    got = F.aggregate(tag_tokens(html), start, step, lambda s: F.array_join(s["out"], " "))
    return F.trim(F.regexp_replace(unescape_all(got), r"\s+", " "))


def element_text(html, name: str) -> Column:
    """HTM4: all text inside elements ``name``, however nested; block tags become spaces, white space is collapsed."""
    start = F.struct(F.expr(_NONE).alias("stack"), F.expr(_NONE).alias("out"))
    block = "^(p|br|h[1-6]|li|div|tr|td)$"

    def step(s: Column, t: Column) -> Column:
        inside = F.array_contains(s["stack"], name)
        piece = F.when(t["kind"] == 0, t["text"]).when(t["name"].rlike(block) | (t["name"] == name), " ")
        out = F.when(inside & piece.isNotNull(), F.concat(s["out"], F.array(piece))).otherwise(s["out"])
        return F.struct(open_elements(s["stack"], t).alias("stack"), out.alias("out"))

    got = F.aggregate(tag_tokens(html), start, step, lambda s: F.array_join(s["out"], ""))
    return F.trim(F.regexp_replace(unescape_all(got), r"\s+", " "))
