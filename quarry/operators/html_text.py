"""HTML page operators (HTM1-HTM6).

All extraction is by column expressions (:mod:`quarry.functions.html`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.plans import fixtures as FX
from quarry.operators.util import explode_nonempty


def page_links(pages: DataFrame, pattern: str, id_col: str = "page_id") -> DataFrame:
    """HTM1: link ids (path without the leading '/') matching ``pattern``,
    distinct per page, with the position where each was first seen."""
    ex = explode_nonempty(pages, [id_col], H.links("html"), "link", "pos")
    ex = ex.where(F.col("link").rlike(pattern))
    return (ex.groupBy(id_col, "link").agg(F.min("pos").alias("first_pos"))
            .select(id_col, F.substr("link", F.lit(2)).alias("link_id"), F.col("first_pos").cast("long").alias("first_pos")))


ADDED_RE = r"(?i)(added (today|yesterday|on [0-9]{1,2} [a-z]+ [0-9]{4}))"


def page_blocks(pages: DataFrame, id_col: str = "page_id", as_of: str = "2001-08-01") -> DataFrame:
    """HTM2: one row per ``<p>`` block (a result card): premium flag (bold
    lead, per card: q12), card text, word count, the "added ..." phrase and
    the date it names relative to ``as_of`` (DAT1 / DAT5; NULL if none)."""
    from quarry.functions.dates import parse_flexible_date

    ex = explode_nonempty(pages, [id_col], H.paragraphs("html"), "block", "block_no")
    txt = H.html_text("block")
    out = ex.select(id_col, F.col("block_no").cast("long").alias("block_no"), F.col("block").startswith("<b>").alias("is_premium"),
                    txt.alias("block_text"))
    added = F.regexp_extract("block_text", ADDED_RE, 1)
    value = F.regexp_replace(added, r"(?i)^added (on )?", "")
    return out.select(id_col, "block_no", "is_premium", "block_text",
                      F.size(F.regexp_extract_all(F.lower("block_text"), F.lit(r"([\p{L}\p{N}_]+)"), 1)).cast("long").alias("n_words"),
                      added.alias("added_text"),
                      F.when(added != "", parse_flexible_date(value, as_of, bare_long_form=True)).alias("add_date"))


def status_flags(pages: DataFrame, removed_markers=None, let_marker: str | None = None) -> DataFrame:
    """HTM6: removed / let agreed by marker text; removed takes priority."""
    removed = H.has_marker("html", removed_markers or FX.REMOVED_MARKERS)
    let = H.has_marker("html", [let_marker or FX.LET_AGREED_MARKER])
    return pages.withColumn("removed", removed).withColumn("let_agreed", ~removed & let) \
        .withColumn("has_ad", F.col("html").contains('class="ad"'))


def main_text(pages: DataFrame) -> DataFrame:
    """HTM4: main text of each page (:func:`quarry.functions.html.main_text`) plus its word count."""
    out = pages.select("page_id", H.main_text("html").alias("main_text"))
    return out.select("page_id", "main_text",
                      F.size(F.regexp_extract_all(F.lower("main_text"), F.lit(r"([\p{L}\p{N}_]+)"), 1)).cast("long").alias("n_words"))


def label_values(pages: DataFrame, patterns: list[str]) -> DataFrame:
    """HTM5: ``(page_id, label, value)`` for each label of a page.

    Every pattern has a label group and a value group; labels are lower-cased,
    entities unescaped, white space collapsed. Of several values of a label
    the last counts, that of a later pattern before that of an earlier one.
    """
    html = H.strip_non_content("html")
    tidy = lambda s: F.trim(F.regexp_replace(H.unescape_entities(s), r"\s+", " "))
    found = [F.transform(F.arrays_zip(F.regexp_extract_all(html, F.lit(p), 1).alias("k"), F.regexp_extract_all(html, F.lit(p), 2).alias("v")),
                         lambda x: F.struct(x["k"].alias("k"), x["v"].alias("v"))) for p in patterns]
    ex = explode_nonempty(pages, ["page_id"], F.concat(*found), "pair", "pos")
    pairs = ex.select("page_id", F.lower(tidy(F.col("pair.k"))).alias("label"), tidy(F.col("pair.v")).alias("value"), "pos").where("label <> ''")
    return pairs.groupBy("page_id", "label").agg(F.max_by("value", "pos").alias("value"))
