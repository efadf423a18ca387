"""Segmentation of speech corpora and line-structured text (SEG1-SEG5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.util import explode_nonempty

# The corpus delimiter and the header pattern of a record
# that follows it ("<year>_<id>_<author>_***" then a newline, then the text).
DELIMITER = "**********_"
RECORD_RE = r"(?s)^(\d{4})_([^_]*)_(.+?)_\*+\n(.*)$"


def speech_header(year, field, author, delimiter: str = DELIMITER) -> F.Column:
    """Header line of one speech in a delimited corpus file."""
    return F.concat(F.lit(delimiter), F.col(year).cast("string"), F.lit("_"), F.col(field).cast("string"),
                    F.lit("_"), F.col(author), F.lit("_***\n"))


def write_speech_corpus(df: DataFrame, path: str, year: str, field: str, author: str, text: str,
                        delimiter: str = DELIMITER) -> None:
    """Write speeches as a delimited text corpus (one record per speech)."""
    df.select(F.concat(speech_header(year, field, author, delimiter), F.coalesce(F.col(text), F.lit(""))).alias("value")) \
        .write.mode("error").text(path)


def segment_records(records: DataFrame, record_col: str = "record", pattern: str = RECORD_RE,
                    names: tuple[str, ...] = ("year", "field", "author", "text"),
                    glue_newlines: bool = False) -> DataFrame:
    """SEG1: parse each delimited record with a capturing regex (DOTALL).

    Newlines in the text become spaces (q5; ``glue_newlines`` keeps the old
    deletion). Records that do not match are dropped.
    """
    rec = F.col(record_col)
    cols = [F.regexp_extract(rec, pattern, i + 1).alias(n) for i, n in enumerate(names)]
    out = records.where(rec.rlike(pattern)).select(*cols)
    return out.withColumn(names[-1], F.trim(T.remove_newlines(names[-1], glue_newlines)))


def running_header(lines: DataFrame, group_col: str, order_col: str, is_header: F.Column,
                   out: str = "seg_start", bucket_size: int = 4096) -> DataFrame:
    """For each unit, the position of the last header at or before it in its group.

    A two-level prefix maximum, so that no task sees a whole group: units are
    cut into buckets of ``bucket_size`` consecutive positions; a running max
    inside each (group, bucket) is a window over at most ``bucket_size`` rows;
    each bucket's carry-in is a running max over the per-bucket maxima (one
    row per bucket), joined back by (group, bucket).
    """
    t = lines.withColumn("_b", F.floor(F.col(order_col) / bucket_size)).withColumn(
        "_h", F.when(is_header, F.col(order_col)))
    w_in = (Window.partitionBy(group_col, "_b").orderBy(order_col)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    t = t.withColumn("_local", F.max("_h").over(w_in))
    per_bucket = t.groupBy(group_col, "_b").agg(F.max("_h").alias("_bm"))
    w_b = Window.partitionBy(group_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.withColumn("_carry", F.max("_bm").over(w_b)).select(group_col, "_b", "_carry")
    t = t.join(carry, [group_col, "_b"], "left")
    return t.withColumn(out, F.coalesce(F.col("_local"), F.col("_carry"))).drop("_b", "_h", "_local", "_carry")


def segment_lines(lines: DataFrame, group_col: str, order_col: str, is_header: F.Column,
                  text_col: str = "text", trim: bool = True, replace_underscore: bool = True):
    """SEG2 in long form: ``(headers, body_lines)`` without collecting segments.

    ``headers``: ``(group, seg_start, header)``; ``body_lines``:
    ``(group, seg_start, order, pos, line)`` for the lines of the non-header
    units that follow each header (trimmed, empty lines dropped when
    ``trim``). Units before the first header belong to no segment.
    """
    tagged = lines.select(group_col, order_col, text_col, is_header.alias("_is_header"))
    tagged = running_header(tagged, group_col, order_col, F.col("_is_header"))
    tagged = tagged.where(F.col("seg_start").isNotNull())
    hdr_text = F.split(F.col(text_col), "\n").getItem(0)
    if replace_underscore:
        hdr_text = F.regexp_replace(hdr_text, "_", " ")
    headers = tagged.where("_is_header").select(group_col, "seg_start", F.trim(hdr_text).alias("header"))
    body = explode_nonempty(tagged.where(~F.col("_is_header")), [group_col, "seg_start", order_col],
                            F.split(F.col(text_col), "\n"), "line", "pos")
    if trim:
        body = body.withColumn("line", F.trim("line")).where(F.col("line") != "")
    return headers, body


def segment_by_header(lines: DataFrame, group_col: str, order_col: str, is_header: F.Column,
                      text_col: str = "text", trim: bool = True, replace_underscore: bool = True) -> DataFrame:
    """SEG2 / SEG3: split ordered units into segments that start at header units.

    Output: ``(group, seg_start, header, n_lines, body)`` where ``body`` is the
    newline-joined lines of the segment; the last segment is kept (q3).
    Segment ids come from :func:`running_header` (no per-group window). One
    output row is one whole segment, which is the result's unit; use
    :func:`segment_lines` to keep segments in long form.
    """
    tagged = running_header(lines.select(group_col, order_col, text_col, is_header.alias("_head")), group_col, order_col, F.col("_head"))
    parts = F.split(F.col(text_col), "\n")
    title = parts.getItem(0)
    if replace_underscore:
        title = F.regexp_replace(title, "_", " ")
    body = F.transform(parts, lambda x, i: F.struct(i.alias("pos"), (F.trim(x) if trim else x).alias("line")))
    if trim:
        body = F.filter(body, lambda x: x["line"] != "")
    # a unit gives its header (position -1) or its lines: one tagging pass, one explode, one aggregation
    units = F.when(F.col("_head"), F.array(F.struct(F.lit(-1).alias("pos"), F.trim(title).alias("line")))).otherwise(body)
    rows = explode_nonempty(tagged.where(F.col("seg_start").isNotNull()), [group_col, "seg_start", order_col, "_head"], units, "_unit")
    rows = rows.select(group_col, "seg_start", order_col, F.col("_head").alias("_h"), "_unit.pos", "_unit.line")
    grouped = rows.groupBy(group_col, "seg_start").agg(
        F.max(F.when(F.col("_h"), F.col("line"))).alias("header"),
        F.max(F.col("_h").cast("int")).alias("_has_header"),
        F.array_sort(F.collect_list(F.when(~F.col("_h"), F.struct(order_col, "pos", "line")))).alias("_lines"))
    lines_arr = F.transform("_lines", lambda x: x["line"])
    return grouped.where(F.col("_has_header") == 1).select(
        group_col, "seg_start", "header", F.size(lines_arr).alias("n_lines"), F.array_join(lines_arr, "\n").alias("body"))


def split_paragraphs(text, sep_regex: str = r"\n\s*\n") -> F.Column:
    """SEG4: paragraphs split on ``sep_regex``, trimmed, empty ones dropped."""
    parts = F.transform(F.split(F.col(text) if isinstance(text, str) else text, sep_regex), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def segment_paragraphs(records: DataFrame, record_col: str = "record", sep_regex: str = r"\n\s*\n",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """SEG4: a record is a header line then the text; year = first 4 digits of
    the header, author = the capitalised word before ``_*``; paragraphs are
    split on ``sep_regex``, trimmed, empties dropped. ``keep`` columns pass through."""
    rec = F.col(record_col)
    header = F.substring_index(rec, "\n", 1)
    body = F.substr(rec, F.length(header) + 2)
    return records.select(
        *keep,
        F.regexp_extract(header, r"(\d{4})", 1).try_cast("int").alias("year"),
        F.regexp_extract(header, r"([A-Z][A-Za-z0-9]*)_\*", 1).alias("author"),
        split_paragraphs(body, sep_regex).alias("paragraphs"),
    )
