"""Registered segmentation queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import segment as G
from quarry.plans import corpus as C
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources.readers import read_corpus_text
from quarry.sources.tables import Tables


@register("segment_by_regex", "SRC2, SEG1, TXT12, TOP5", r"""
select cast(1900 + doc_id % 100 as varchar) as year, cast(doc_id as varchar) as field, source as author,
       trim(replace(text, chr(10), ' ')) as text
from documents""")
def segment_by_regex(spark, sf):
    """Documents are written as one delimited corpus file set, read back split
    at read time (``lineSep``), and parsed per record."""
    path = scratch_path(spark, "speech_corpus")
    G.write_speech_corpus(C.documents(spark, sf), path, "year", "doc_id", "source", "text")
    recs = read_corpus_text(spark, path, G.DELIMITER)
    return G.segment_records(recs).orderBy("year", "author", "text")


@register("segment_by_header", "SEG2, SEG3, UDF4, UDF5", r"""
with t as (select conv_id, turn, role, text,
                  max(case when role = 'user' then turn end) over (partition by conv_id order by turn rows between unbounded preceding and current row) as seg_start
           from conversations),
h as (select conv_id, seg_start, trim(replace(string_split(text, chr(10))[1], '_', ' ')) as header from t where role = 'user'),
l as (select conv_id, seg_start, turn, pos, trim(line) as line
      from (select conv_id, seg_start, turn, unnest(string_split(text, chr(10))) as line,
                   unnest(range(0, len(string_split(text, chr(10))))) as pos
            from t where role <> 'user' and seg_start is not null)),
b as (select conv_id, seg_start, count(*) as n_lines, string_agg(line, chr(10) order by turn, pos) as body
      from l where line <> '' group by conv_id, seg_start)
select h.conv_id, h.seg_start, h.header, coalesce(b.n_lines, 0)::integer as n_lines, coalesce(b.body, '') as body
from h left join b using (conv_id, seg_start)""")
def segment_by_header(spark, sf):
    conv = Tables(spark, sf).conversations
    return G.segment_by_header(conv, "conv_id", "turn", F.col("role") == "user")


@register("segment_by_header_raw", "SEG3", r"""
with t as (select conv_id, turn, role, text,
                  max(case when role = 'user' then turn end) over (partition by conv_id order by turn rows between unbounded preceding and current row) as seg_start
           from conversations),
h as (select conv_id, seg_start, trim(string_split(text, chr(10))[1]) as header from t where role = 'user'),
l as (select conv_id, seg_start, turn, pos, line
      from (select conv_id, seg_start, turn, unnest(string_split(text, chr(10))) as line,
                   unnest(range(0, len(string_split(text, chr(10))))) as pos
            from t where role <> 'user' and seg_start is not null)),
b as (select conv_id, seg_start, count(*) as n_lines, string_agg(line, chr(10) order by turn, pos) as body
      from l group by conv_id, seg_start)
select h.conv_id, h.seg_start, h.header, coalesce(b.n_lines, 0)::integer as n_lines, coalesce(b.body, '') as body
from h left join b using (conv_id, seg_start)""")
def segment_by_header_raw(spark, sf):
    """The second splitter variant: lines kept untrimmed (blank ones too), '_' kept."""
    conv = Tables(spark, sf).conversations
    return G.segment_by_header(conv, "conv_id", "turn", F.col("role") == "user", trim=False, replace_underscore=False)


_RECORD_SQL = r"""(select doc_id, '**********_' || cast(1900 + doc_id % 100 as varchar) || '_' || cast(doc_id as varchar) || '_' ||
        upper(substr(source, 1, 1)) || substr(source, 2) || '_***' || chr(10) ||
        replace(replace(text, chr(10), chr(10) || ' ' || chr(10)), '. ', '.' || chr(10)) as record from documents)"""
# sentences on lines of their own, the text's lines set off by blank ones


def _records(spark, sf):
    d = C.documents(spark, sf)
    author = F.concat(F.upper(F.substring("source", 1, 1)), F.substr("source", F.lit(2)))
    text = F.replace(F.replace("text", F.lit("\n"), F.lit("\n \n")), F.lit(". "), F.lit(".\n"))
    rec = F.concat(G.speech_header("year", "doc_id", "_author"), text)
    return d.withColumn("_author", author).select("doc_id", rec.alias("record"))


@register("segment_paragraphs", "SEG4", rf"""
select doc_id, cast(regexp_extract(split_part(record, chr(10), 1), '(\d{{4}})', 1) as integer) as year,
       regexp_extract(split_part(record, chr(10), 1), '([A-Z][A-Za-z0-9]*)_\*', 1) as author,
       array_to_string(list_filter(list_transform(regexp_split_to_array(substr(record, length(split_part(record, chr(10), 1)) + 2), '\n\s*\n'), lambda p: trim(p)), lambda p: p <> ''), chr(10) || chr(10)) as paragraphs_joined
from {_RECORD_SQL}""")
def segment_paragraphs(spark, sf):
    seg = G.segment_paragraphs(_records(spark, sf), keep=("doc_id",))
    return seg.select("doc_id", "year", "author", F.array_join("paragraphs", "\n\n").alias("paragraphs_joined"))


@register("paragraph_counts", "SEG5", rf"""
select doc_id, len(list_filter(list_transform(regexp_split_to_array(substr(record, length(split_part(record, chr(10), 1)) + 2), '\n\s*\n'), lambda p: trim(p)), lambda p: p <> '')) as n_paragraphs
from {_RECORD_SQL}""")
def paragraph_counts(spark, sf):
    seg = G.segment_paragraphs(_records(spark, sf), keep=("doc_id",))
    return seg.select("doc_id", F.size("paragraphs").cast("long").alias("n_paragraphs"))
