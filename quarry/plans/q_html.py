"""Registered HTML, string-parsing and date queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import dates as D
from quarry.functions import html as H
from quarry.functions import text as T
from quarry.operators import html_text as HT
from quarry.plans import corpus as C
from quarry.plans import fixtures as FX
from quarry.plans import sqlfrag as S
from quarry.plans.listings import AS_OF
from quarry.plans.registry import register
from quarry.sources.tables import Tables

_CLEAN_SQL = r"""regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'),
                 '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g')"""


def _unescape_sql(x: str) -> str:
    for ent, ch in H.ENTITIES:
        x = f"replace({x}, {S.q(ent)}, {S.q(ch)})"
    return x


def _text_sql(x: str) -> str:
    return "trim(regexp_replace(" + _unescape_sql(f"regexp_replace({x}, '<[^>]*>', '', 'g')") + r", '\s+', ' ', 'g'))"


@register("pages_scan", "SRC11", """
select page_id, url, cast(length(html) as integer) as html_chars, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) as host from pages""")
def pages_scan(spark, sf):
    p = Tables(spark, sf).pages
    return p.select("page_id", "url", F.length("html").alias("html_chars"),
                    F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1).alias("host"))


@register("page_links", "HTM1", rf"""
select page_id, substr(link, 2) as link_id, min(pos) as first_pos
from (select page_id, unnest(l) as link, unnest(range(0, len(l))) as pos
      from (select page_id, list_transform(regexp_extract_all({_CLEAN_SQL}, '(?i)href\s*=\s*("[^"]*"|''[^'']*'')', 1), lambda q: q[2:-2]) as l from pages))
where regexp_full_match(link, '/[^/?#]+')
group by page_id, link""")
def page_links(spark, sf):
    p = Tables(spark, sf).pages
    return HT.page_links(p, r"^/[^/?#]+$").select("page_id", "link_id", "first_pos")


def _parse_sql(raw: str, bare: bool = False) -> str:
    """The flexible date, its long form only before " (" unless ``bare``."""
    v = f"trim(regexp_replace({raw}, '(?i)^added on ', ''))"
    return f"""case when lower({v}) in ('today', 'now') then date '{AS_OF}'
      when lower({v}) = 'yesterday' then date '{AS_OF}' - 1
      else coalesce(cast(try_strptime(substr({v}, 1, 10), '%d/%m/%Y') as date),
                    {"" if bare else f"case when contains({v}, ' (') then "}cast(try_strptime(split_part({v}, ' (', 1), '%d %B %Y') as date){"" if bare else " end"}) end"""


def _page_blocks_sql() -> str:
    t = _text_sql("block")
    added = f"regexp_extract({t}, '(?i)(added (today|yesterday|on [0-9]{{1,2}} [a-z]+ [0-9]{{4}}))', 1)"
    value = f"regexp_replace({added}, '(?i)^added (on )?', '')"
    return rf"""
select page_id, block_no, starts_with(block, '<b>') as is_premium, {t} as block_text,
       len(regexp_extract_all(lower({t}), '([\p{{L}}\p{{N}}_]+)', 1)) as n_words,
       {added} as added_text,
       case when {added} <> '' then {_parse_sql(value, bare=True)} end as add_date
from (select page_id, unnest(b) as block, unnest(range(0, len(b))) as block_no
      from (select page_id, regexp_extract_all({_CLEAN_SQL}, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1) as b from pages))"""


@register("page_blocks", "HTM2, DAT5", _page_blocks_sql())
def page_blocks(spark, sf):
    return HT.page_blocks(Tables(spark, sf).pages, as_of=AS_OF)


@register("page_title", "HTM3", rf"""
select page_id, {_text_sql(f"regexp_extract({_CLEAN_SQL}, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} as title from pages""")
def page_title(spark, sf):
    p = Tables(spark, sf).pages
    return p.select("page_id", H.title("html").alias("title"))


# listing pages of which every fifth was taken down and every fifth let: the marker phrases are put in by page id
_STATUS_HTML = """html || case page_id % 5 when 0 then '<p>We are sorry but this page has gone.</p>'
  when 1 then '<p class="s">LET AGREED</p>' when 2 then '<p>No longer available, let agreed</p>' else '' end"""
_REMOVED = " or ".join(f"contains(lower(h), {S.q(m)})" for m in FX.REMOVED_MARKERS)


@register("page_status_flags", "HTM6", rf"""
select page_id, ({_REMOVED}) as removed,
       (not ({_REMOVED}) and contains(lower(h), {S.q(FX.LET_AGREED_MARKER)})) as let_agreed,
       contains(h, 'class="ad"') as has_ad
from (select page_id, {_STATUS_HTML} as h from pages)""")
def page_status_flags(spark, sf):
    p = Tables(spark, sf).pages
    k = F.col("page_id") % 5
    marker = (F.when(k == 0, "<p>We are sorry but this page has gone.</p>").when(k == 1, '<p class="s">LET AGREED</p>')
              .when(k == 2, "<p>No longer available, let agreed</p>").otherwise(""))
    p = p.select("page_id", F.concat("html", marker).alias("html"))
    return HT.status_flags(p).select("page_id", "removed", "let_agreed", "has_ad")


@register("counter_parse", "HTM7", rf"""
select page_id, counter, try_cast(string_split(counter, ' ')[3] as integer) as total
from (select page_id, '1 of ' || cast(len(list_transform(regexp_extract_all({_CLEAN_SQL}, '(?i)href\s*=\s*("[^"]*"|''[^'']*'')', 1), lambda q: q[2:-2])) as varchar) as counter from pages)""")
def counter_parse(spark, sf):
    p = Tables(spark, sf).pages
    c = p.select("page_id", F.concat(F.lit("1 of "), F.size(H.links("html")).cast("string")).alias("counter"))
    return c.select("page_id", "counter", H.counter_total("counter").alias("total"))


_ARTICLE_SQL = f"""regexp_replace(array_to_string(regexp_extract_all({_CLEAN_SQL}, '(?s)<article[^>]*>(.*?)</article>', 1), ' '),
                   '(?i)<(p|br|h[1-6]|li|div|tr|td)\\b[^>]*>', ' ', 'g')"""


@register("page_main_text", "HTM4", f"""
select page_id, {_text_sql(_ARTICLE_SQL)} as main_text,
       len(regexp_extract_all(lower({_text_sql(_ARTICLE_SQL)}), '([\\p{{L}}\\p{{N}}_]+)', 1)) as n_words
from pages""")
def page_main_text(spark, sf):
    return HT.main_text(Tables(spark, sf).pages)


@register("page_main_text_parsed", "HTM4 (blocks)", f"""
select page_id, {_text_sql(_ARTICLE_SQL)} as main_text,
       len(regexp_extract_all(lower({_text_sql(_ARTICLE_SQL)}), '([\\p{{L}}\\p{{N}}_]+)', 1)) as n_words
from pages""")
def page_main_text_parsed(spark, sf):
    return HT.main_text(Tables(spark, sf).pages)


# a listing as its page has it: the description is bare text after a heading, with elements between and an odd end tag
_DESCRIPTION_HTML = """html || '<div class="agent"><h3>Key <b>features</b></h3>none<div><p>lead<h3>Full  <i>description</i></h3> Flat ' || page_id || ' &#x2014; at &#233;t&eacute; ' || url ||
  ' <b>not this</b><br>two rooms<ul><li>nor this</ul></span> &amp;#65; end</div>after</div><h3>Full description</h3>later'"""


@register("page_description", "HTM4 (siblings of a heading)", """
select page_id, trim(regexp_replace('Flat ' || page_id || ' — at ét&eacute; ' || url || ' two rooms &#65; end', '\\s+', ' ', 'g')) as description from pages""")
def page_description(spark, sf):
    """The text siblings of the description's heading on each page."""
    html = F.concat("html", F.lit('<div class="agent"><h3>Key <b>features</b></h3>none<div><p>lead<h3>Full  <i>description</i></h3> Flat '), F.col("page_id").cast("string"),
                    F.lit(" &#x2014; at &#233;t&eacute; "), "url",
                    F.lit(" <b>not this</b><br>two rooms<ul><li>nor this</ul></span> &amp;#65; end</div>after</div><h3>Full description</h3>later"))
    return Tables(spark, sf).pages.select("page_id", H.text_after_heading(html, "full  description").alias("description"))


@register("page_article_nested", "HTM4 (nested elements)", f"""
select page_id, trim({_text_sql(_ARTICLE_SQL)} || ' inner ' || page_id || ' é tail') as main_text from pages where contains(html, '</article>')""")
def page_article_nested(spark, sf):
    """The whole text of each page's article, with one more article inside it."""
    nested = F.concat(F.lit(" <article>inner "), F.col("page_id").cast("string"), F.lit(" &#233;</article><div>tail</div></article>"))
    p = Tables(spark, sf).pages.where(F.col("html").contains("</article>"))
    return p.select("page_id", H.element_text(F.replace("html", F.lit("</article>"), nested), "article").alias("main_text"))


_LABEL_RES = [r"""(?i)<html\s+(lang)="([^"]*)\"""", r"""(?i)<meta\s+(charset)="([^"]*)\"""",
              r"""(?s)>\s*([^<>:]*[^<>:\s])\s*:\s*([^<>]*[^<>\s])\s*<"""]
# a list of label/value runs as a listing page has it, one value as long as the page's url and one over 200 characters
_LABEL_HTML = """html || '<ul><li>Letting type: ' || case page_id % 3 when 0 then 'Long term' when 1 then 'Short &amp; long' else '' end ||
  '</li><li> Furnishing :' || url || '</li><li>letting  type: ' || repeat('x', cast(200 + page_id % 50 as integer)) || '</li></ul>'"""


def _labels_sql(kind: int, pattern: str) -> str:
    p = S.q(pattern)
    return f"""select page_id, {kind} as kind, unnest(regexp_extract_all(h, {p}, 1)) as k, unnest(regexp_extract_all(h, {p}, 2)) as v,
       unnest(range(0, len(regexp_extract_all(h, {p}, 1)))) as pos
    from (select page_id, {_CLEAN_SQL} as h from (select page_id, {_LABEL_HTML} as html from pages))"""


@register("page_label_values", "HTM5", f"""
select page_id, label, arg_max(value, (kind, pos)) as value
from (select page_id, lower(trim(regexp_replace({_unescape_sql("k")}, '\\s+', ' ', 'g'))) as label,
             trim(regexp_replace({_unescape_sql("v")}, '\\s+', ' ', 'g')) as value, kind, pos
      from ({" union all ".join(_labels_sql(i, p) for i, p in enumerate(_LABEL_RES))}))
where label <> '' group by page_id, label""")
def page_label_values(spark, sf):
    """Label/value pairs of each page: language, character set, and runs of text "label: value" of any length."""
    p = Tables(spark, sf).pages
    k = F.col("page_id") % 3
    letting = F.when(k == 0, "Long term").when(k == 1, "Short &amp; long").otherwise("")
    html = F.concat("html", F.lit("<ul><li>Letting type: "), letting, F.lit("</li><li> Furnishing :"), "url", F.lit("</li><li>letting  type: "),
                    F.repeat(F.lit("x"), (200 + F.col("page_id") % 50).cast("int")), F.lit("</li></ul>"))
    return HT.label_values(p.select("page_id", html.alias("html")), _LABEL_RES)


# ---- string parsing over values built from the order tables ----

_PRICE_TEXT_SQL = """(select o_orderkey, o_orderstatus || ' flat ' || cast(cast(floor(o_totalprice) as bigint) as varchar) || ' pcm' ||
   case when o_orderstatus = 'O' then ' or ' || cast(cast(floor(o_totalprice / 4) as bigint) as varchar) || ' pcm' else '' end ||
   case when o_orderstatus = 'P' then ', ' || cast(cast(floor(o_totalprice / 4) as bigint) as varchar) || ' pw' else '' end as txt
 from orders)"""


def _price_text(spark, sf):
    o = Tables(spark, sf).orders
    whole = F.floor("o_totalprice").cast("bigint").cast("string")
    quarter = F.floor(F.col("o_totalprice") / 4).cast("bigint").cast("string")
    txt = F.concat(F.col("o_orderstatus"), F.lit(" flat "), whole, F.lit(" pcm"),
                   F.when(F.col("o_orderstatus") == "O", F.concat(F.lit(" or "), quarter, F.lit(" pcm"))).otherwise(F.lit("")),
                   F.when(F.col("o_orderstatus") == "P", F.concat(F.lit(", "), quarter, F.lit(" pw"))).otherwise(F.lit("")))
    return o.select("o_orderkey", txt.alias("txt"))


@register("regex_single_match", "TXT14", rf"""
select o_orderkey, case when len(m) = 1 then m[1] end as value
from (select o_orderkey, regexp_extract_all(txt, '([0-9]+) pcm', 1) as m from {_PRICE_TEXT_SQL})""")
def regex_single_match(spark, sf):
    t = _price_text(spark, sf)
    return t.select("o_orderkey", T.regex_single_match("txt", r"([0-9]+) pcm").alias("value"))


@register("parse_price", "TXT15", rf"""
select o_orderkey,
       try_cast(replace(case when len(m) = 1 then m[1] end, ',', '') as integer) as price_pcm,
       try_cast(replace(case when len(w) = 1 then w[1] end, ',', '') as integer) as price_pw
from (select o_orderkey, regexp_extract_all(txt, '([0-9,]+) pcm', 1) as m, regexp_extract_all(txt, '([0-9,]+) pw', 1) as w
      from {_PRICE_TEXT_SQL})""")
def parse_price(spark, sf):
    t = _price_text(spark, sf)
    return t.select("o_orderkey", T.parse_price("txt", "pcm").alias("price_pcm"),
                    T.parse_price("txt", "pw").alias("price_pw"))


@register("parse_url_params", "TXT16", r"""
select page_id, try_cast(case when len(m) = 1 then m[1] end as double) as page_no
from (select page_id, regexp_extract_all(url, '[?&]page=([^&#]*)', 1) as m from pages)""")
def parse_url_params(spark, sf):
    p = Tables(spark, sf).pages
    return p.select("page_id", T.url_param("url", "page").alias("page_no"))


@register("clean_string", "TXT17", """
select doc_id, coalesce(translate(text, '''"', ''), '') as cleaned from documents""")
def clean_string(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", T.clean_string("text").alias("cleaned"))


@register("right_justify", "TXT19", """
select p_partkey, repeat(' ', greatest(0, 15 - length(p_name))) || p_name as label from part""")
def right_justify(spark, sf):
    """Labels shorter and longer than the column: the longer ones are never cut."""
    return Tables(spark, sf).part.select("p_partkey", T.right_justify("p_name", 15).alias("label"))


@register("regex_single_match_lines", "TXT14", r"""
select doc_id, case when len(m) = 1 then m[1] end as value
from (select doc_id, regexp_extract_all('Price: ' || text || chr(10) || ' end', '(?s)Price: (.*) end', 1) as m from documents)""")
def regex_single_match_lines(spark, sf):
    """A value that runs over several lines."""
    d = Tables(spark, sf).documents
    txt = F.concat(F.lit("Price: "), F.col("text"), F.lit("\n end"))
    return d.select("doc_id", T.regex_single_match(txt, "Price: (.*) end").alias("value"))


@register("text_bar", "TXT19", f"""
select year, lpad(cast(year as varchar), 15, ' ') as label, repeat('*', greatest(0, cast(trunc(score / 32) as integer))) as bar
from (select year, sum(score) as score from (select d.doc_id, d.year, coalesce(s.score, 0) as score from {S.DOC_TOKENS} d left join
  (select doc_id, sum(l.valence) as score from (select doc_id, unnest(tokens) as term from {S.DOC_TOKENS}) t
   join {S.VALENCE} l using (term) group by doc_id) s using (doc_id)) group by year)""")
def text_bar(spark, sf):
    from quarry.operators import lexicon as L

    s = L.lexicon_sentiment(C.doc_tokens(spark, sf), C.valence(spark), keep=("year",))
    per_year = s.groupBy("year").agg(F.sum("score_sum").alias("score"))
    return per_year.select("year", T.right_justify("year", 15).alias("label"), T.text_bar("score", 32).alias("bar"))


# ---- dates ----

_DATE_TEXT_SQL = """(select o_orderkey, case o_orderkey % 7
    when 0 then 'today' when 1 then 'Yesterday'
    when 2 then strftime(o_orderdate, '%d/%m/%Y') || ' x'
    when 3 then strftime(o_orderdate, '%-d %B %Y') || ' (3 days ago)'
    when 4 then 'added on ' || strftime(o_orderdate, '%-d %B %Y')
    when 5 then 'rubbish' end as raw
 from orders)"""

def _date_text(spark, sf):
    o = Tables(spark, sf).orders
    k = F.col("o_orderkey") % 7
    raw = (F.when(k == 0, "today").when(k == 1, "Yesterday")
           .when(k == 2, F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" x")))
           .when(k == 3, F.concat(F.date_format("o_orderdate", "d MMMM yyyy"), F.lit(" (3 days ago)")))
           .when(k == 4, F.concat(F.lit("added on "), F.date_format("o_orderdate", "d MMMM yyyy")))
           .when(k == 5, "rubbish"))
    return o.select("o_orderkey", "o_orderdate", raw.alias("raw"))


@register("parse_flexible_date", "DAT1, DAT5", f"""
select o_orderkey, raw, {_parse_sql('raw')} as parsed from {_DATE_TEXT_SQL}""")
def parse_flexible_date(spark, sf):
    t = _date_text(spark, sf)
    return t.select("o_orderkey", "raw", D.parse_flexible_date("raw", AS_OF).alias("parsed"))


@register("days_ago_filter", "DAT2, FLT6, FLT7", f"""
select o_orderkey, cast(o_orderdate as date) as add_date from orders
where cast(o_orderdate as date) >= date '{AS_OF}' - 90 and cast(o_orderdate as date) < date '{AS_OF}'""")
def days_ago_filter(spark, sf):
    """Orders added in the 90 days before ``as_of``, today excluded.

    The bounds are compared with the raw timestamp column (midnight dates),
    so they reach the parquet scan as pushed filters (row-group skipping).
    """
    o = Tables(spark, sf).orders
    lo = D.days_ago(AS_OF, 90).cast("timestamp_ntz")
    hi = F.lit(AS_OF).cast("date").cast("timestamp_ntz")
    return o.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)).select(
        "o_orderkey", F.to_date("o_orderdate").alias("add_date"))
