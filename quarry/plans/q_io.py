"""Registered source / sink round trips (rows-only checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import matrix as M
from quarry.operators.ingest import new_keys_only
from quarry.plans import corpus as C
from quarry.plans import fixtures as FX
from quarry.plans import sqlfrag as S
from quarry.plans.q_similarity import GROUP_COSINE_SQL
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import readers as R
from quarry.sources import sinks as W
from quarry.sources.tables import Tables


@register("write_speeches_json", "SNK1", f"select doc_id, year, source as author, text from {S.DOCS}")
def write_speeches_json(spark, sf):
    d = C.documents(spark, sf).select("year", F.col("source").alias("author"), "text", "doc_id")
    path = scratch_path(spark, "speeches_json")
    W.write_speeches_json(d, path)
    return spark.read.schema("doc_id long, year int, author string, text string").json(path)


@register("read_json_speeches", "SRC1", f"select year, source as author, text from {S.DOCS}")
def read_json_speeches(spark, sf):
    """Positional JSON arrays ``[year, author, text]``, one a line, written where the documents are and read back."""
    d = C.documents(spark, sf).select("year", F.col("source").alias("author"), "text")
    path = scratch_path(spark, "speeches_arrays")
    W.write_speeches_json(d, path, positional=True)
    return R.read_speech_lines(spark, path)


@register("read_corpus_text", "SRC2", f"""
select cast(year as varchar) || '_' || cast(doc_id as varchar) || '_' || source || '_***' || chr(10) || text || chr(10) as record
from {S.DOCS}""")
def read_corpus_text(spark, sf):
    from quarry.operators import segment as G

    path = scratch_path(spark, "corpus_text")
    G.write_speech_corpus(C.documents(spark, sf), path, "year", "doc_id", "source", "text")
    return R.read_corpus_text(spark, path, G.DELIMITER)


@register("read_stopwords", "SRC3", f"""
select distinct w as term from (select unnest(string_split(p_name, ' ')) as w from part) where length(w) > 4
union select term from {S.STOPWORDS} where length(term) > 4""")
def read_stopwords(spark, sf):
    """A stopword file (the list and the words of part names, one a line, repeated), words longer than 4."""
    path = scratch_path(spark, "stopwords")
    names = Tables(spark, sf).part.select(F.explode(F.split("p_name", " ")).alias("value"))
    names.unionByName(C.stopwords(spark).select(F.col("term").alias("value"))).write.text(path)
    return R.read_stopwords(spark, path, min_len_exclusive=4)


@register("read_category_dictionary", "SRC5", r"""
select distinct lower(regexp_replace(w || '#' || cast(p_size as varchar), '[#0-9]+$', '')) as term
from (select p_size, unnest(string_split(p_name, ' ')) as w from part)""")
def read_category_dictionary(spark, sf):
    """A ``;`` dictionary file with a header, its words with sense numbers, read by the file reader."""
    path = scratch_path(spark, "dictionary")
    rows = Tables(spark, sf).part.select("p_size", "p_brand", F.explode(F.split("p_name", " ")).alias("w"))
    entry = F.concat(F.upper("w"), F.lit("#"), F.col("p_size").cast("string")).alias("Entry")
    rows.select(entry, F.col("p_brand").alias("Source")).write.option("sep", ";").option("header", "true").csv(path)
    return R.read_category_dictionary(spark, path)


@register("lexicon_load", "SRC4", f"""
with w as (select term, count(*) as c from (select unnest(tokens) as term from {S.DOC_TOKENS}) group by term)
select term, cast(c % 11 - 5 as integer) as valence from w
union all
select term, valence from {S.VALENCE} where term not in (select term from w)""")
def lexicon_load(spark, sf):
    """A tab-separated lexicon file (fixture terms plus the corpus' most frequent
    words, one duplicated) read back with last-line-wins."""
    path = scratch_path(spark, "lexicon")
    words = M.explode_terms(C.doc_tokens(spark, sf)).groupBy("term").count()
    rows = words.select(F.concat_ws("\t", "term", (F.col("count") % 11 - 5).cast("string")).alias("value"))
    fixed = spark.createDataFrame([(f"{t}\t{v}",) for t, v in FX.VALENCE], "value string")
    fixed.coalesce(1).write.text(f"{path}/a_fixed")
    rows.write.text(f"{path}/b_corpus")
    return R.read_lexicon(spark, path)


_RESULTS_SQL = f"""(select 3 as analysis_num, 0 as max_singular_values,
  max(case when group_a = 'de' and group_b = 'de' then mean_cos end) as AA,
  max(case when group_a = 'de' and group_b = 'fr' then mean_cos end) as AB,
  max(case when group_a = 'fr' and group_b = 'fr' then mean_cos end) as BB
from ({GROUP_COSINE_SQL}) gc)"""


@register("write_results_csv", "SNK2, SRC6", f"select * from {_RESULTS_SQL}")
def write_results_csv(spark, sf):
    """Per-language mean cosine table written as CSV and read back with its schema."""
    from quarry.plans.q_similarity import doc_unit_rows
    from quarry.operators.similarity import group_cosine

    groups = Tables(spark, sf).documents.select("doc_id", F.col("lang").alias("grp"))
    gc = group_cosine(doc_unit_rows(spark, sf), groups, pairs=[("de", "de"), ("de", "fr"), ("fr", "fr")])
    wide = gc.withColumn("pair", F.concat("group_a", F.lit("_"), "group_b")).groupBy().pivot(
        "pair", ["de_de", "de_fr", "fr_fr"]).agg(F.first("mean_cos"))
    res = wide.select(F.lit(3).alias("analysis_num"), F.lit(0).alias("max_singular_values"),
                      F.col("de_de").alias("AA"), F.col("de_fr").alias("AB"), F.col("fr_fr").alias("BB"))
    path = scratch_path(spark, "results_csv")
    W.write_results_csv(res, path)
    back = R.read_results_csv(spark, path)
    return back.select("analysis_num", "max_singular_values", *[F.round(c, 6).alias(c) for c in ("AA", "AB", "BB")])


@register("read_results_csv", "SRC6, FLT9, RSH1, SET2", f"""
select analysis_num, max_singular_values, 'AA' as pair, AA as value, 'within A' as pair_name from {_RESULTS_SQL}
union all select analysis_num, max_singular_values, 'AB', AB, 'between' from {_RESULTS_SQL}
union all select analysis_num, max_singular_values, 'BB', BB, 'within B' from {_RESULTS_SQL}""")
def read_results_csv(spark, sf):
    """Results CSV read back, one analysis selected, AA/AB/BB unpivoted with labels."""
    from quarry.operators.features import unpivot_pairs

    res = write_results_csv(spark, sf).where(F.col("analysis_num") == 3)
    return unpivot_pairs(res, ["analysis_num", "max_singular_values"], ["AA", "AB", "BB"],
                         {"AA": "within A", "AB": "between", "BB": "within B"})


@register("matrix_roundtrip", "SNK4, SRC12", f"select doc_id, term, tf from {S.DTM}")
def matrix_roundtrip(spark, sf):
    d = C.doc_tokens(spark, sf)
    dtm = M.doc_term_matrix(d)
    path = scratch_path(spark, "dtm")
    W.write_matrix(dtm, path)
    return R.read_matrix(spark, path)


@register("append_new_records", "SNK6, JON4", "select page_id, url from pages")
def append_new_records(spark, sf):
    """Stored pages (one third by URL host hash) plus a batch of all pages: only new ids appended."""
    p = Tables(spark, sf).pages.select("page_id", "url")
    path = scratch_path(spark, "pages_store")
    p.where(F.pmod(F.hash("url"), F.lit(3)) == 0).write.parquet(path)
    stored = spark.read.parquet(path)
    W.append_rows(new_keys_only(p, stored, "page_id"), path)
    return spark.read.parquet(path)
