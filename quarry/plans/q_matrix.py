"""Registered document-term / TF-IDF / ranking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import lexicon as L
from quarry.operators import matrix as M
from quarry.plans import corpus as C
from quarry.plans import sqlfrag as S
from quarry.plans.registry import register
from quarry.sources.tables import Tables, row_count


def _dtm(spark, sf):
    return M.doc_term_matrix(C.dealt_tokens(spark, sf))


def _n_docs(spark, sf):
    return row_count(spark, sf, "documents")


def _tfidf(spark, sf):
    return M.tf_idf(_dtm(spark, sf), _n_docs(spark, sf))


@register("vocabulary", "AGG4, SET1", f"""
select term, row_number() over (order by term) - 1 as term_index
from (select distinct unnest(tokens) as term from {S.DOC_TOKENS})""")
def vocabulary(spark, sf):
    return M.vocabulary(C.doc_tokens(spark, sf))


@register("corpus_size", "AGG5", f"""
select (select count(*) from documents) as n_docs,
       (select count(distinct term) from (select unnest(tokens) as term from {S.DOC_TOKENS})) as n_terms""")
def corpus_size(spark, sf):
    return M.corpus_size(C.doc_tokens(spark, sf))


@register("term_vector", "AGG6", f"""
with vocab as (select term, row_number() over (order by term) - 1 as term_index
               from (select distinct unnest(tokens) as term from {S.DOC_TOKENS}))
select item_id, term, count(*) as tf, term_index
from (select item_id, unnest({S.TOK2}) as term from benchmark) b join vocab using (term)
group by item_id, term, term_index""")
def term_vector(spark, sf):
    vocab = M.vocabulary(C.doc_tokens(spark, sf))
    items = Tables(spark, sf).benchmark.select(F.col("item_id"), T.word_tokens("text").alias("tokens"))
    return M.term_vector(items, vocab, id_col="item_id").select("item_id", "term", "tf", "term_index")


@register("doc_term_matrix", "AGG7", f"select doc_id, term, tf from {S.DTM}")
def doc_term_matrix(spark, sf):
    return _dtm(spark, sf)


@register("document_frequency", "AGG8", f"select term, df from {S.DF}")
def document_frequency(spark, sf):
    return M.document_frequency(_dtm(spark, sf))


@register("idf", "AGG9", f"select term, df, round(idf, 6) as idf from {S.IDF}")
def idf(spark, sf):
    return M.idf(_dtm(spark, sf), _n_docs(spark, sf)).withColumn("idf", F.round("idf", 6))


@register("tf_idf", "AGG10, AGG11, JON6", f"select doc_id, term, tf, round(tfidf, 6) as tfidf from {S.TFIDF}")
def tf_idf(spark, sf):
    return _tfidf(spark, sf).select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


@register("tfidf_int100", "AGG12, NUM6", f"""
select doc_id, term, cast(trunc(round(tfidf * 100, 9)) as integer) as w100 from {S.TFIDF}
where cast(trunc(round(tfidf * 100, 9)) as integer) <> 0""")
def tfidf_int100(spark, sf):
    return M.tfidf_int100(_tfidf(spark, sf)).select("doc_id", "term", "w100")


_RANK_DTM_SQL = f"""(select doc_id, score, row_number() over (order by score desc, doc_id) as rank from (
  select d.doc_id, cast(coalesce(s.score, 0) as double) as score from documents d left join
    (select doc_id, sum(tf) as score from {S.DTM} where term in (select term from {S.CATEGORY_DICTIONARY}) group by doc_id) s
  using (doc_id)) order by score desc, doc_id limit 10)"""
_RANK_TFIDF_SQL = f"""(select doc_id, score, row_number() over (order by score desc, doc_id) as rank from (
  select d.doc_id, cast(coalesce(s.score, 0) as double) as score from documents d left join
    (select doc_id, sum(cast(round(tfidf, 6) as decimal(18, 6))) as score from {S.TFIDF}
     where term in (select term from {S.CATEGORY_DICTIONARY}) group by doc_id) s
  using (doc_id)) order by score desc, doc_id limit 10)"""


def _rank_dtm(spark, sf):
    dtm = _dtm(spark, sf)
    return L.dict_rank(dtm, C.category_dictionary(spark), Tables(spark, sf).documents, "tf", n=10)


def _rank_tfidf(spark, sf):
    dic = C.category_dictionary(spark)
    m = M.tf_idf(_dtm(spark, sf), _n_docs(spark, sf), terms=dic)
    m = m.withColumn("w", F.round("tfidf", 6).cast("decimal(18,6)"))
    return L.dict_rank(m, C.category_dictionary(spark), Tables(spark, sf).documents, "w", n=10)


@register("dict_rank_dtm", "TOP1", f"select doc_id, score, rank from {_RANK_DTM_SQL}")
def dict_rank_dtm(spark, sf):
    return _rank_dtm(spark, sf)


@register("dict_rank_tfidf", "TOP1", f"select doc_id, round(score, 6) as score, rank from {_RANK_TFIDF_SQL}")
def dict_rank_tfidf(spark, sf):
    return _rank_tfidf(spark, sf).withColumn("score", F.round("score", 6))


@register("rank_overlap", "TOP8", f"""
select a.doc_id, a.rank as rank_a, b.rank as rank_b, b.rank - a.rank as rank_diff
from {_RANK_DTM_SQL} a join {_RANK_TFIDF_SQL} b using (doc_id)""")
def rank_overlap(spark, sf):
    return L.rank_overlap(_rank_dtm(spark, sf), _rank_tfidf(spark, sf))


@register("frobenius_norm", "AGG22", f"""
select lang, round(sqrt(sum(tfidf * tfidf)), 6) as frobenius
from {S.TFIDF} t join documents d using (doc_id) group by lang""")
def frobenius_norm(spark, sf):
    langs = Tables(spark, sf).documents.select("doc_id", "lang")
    return M.frobenius_norm(_tfidf(spark, sf), "tfidf", ["lang"], langs).withColumn("frobenius", F.round("frobenius", 6))
