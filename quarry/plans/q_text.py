"""Registered text, token, lexicon and frequency queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import lexicon as L
from quarry.operators.matrix import explode_terms
from quarry.operators.util import explode_nonempty
from quarry.plans import corpus as C
from quarry.plans import sqlfrag as S
from quarry.plans.registry import register
from quarry.sources.tables import Tables


def _tok_out(df, col="tokens"):
    return df.select("doc_id", F.size(col).cast("long").alias("n_tokens"), T.join_tokens(col).alias("tokens_joined"))


@register("tokenize_wordpunct", "TXT1", f"""
select doc_id, len(t) as n_tokens, array_to_string(t, ' ') as tokens_joined
from (select doc_id, {S.TOK1} as t from documents)""")
def tokenize_wordpunct(spark, sf):
    d = Tables(spark, sf).documents
    return _tok_out(d.select("doc_id", T.wordpunct_tokens("text").alias("tokens")))


@register("tokenize_words", "TXT2, TXT5", f"""
select doc_id, len(t) as n_tokens, array_to_string(t, ' ') as tokens_joined
from (select doc_id, {S.TOK2} as t from documents)""")
def tokenize_words(spark, sf):
    d = Tables(spark, sf).documents
    return _tok_out(d.select("doc_id", T.word_tokens("text").alias("tokens")))


@register("preprocess_chars", "TXT3", f"""
select doc_id, len(t) as n_tokens, array_to_string(t, ' ') as tokens_joined
from (select doc_id, list_filter(string_split(translate(lower(text), {S.q(T.SPEECH_PUNCT)}, {S.q(' ' * len(T.SPEECH_PUNCT))}), ' '), lambda x: x <> '') as t
      from documents)""")
def preprocess_chars(spark, sf):
    d = Tables(spark, sf).documents
    return _tok_out(d.select("doc_id", T.preprocess_chars("text").alias("tokens")))


@register("preprocess_regex", "TXT4", r"""
select doc_id, len(t) as n_tokens, array_to_string(t, ' ') as tokens_joined
from (select doc_id, list_filter(regexp_split_to_array(trim(regexp_replace(lower(text), '[^\p{L}\p{N}\s]', ' ', 'g'), ' '), '\s+'), lambda x: x <> '') as t
      from documents)""")
def preprocess_regex(spark, sf):
    d = Tables(spark, sf).documents
    return _tok_out(d.select("doc_id", T.preprocess_regex("text").alias("tokens")))


@register("token_clean", "TXT6", f"""
select doc_id, len(t) as n_tokens, array_to_string(t, ' ') as tokens_joined
from (select doc_id, list_filter({S.TOK1}, lambda x: regexp_full_match(x, '\\p{{L}}+') and length(x) > 2) as t from documents)""")
def token_clean(spark, sf):
    d = Tables(spark, sf).documents
    return _tok_out(d.select("doc_id", T.token_clean(T.wordpunct_tokens("text"), 2).alias("tokens")))


@register("drop_digit_tokens", "TXT7", f"""
select doc_id, len(t) as n_tokens, array_to_string(t, ' ') as tokens_joined
from (select doc_id, list_filter({S.TOK2}, lambda x: not regexp_matches(x, '\\p{{N}}')) as t from documents)""")
def drop_digit_tokens(spark, sf):
    d = Tables(spark, sf).documents
    return _tok_out(d.select("doc_id", T.drop_digit_tokens(T.word_tokens("text")).alias("tokens")))


@register("ascii_fold_strip", "TXT8", f"""
select doc_id, len(t) as n_tokens, array_to_string(t, ' ') as tokens_joined
from (select doc_id, list_filter(list_transform({S.TOK2},
        lambda x: trim(trim(trim(regexp_replace(x, '[^\\x00-\\x7F]', '', 'g'), ' '), '-'), '_')), lambda x: x <> '') as t
      from documents)""")
def ascii_fold_strip(spark, sf):
    d = Tables(spark, sf).documents
    return _tok_out(d.select("doc_id", T.ascii_fold_tokens(T.word_tokens("text")).alias("tokens")))


@register("min_length_gate", "TXT10", f"""
select doc_id, len(g) as n_tokens, array_to_string(g, ' ') as tokens_joined
from (select doc_id, case when len(t) >= 12 then t end as g
      from (select doc_id, list_filter({S.TOK1}, lambda x: regexp_full_match(x, '\\p{{L}}+') and length(x) > 2) as t from documents))""")
def min_length_gate(spark, sf):
    d = Tables(spark, sf).documents
    toks = T.token_clean(T.wordpunct_tokens("text"), 2)
    return _tok_out(d.select("doc_id", T.min_length_gate(toks, 12).alias("tokens")))


@register("tokens_roundtrip", "TXT11", f"""
select doc_id, array_to_string(t, ' ') as stored, len(list_filter(string_split(array_to_string(t, ' '), ' '), lambda x: x <> '')) as n_tokens,
       list_filter(string_split(array_to_string(t, ' '), ' '), lambda x: x <> '') = t as same
from (select doc_id, {S.TOK2} as t from documents)""")
def tokens_roundtrip(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", T.word_tokens("text").alias("t"))
    stored = T.join_tokens("t")
    back = T.split_tokens(stored)
    return d.select("doc_id", stored.alias("stored"), F.size(back).cast("long").alias("n_tokens"), (back == F.col("t")).alias("same"))


@register("friendly_string", "TXT13", f"""
select doc_id, concat_ws(' ', cast(year as varchar), source, substring(text, 2, 19)) as friendly from {S.DOCS}""")
def friendly_string(spark, sf):
    d = C.documents(spark, sf)
    return d.select("doc_id", T.friendly_string("year", "source", "text").alias("friendly"))


@register("word_freq", "AGG1", f"""
select term as word, count(*) as n from (select unnest(tokens) as term from {S.DOC_TOKENS}) group by term""")
def word_freq(spark, sf):
    toks = explode_terms(C.doc_tokens(spark, sf))
    return toks.groupBy(F.col("term").alias("word")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word")


@register("word_length_freq", "AGG2", f"""
select cast(length(term) as integer) as word_length, count(*) as n from (select unnest(tokens) as term from {S.DOC_TOKENS}) group by 1""")
def word_length_freq(spark, sf):
    toks = explode_terms(C.doc_tokens(spark, sf))
    return toks.groupBy(F.length("term").alias("word_length")).agg(F.count(F.lit(1)).alias("n")).orderBy("word_length")


@register("doc_length_stats", "AGG3", f"""
select doc_id, cast(length(text) as integer) as n_chars, len({S.TOK2}) as n_words,
       len(list_filter(string_split(translate(lower(text), {S.q(T.SPEECH_PUNCT)}, {S.q(' ' * len(T.SPEECH_PUNCT))}), ' '), lambda x: x <> '')) as n_speech_words
from documents""")
def doc_length_stats(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", F.length("text").alias("n_chars"), F.size(T.word_tokens("text")).cast("long").alias("n_words"),
                    F.size(T.preprocess_chars("text")).cast("long").alias("n_speech_words"))


@register("kth_frequent_word", "TOP4", f"""
select source, word, n from (
  select source, term as word, count(*) as n,
         row_number() over (partition by source order by count(*) desc, term) as rk
  from (select source, unnest(tokens) as term from {S.DOC_TOKENS}) group by source, term)
where rk = 4""")
def kth_frequent_word(spark, sf, k: int = 4):
    toks = explode_nonempty(C.doc_tokens(spark, sf), ["source"], "tokens", "word")
    counts = toks.groupBy("source", "word").agg(F.count(F.lit(1)).alias("n"))
    # rank <= k lets Spark insert a partial WindowGroupLimit before the shuffle
    w = Window.partitionBy("source").orderBy(F.desc("n"), "word")
    return counts.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k).where(F.col("rk") == k).drop("rk")


@register("lexicon_sentiment", "AGG15, JON1", f"""
select doc_id, count(l.valence) as n_recognised, cast(coalesce(sum(l.valence), 0) as bigint) as score_sum,
       round(sum(l.valence) / count(l.valence), 6) as score_mean
from (select doc_id, unnest(case when len(tokens) = 0 then [NULL] else tokens end) as term from {S.DOC_TOKENS}) t
left join {S.VALENCE} l using (term)
group by doc_id""")
def lexicon_sentiment(spark, sf):
    s = L.lexicon_sentiment(C.doc_tokens(spark, sf), C.valence(spark))
    return s.withColumn("score_mean", F.round("score_mean", 6))


_SCORES_SQL = f"""(select d.doc_id, d.source, d.year, coalesce(s.score, 0) as score from {S.DOC_TOKENS} d left join
  (select doc_id, sum(l.valence) as score from (select doc_id, unnest(tokens) as term from {S.DOC_TOKENS}) t
   join {S.VALENCE} l using (term) group by doc_id) s using (doc_id))"""


def _doc_scores(spark, sf):
    s = L.lexicon_sentiment(C.doc_tokens(spark, sf), C.valence(spark), keep=("source", "year"))
    return s.select("doc_id", "source", "year", F.col("score_sum").alias("score"))


@register("avg_score_by_author", "AGG13, TOP6", f"""
select source, round(avg(score), 6) as avg_score, count(*) as n_docs from {_SCORES_SQL} group by source""")
def avg_score_by_author(spark, sf):
    out = L.avg_score_by_group(_doc_scores(spark, sf), "source", "score")
    return out.withColumn("avg_score", F.round("avg_score", 6))


@register("score_by_year", "AGG14, TOP6", f"""
select year, cast(min(score) as bigint) as min_score, round(avg(score), 6) as avg_score, count(*) as n_docs from {_SCORES_SQL} group by year""")
def score_by_year(spark, sf):
    out = L.score_by_year(_doc_scores(spark, sf), "year", "score")
    return out.withColumn("avg_score", F.round("avg_score", 6))


@register("polarity_subjectivity", "AGG16, UDF3", f"""
select doc_id, count(term) as n_tokens, count(case when polarity > 0 then 1 end) as n_pos,
       count(case when polarity < 0 then 1 end) as n_neg,
       round((count(case when polarity > 0 then 1 end) - count(case when polarity < 0 then 1 end)) /
             (count(case when polarity > 0 then 1 end) + count(case when polarity < 0 then 1 end) + 1e-6), 6) as polarity,
       round((count(case when polarity > 0 then 1 end) + count(case when polarity < 0 then 1 end)) / (count(term) + 1e-6), 6) as subjectivity
from (select doc_id, unnest(case when len(tokens) = 0 then [NULL] else tokens end) as term from {S.DOC_TOKENS}) t
left join {S.CATEGORIES} c using (term)
group by doc_id""")
def polarity_subjectivity(spark, sf):
    out = L.polarity_subjectivity(C.doc_tokens(spark, sf), C.categories(spark))
    return out.withColumn("polarity", F.round("polarity", 6)).withColumn("subjectivity", F.round("subjectivity", 6))


@register("stopword_remove", "JON3", f"""
select doc_id, len(t) as n_tokens, array_to_string(t, ' ') as tokens_joined
from (select doc_id, list_filter(tokens, lambda x: not list_contains({S.STOPWORD_LIST}, x)) as t from {S.DOC_TOKENS})""")
def stopword_remove(spark, sf):
    out = L.stopword_remove(C.doc_tokens(spark, sf), C.stopwords(spark))
    return _tok_out(out)


@register("stopword_load", "SRC3", f"""
select s.term, count(distinct t.doc_id) as n_docs
from (select distinct term from {S.STOPWORDS} where length(term) > 2) s
left join (select doc_id, unnest(tokens) as term from {S.DOC_TOKENS}) t using (term)
group by s.term""")
def stopword_load(spark, sf):
    from quarry.sources.readers import stopwords_from_df

    stop = stopwords_from_df(C.stopwords(spark), min_len_exclusive=2)
    toks = explode_terms(C.doc_tokens(spark, sf)).distinct()
    return (stop.join(toks, "term", "left").groupBy("term")
            .agg(F.count("doc_id").alias("n_docs")))


@register("dictionary_normalize", "SRC5, TXT20, SET5", r"""
select distinct lower(regexp_replace(raw, '[#0-9]+$', '')) as term
from (select upper(w) || case when p_partkey % 2 = 0 then '#' || cast(p_partkey % 3 + 1 as varchar) else '' end as raw
      from (select p_partkey, unnest(string_split(p_name, ' ')) as w from part))""")
def dictionary_normalize(spark, sf):
    part = Tables(spark, sf).part
    raw = part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("w")).select(
        F.concat(F.upper("w"), F.when(F.col("p_partkey") % 2 == 0,
                                     F.concat(F.lit("#"), (F.col("p_partkey") % 3 + 1).cast("string")))
                 .otherwise(F.lit(""))).alias("raw"))
    return raw.select(T.strip_dictionary_suffix("raw").alias("term")).distinct().orderBy("term")


@register("dictionary_terms_in_corpus", "JON2, SET3", f"""
select term from {S.CATEGORY_DICTIONARY} where term in (select unnest(tokens) from {S.DOC_TOKENS})""")
def dictionary_terms_in_corpus(spark, sf):
    vocab = explode_terms(C.doc_tokens(spark, sf))
    return L.dictionary_terms_in_corpus(C.category_dictionary(spark), vocab)
