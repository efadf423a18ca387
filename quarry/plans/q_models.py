"""Registered stemming, topic-model, SVD and random-forest jobs (rows-only checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import dates as D
from quarry.functions import numeric as N
from quarry.functions import text as T
from quarry.functions.stemmer import stem_map
from quarry.operators import lda as LDA
from quarry.operators import learn as LR
from quarry.operators import lexicon as L
from quarry.operators import matrix as M
from quarry.operators import similarity as SIM
from quarry.operators import topics as TP
from quarry.operators.cleaning import clean_tokens, speech_tokens
from quarry.operators.util import checkpoint
from quarry.plans import corpus as C
from quarry.plans import sqlfrag as S
from quarry.plans.listings import LISTINGS_SQL, listings
from quarry.plans.q_features import LAG_DAYS
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources.tables import Tables, row_count

K_TOPICS = 5
# Two authors (the second in late years only), two overlapping sets of authors and years, two languages.
LSA_GROUPS = {
    "author_a": "source = 'src0'",
    "author_b": "source = 'src1' and year > 1949",
    "early": "year < 1950 or source = 'src0'",
    "late": "year >= 1950 or source = 'src1'",
    "de": "lang = 'de'",
    "fr": "lang = 'fr'",
}
LSA_ANALYSES = {1: ("author_a", "author_b"), 2: ("early", "late"), 3: ("de", "fr")}

@register("stem_vocabulary", "TXT9, UDF2")
def stem_vocabulary(spark, sf):
    return stem_map(M.explode_terms(C.doc_tokens(spark, sf)), "term")


def _clean_stemmed(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text")
    return clean_tokens(d, stop=C.stopwords(spark), stem=True)


@register("speech_compat", "TXT1, TXT6, JON3, TXT9 (q1 option)")
def speech_compat(spark, sf):
    """Speech cleaning with the stemmed-stopword comparison of the old code (q1)."""
    d = Tables(spark, sf).documents.select("doc_id", "text")
    out = speech_tokens(d, stop=C.stopwords(spark), stopword_stage="before", stem_stopwords=True)
    return out.select("doc_id", F.size("tokens").alias("n_tokens"), T.join_tokens("tokens").alias("tokens_joined"))


@register("clean_text_stemmed", "ING6 (with TXT9)")
def clean_text_stemmed(spark, sf):
    out = _clean_stemmed(spark, sf)
    return out.select("doc_id", F.size("tokens").alias("n_tokens"), T.join_tokens("tokens").alias("tokens_joined"))


#: Where a session keeps the fit of each folder and weighting: six queries read one fit.
_FITS: dict[tuple[str, str, str], str] = {}


def _lda(spark, sf, weighting="counts"):
    """``(model, cells, projections)`` of the listing descriptions, fitted once a session and kept on disk."""
    key = (spark.sparkContext.applicationId, sf, weighting)
    if key not in _FITS:
        docs = checkpoint(_clean_stemmed(spark, sf).where(F.col("tokens").isNotNull()))
        cells, value = M.doc_term_matrix(docs), "tf"
        if weighting == "tfidf":
            cells, value = M.tfidf_int100(M.tf_idf(cells, docs.agg(F.count(F.lit(1)).alias("n_docs")))), "w100"
        vocab, cells = LDA.index_terms(cells, value)
        train = checkpoint(cells.where(N.train_fraction("doc_id") < 0.8))
        model = LDA.fit(train, vocab, k=K_TOPICS, max_iter=50, seed=1)
        path = scratch_path(spark, "lda")
        cells.write.parquet(f"{path}/cells")
        LDA.project(model, cells).write.parquet(f"{path}/projections")
        model.save(f"{path}/model")
        _FITS[key] = path
    path = _FITS[key]
    return LDA.TopicTable.load(spark, f"{path}/model"), spark.read.parquet(f"{path}/cells"), spark.read.parquet(f"{path}/projections")


@register("lda_fit", "LDA1")
def lda_fit(spark, sf):
    model, cells, _ = _lda(spark, sf)
    ll, lp = LDA.bound(model, cells.where(N.train_fraction("doc_id") < 0.8))
    return spark.createDataFrame([(K_TOPICS, model.vocabulary.count(), ll, lp)], "k int, vocab_size long, log_likelihood double, log_perplexity double")


@register("lda_project", "LDA2, RSH3")
def lda_project(spark, sf):
    return _lda(spark, sf)[2]


@register("lda_saved", "SNK4, SRC12, LDA2")
def lda_saved(spark, sf):
    """The projections that are stored beside those by the loaded model."""
    model, cells, stored = _lda(spark, sf)
    return stored.join(LDA.project(model, cells, prefix="loaded"), "doc_id")


@register("topic_top_words", "TOP2, LDA4")
def topic_top_words(spark, sf):
    return LDA.top_words(_lda(spark, sf)[0], n=10)


@register("doc_top_topics", "TOP3")
def doc_top_topics(spark, sf):
    return TP.doc_top_topics(_lda(spark, sf)[2], k=K_TOPICS, n=3)


@register("lda_fit_tfidf", "LDA3, AGG12")
def lda_fit_tfidf(spark, sf):
    return _lda(spark, sf, "tfidf")[2]


def _gibbs(spark, sf, max_iter=20):
    d = C.doc_tokens(spark, sf).select("doc_id", T.token_clean("tokens", 2).alias("tokens"))
    d = L.stopword_remove(d, C.stopwords(spark))
    return TP.gibbs_lda(M.doc_term_matrix(d), k=K_TOPICS, max_iter=max_iter, cutoff=0.01, seed=7)


@register("gibbs_lda", "LIN4, AGG22")
def gibbs_lda(spark, sf):
    return _gibbs(spark, sf)[0]


_GIBBS_TOKENS_SQL = rf"""(select doc_id, list_filter({S.TOK2}, lambda x: regexp_full_match(x, '\p{{L}}+') and length(x) > 2
  and not list_contains({S.STOPWORD_LIST}, x)) as t from documents)"""


@register("gibbs_invariants", "LIN4", f"""
select doc_id, len(t) as n_tokens, 1.0 as theta_sum, {K_TOPICS} as n_topics from {_GIBBS_TOKENS_SQL} where len(t) > 0""")
def gibbs_invariants(spark, sf):
    """What every state of the sampler must keep: a document's topic counts add up to its
    tokens, its topic weights to one."""
    theta, _, _, counts = _gibbs(spark, sf, max_iter=2)
    n = counts.groupBy("doc_id").agg(F.sum("n").alias("n_tokens"))
    t = theta.groupBy("doc_id").agg(F.round(F.sum("p"), 6).alias("theta_sum"), F.count(F.lit(1)).cast("int").alias("n_topics"))
    return n.join(t, "doc_id")


def _topic_report(spark, sf):
    from quarry.sources.sinks import write_topic_report

    theta, beta, _, _ = _gibbs(spark, sf)
    path = scratch_path(spark, "topic_report")
    write_topic_report(beta, theta, path, n_words=10, n_topics=3)
    return path


@register("topic_report", "SNK5, TOP2")
def topic_report(spark, sf):
    """Top 10 words per topic of the sampler's B, written as JSON and read back."""
    return spark.read.schema("topic int, rank int, term string, p double").json(f"{_topic_report(spark, sf)}/words")


@register("topic_report_documents", "SNK5, TOP3")
def topic_report_documents(spark, sf):
    """Top 3 topics per document of the sampler's T, written as JSON and read back."""
    return spark.read.schema("doc_id long, topic int, rank int, p double").json(f"{_topic_report(spark, sf)}/documents")


_FRAME_SQL = f"""
with d as (select count(*) as n_docs from documents),
pol as (select doc_id,
    (count(case when polarity > 0 then 1 end) - count(case when polarity < 0 then 1 end)) /
      (count(case when polarity > 0 then 1 end) + count(case when polarity < 0 then 1 end) + 1e-6) as sent_pol,
    (count(case when polarity > 0 then 1 end) + count(case when polarity < 0 then 1 end)) / (count(term) + 1e-6) as sent_subj
  from (select doc_id, unnest(case when len(tokens) = 0 then [NULL] else tokens end) as term from {S.DOC_TOKENS}) t
  left join {S.CATEGORIES} c using (term) group by doc_id),
l as (select *, case when let_agreed then datediff('day', date_advertised, latest_date) - 1 end as t
  from {LISTINGS_SQL} where usable and not removed and availability_lag <= {LAG_DAYS})
select l.id, cast(coalesce(l.t, (select max(t) + 1 from l)) as double) as time_to_let, cast(is_share as double) as is_share,
  cast(coalesce(num_bedrooms, 0) as double) as num_bedrooms, cast(availability_lag as double) as availability_lag,
  cast(monthly_price as double) as monthly_price, cast(coalesce(furnishing = 'FURNITURE', false) as double) as furnished,
  round(latitude, 6) as latitude, round(longitude, 6) as longitude, round(coalesce(sent_pol, 0), 6) as sent_pol,
  round(coalesce(sent_subj, 0), 6) as sent_subj, test_train
from l cross join d left join pol on pol.doc_id = l.id % d.n_docs"""


@register("analysis_frame", "MLR1 (frame), DAT4, NUM3, NUM4, FLT1", _FRAME_SQL)
def analysis_frame(spark, sf):
    f = _analysis_frame(spark, sf)
    return f.select("id", "time_to_let", "is_share", "num_bedrooms", "availability_lag", "monthly_price", "furnished",
                    *[F.round(c, 6).alias(c) for c in ("latitude", "longitude", "sent_pol", "sent_subj")], "test_train")


def _analysis_frame(spark, sf):
    """Usable listings that are not removed, available within the lag, with their description's sentiment.

    Listing ``id`` is described by document ``id mod n``.
    """
    ls = listings(spark, sf).where(F.col("usable") & ~F.col("removed") & (F.col("availability_lag") <= LAG_DAYS))
    n = row_count(spark, sf, "documents").first()[0]
    pol = L.polarity_subjectivity(C.doc_tokens(spark, sf), C.categories(spark)).select(
        F.col("doc_id").alias("_doc"), F.col("polarity").alias("sent_pol"), F.col("subjectivity").alias("sent_subj"))
    f = ls.withColumn("_doc", F.pmod("id", F.lit(max(1, n)))).join(pol, "_doc", "left").fillna(0.0, ["sent_pol", "sent_subj"])
    f = f.withColumn("time_to_let", D.time_to_event("date_advertised", "latest_date", "let_agreed"))
    f = N.impute_max_plus_one(f, "time_to_let")
    f = f.withColumn("furnished", F.coalesce(F.col("furnishing") == "FURNITURE", F.lit(False)).cast("double")).fillna(0, ["num_bedrooms"])
    cols = ["time_to_let", "is_share", "num_bedrooms", "availability_lag", "monthly_price", "furnished",
            "latitude", "longitude", "sent_pol", "sent_subj", "test_train"]
    return checkpoint(f.select("id", *[F.col(c).cast("double").alias(c) for c in cols]))


REG_FEATURES = ["is_share", "num_bedrooms", "availability_lag", "monthly_price", "furnished"]
FEATURE_SETS = {
    1: [*REG_FEATURES, "latitude", "longitude"],
    2: ["sent_pol", "sent_subj", "latitude", "longitude"],
    3: [*REG_FEATURES, "latitude", "longitude", "sent_pol", "sent_subj"],
}
RF_ARGS = dict(num_trees=500, max_depth=30, min_instances=7, seed=12345)


@register("rf_time_regression", "MLR1, MLR4")
def rf_time_regression(spark, sf):
    f = _analysis_frame(spark, sf)
    return LR.rf_regression(f, REG_FEATURES, "time_to_let", **RF_ARGS).select("id", "time_to_let", "pred")


@register("rf_classify", "MLR2, NUM5")
def rf_classify(spark, sf):
    f = _analysis_frame(spark, sf)
    pred = LR.rf_regression(f, REG_FEATURES, "time_to_let", **RF_ARGS)
    lab = pred.withColumn("better_value", (F.col("time_to_let") < F.col("pred")).cast("double"))
    return LR.rf_classify(lab, FEATURE_SETS[3], "better_value", **RF_ARGS).select("id", "better_value", "pred_class")


def _sweep(spark, sf):
    return LR.feature_set_sweep(_analysis_frame(spark, sf), "time_to_let", REG_FEATURES, FEATURE_SETS, seps=range(-4, 5), **RF_ARGS)


@register("feature_set_sweep", "MLR3, AGG19, SET2, RSH2")
def feature_set_sweep(spark, sf):
    return _sweep(spark, sf)


@register("accuracy_lift", "MLR5, AGG20, JON10, SNK3")
def accuracy_lift(spark, sf):
    """The lift per offset and its mean, written as CSV and read back."""
    from quarry.sources.sinks import write_results_csv

    path = scratch_path(spark, "improvement")
    write_results_csv(LR.accuracy_lift(_sweep(spark, sf)), path)
    return spark.read.option("header", "true").schema("sep int, lift double").csv(path)


def _doc_cells(spark, sf):
    d = C.dealt_tokens(spark, sf)
    n = row_count(spark, sf, "documents")
    return M.tf_idf(M.doc_term_matrix(d), n)


@register("lsa_embed", "LIN2")
def lsa_embed(spark, sf):
    us, _ = SIM.lsa_embed(_doc_cells(spark, sf), 10)
    return us


@register("lsa_group_sweep", "LIN3, SNK2")
def lsa_group_sweep(spark, sf):
    """Three analyses over k = 0, 10, .., 10 * floor(N / 10) of one whole SVD."""
    cells = checkpoint(_doc_cells(spark, sf))
    us = checkpoint(SIM.lsa_embed_whole(cells))
    docs = Tables(spark, sf).documents.withColumn("year", C.year_of("doc_id"))
    named = F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in LSA_GROUPS.items()])
    groups = docs.select("doc_id", F.explode(F.array_compact(named)).alias("grp"))
    n = row_count(spark, sf, "documents").first()[0]
    return SIM.lsa_analyses(us, SIM.unit_rows(cells), groups, LSA_ANALYSES, list(range(0, n + 1, 10)))
