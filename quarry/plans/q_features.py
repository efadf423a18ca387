"""Registered filter, feature, reshape and set queries (listing stand-in)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import dates as D
from quarry.functions import numeric as N
from quarry.operators import features as FE
from quarry.operators import lexicon as L
from quarry.plans import corpus as C
from quarry.plans import fixtures as FX
from quarry.plans import sqlfrag as S
from quarry.plans.listings import LISTINGS_SQL, listings
from quarry.plans.registry import register
from quarry.sources.tables import Tables

LAG_DAYS = 21


def _cities(spark):
    return spark.createDataFrame(FX.CITIES, "name string, lat double, long double, sq_mi double")


CITIES_SQL = ("(select * from (values " + ", ".join(f"({S.q(n)}, {a}, {b}, {c})" for n, a, b, c in FX.CITIES)
              + ") as c(name, lat, long, sq_mi))")
RADII_SQL = f"""(select name, lat, long, sqrt(sq_mi / pi()) / 0.621371 as radius_km,
  sqrt(sq_mi / pi()) / 0.621371 / 110.54 as radius_lat,
  sqrt(sq_mi / pi()) / 0.621371 / (111.32 * cos(radians(lat))) as radius_long,
  (sqrt(sq_mi / pi()) / 0.621371 / 110.54 + sqrt(sq_mi / pi()) / 0.621371 / (111.32 * cos(radians(lat)))) / 2 as radius_deg
 from {CITIES_SQL})"""
CUST_GEO_SQL = "(select c_custkey, 50.0 + (c_custkey % 800) / 100.0 as latitude, -5.0 + (c_custkey % 600) / 100.0 as longitude from customer)"


def _cust_geo(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", (F.lit(50.0) + (F.col("c_custkey") % 800) / 100.0).alias("latitude"),
                    (F.lit(-5.0) + (F.col("c_custkey") % 600) / 100.0).alias("longitude"))


@register("usable_documents", "FLT1, SRC7", f"""
select id, monthly_price, availability_lag from {LISTINGS_SQL}
where usable and availability_lag <= {LAG_DAYS} and not removed""")
def usable_documents(spark, sf):
    ls = listings(spark, sf, customer=False)
    return ls.where(F.col("usable") & (F.col("availability_lag") <= LAG_DAYS) & ~F.col("removed")).select(
        "id", "monthly_price", "availability_lag")


@register("pending_rows", "FLT2, SRC8", f"""
select id from {LISTINGS_SQL} where usable and not removed and not let_agreed and availability_lag <= {LAG_DAYS}""")
def pending_rows(spark, sf):
    ls = listings(spark, sf, customer=False)
    return ls.where(F.col("usable") & ~F.col("removed") & ~F.col("let_agreed")
                    & (F.col("availability_lag") <= LAG_DAYS)).select("id")


@register("missing_enrichment", "FLT3", f"select id, outcode_id from {LISTINGS_SQL} where num_photos is null")
def missing_enrichment(spark, sf):
    return listings(spark, sf).where(F.col("num_photos").isNull()).select("id", "outcode_id")


@register("subset_by_predicate", "FLT4, UDF1", f"""
select doc_id, source, year from {S.DOCS} where source in ('src1', 'src2', 'src3') and year between 1950 and 1999""")
def subset_by_predicate(spark, sf, predicate=None):
    d = C.documents(spark, sf)
    pred = predicate if predicate is not None else (F.col("source").isin("src1", "src2", "src3") & F.col("year").between(1950, 1999))
    return d.where(pred).select("doc_id", "source", "year")


@register("train_test_split", "FLT5", """
select doc_id, round((cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 8) as bigint) % 1000) / 1000.0, 6) as u, (cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 8) as bigint) % 1000) / 1000.0 < 0.8 as is_train from documents""")
def train_test_split(spark, sf, cutoff: float = 0.8):
    d = Tables(spark, sf).documents
    u = N.train_fraction("doc_id")
    return d.select("doc_id", F.round(u, 6).alias("u"), (u < cutoff).alias("is_train"))


@register("url_pattern_filter", "FLT8", r"""
select page_id, url from pages where regexp_matches(url, '^https?://[^/]+/en/') and not regexp_matches(url, 'utm_')""")
def url_pattern_filter(spark, sf):
    p = Tables(spark, sf).pages
    return p.where(F.col("url").rlike(r"^https?://[^/]+/en/") & ~F.col("url").rlike("utm_")).select("page_id", "url")


@register("time_to_event", "DAT4", f"""
select id, cast(case when let_agreed then datediff('day', date_advertised, latest_date) - 1 end as integer) as time_to_let from {LISTINGS_SQL}""")
def time_to_event(spark, sf):
    ls = listings(spark, sf, customer=False)
    return ls.select("id", D.time_to_event("date_advertised", "latest_date", "let_agreed").alias("time_to_let"))


@register("impute_max_plus_one", "NUM4, AGG18", f"""
with t as (select id, cast(case when let_agreed then datediff('day', date_advertised, latest_date) - 1 end as integer) as time_to_let from {LISTINGS_SQL})
select id, cast(coalesce(time_to_let, (select max(time_to_let) + 1 from t)) as integer) as time_to_let from t""")
def impute_max_plus_one(spark, sf):
    ls = listings(spark, sf, customer=False)
    t = ls.select("id", D.time_to_event("date_advertised", "latest_date", "let_agreed").alias("time_to_let"))
    return N.impute_max_plus_one(t, "time_to_let")


@register("recode_flag", "NUM3", "select c_custkey, c_mktsegment = 'FURNITURE' as furnished from customer")
def recode_flag(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", (F.col("c_mktsegment") == "FURNITURE").alias("furnished"))


@register("geo_radius", "NUM1", f"""
select r.name, round(r.radius_km, 6) as radius_km, round(r.radius_lat, 6) as radius_lat,
       round(r.radius_long, 6) as radius_long, round(r.radius_deg, 6) as radius_deg,
       count(g.c_custkey) as n_customers
from {RADII_SQL} r left join {CUST_GEO_SQL} g
  on sqrt(power(g.latitude - r.lat, 2) + power(g.longitude - r.long, 2)) < r.radius_deg
group by all""")
def geo_radius(spark, sf):
    cities = _cities(spark)
    counts = FE.points_in_cities(_cust_geo(spark, sf), cities).groupBy("name").agg(F.count(F.lit(1)).alias("n_customers"))
    return FE.city_radii(cities).join(counts, "name", "left").select(
        "name", *[F.round(c, 6).alias(c) for c in ("radius_km", "radius_lat", "radius_long", "radius_deg")],
        F.coalesce("n_customers", F.lit(0)).alias("n_customers"))


@register("geo_flags", "NUM2, JON9", f"""
select g.c_custkey,
       bool_or(r.name = 'London' and sqrt(power(g.latitude - r.lat, 2) + power(g.longitude - r.long, 2)) < r.radius_deg) as is_home,
       bool_or(r.name <> 'London' and sqrt(power(g.latitude - r.lat, 2) + power(g.longitude - r.long, 2)) < r.radius_deg) as near_other_city
from {CUST_GEO_SQL} g cross join {RADII_SQL} r group by g.c_custkey""")
def geo_flags(spark, sf):
    return FE.geo_flags(_cust_geo(spark, sf), _cities(spark)).select("c_custkey", "is_home", "near_other_city")


@register("conditional_counts", "AGG17", f"""
select outcode_id, count(*) as n, cast(count_if(let_agreed) as bigint) as n_let, cast(count_if(removed) as bigint) as n_removed,
       cast(count_if(is_share) as bigint) as n_share
from {LISTINGS_SQL} group by outcode_id""")
def conditional_counts(spark, sf):
    ls = listings(spark, sf)
    return FE.conditional_counts(ls, ["outcode_id"], {"n_let": F.col("let_agreed"), "n_removed": F.col("removed"),
                                                      "n_share": F.col("is_share")})


_SCORES_SQL = f"""(select d.doc_id, d.source, d.lang, d.year, coalesce(s.score, 0) as score from {S.DOC_TOKENS} d left join
  (select doc_id, sum(l.valence) as score from (select doc_id, unnest(tokens) as term from {S.DOC_TOKENS}) t
   join {S.VALENCE} l using (term) group by doc_id) s using (doc_id))"""


def _scores(spark, sf):
    s = L.lexicon_sentiment(C.doc_tokens(spark, sf), C.valence(spark), keep=("source", "lang", "year"))
    return s.select("doc_id", "source", "lang", "year", F.col("score_sum").alias("score"))


@register("pivot_difference", "JON10, MLR5 (arithmetic)", f"""
select year, round(avg(case when lang = 'en' then score end), 6) as v_en, round(avg(case when lang = 'fr' then score end), 6) as v_fr,
       round(avg(case when lang = 'fr' then score end) - avg(case when lang = 'en' then score end), 6) as diff
from {_SCORES_SQL} group by year""")
def pivot_difference(spark, sf):
    per = _scores(spark, sf).groupBy("year", "lang").agg(F.avg("score").alias("avg_score"))
    out = FE.pivot_difference(per, "year", "lang", "avg_score", "en", "fr")
    return out.select("year", *[F.round(c, 6).alias(c) for c in ("v_en", "v_fr", "diff")])


@register("union_results", "SET2", f"""
select 'source' as kind, source as grp, round(avg(score), 6) as avg_score from {_SCORES_SQL} group by source
union all
select 'lang' as kind, lang as grp, round(avg(score), 6) as avg_score from {_SCORES_SQL} group by lang""")
def union_results(spark, sf):
    s = _scores(spark, sf)
    a = s.groupBy(F.col("source").alias("grp")).agg(F.round(F.avg("score"), 6).alias("avg_score")).withColumn("kind", F.lit("source"))
    b = s.groupBy(F.col("lang").alias("grp")).agg(F.round(F.avg("score"), 6).alias("avg_score")).withColumn("kind", F.lit("lang"))
    return a.unionByName(b).select("kind", "grp", "avg_score")


LANG_LABELS = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}


@register("label_groups", "RSH2", """
select doc_id, lang, case lang when 'en' then 'English' when 'fr' then 'French' when 'de' then 'German' when 'es' then 'Spanish' end as label
from documents""")
def label_groups(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "lang")
    return FE.label_groups(d, "lang", LANG_LABELS)


@register("balance_classes", "MLR6", """
with c as (select quality, count(*) as n from labels group by quality),
r as (select doc_id, quality, row_number() over (partition by quality order by doc_id) as rk from labels)
select doc_id, quality from r where rk <= (select min(n) from c)""")
def balance_classes(spark, sf):
    lab = Tables(spark, sf).labels.select("doc_id", "quality")
    return FE.balance_classes(lab, "quality", "doc_id").select("doc_id", "quality")


@register("record_by_key", "SRC9, JON12 (inner)", """
select o.o_orderkey, c.c_name, c.c_acctbal from orders o join customer c on o.o_custkey = c.c_custkey""")
def record_by_key(spark, sf):
    t = Tables(spark, sf)
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "c_acctbal")


@register("fk_integrity", "JON12", """
select count(*) as n_orders, count(c.c_custkey) as n_with_customer, count(*) - count(c.c_custkey) as n_orphans
from orders o left join customer c on o.o_custkey = c.c_custkey""")
def fk_integrity(spark, sf):
    t = Tables(spark, sf)
    j = t.orders.select("o_custkey").join(t.customer.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.agg(F.count(F.lit(1)).alias("n_orders"), F.count("c_custkey").alias("n_with_customer"),
                 (F.count(F.lit(1)) - F.count("c_custkey")).alias("n_orphans"))


@register("scalar_count", "SRC10", """
select count(*) as n_let, max(o_totalprice) as max_price_let, (select max(o_totalprice) from orders where o_orderstatus = 'X') as none_value
from orders where o_orderstatus = 'F'""")
def scalar_count(spark, sf):
    o = Tables(spark, sf).orders
    a = o.where(F.col("o_orderstatus") == "F").agg(F.count(F.lit(1)).alias("n_let"), F.max("o_totalprice").alias("max_price_let"))
    b = o.where(F.col("o_orderstatus") == "X").agg(F.max("o_totalprice").alias("none_value"))
    return a.crossJoin(F.broadcast(b))
