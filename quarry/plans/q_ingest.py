"""Registered ingestion / state queries (ING*, SNK7-9, JON4-5, JON11, TOP7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import dates as D
from quarry.functions import html as H
from quarry.functions import text as T
from quarry.operators import ingest as I
from quarry.operators.cleaning import clean_tokens
from quarry.operators.util import explode_nonempty
from quarry.plans import corpus as C
from quarry.plans import sqlfrag as S
from quarry.plans.listings import AS_OF, LISTINGS_SQL, listings
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources.tables import Tables

STORED_BEFORE = "2024-01-16"
LAG_FAIL = -2300
KEY_ARG = " 3 7  12 "


@register("new_keys_only", "JON4, SET4", """
select c_custkey from customer where c_custkey not in (
  select o_custkey from orders where o_custkey is not null and o_orderdate < timestamp '1996-01-01')""")
def new_keys_only(spark, sf):
    """Customers not seen among the orders already stored (those before 1996)."""
    t = Tables(spark, sf)
    stored = t.orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return I.new_keys_only(t.customer.select("c_custkey"), stored, "c_custkey", "o_custkey")


@register("insert_if_absent", "SNK7, JON5", """
select c_custkey as key_id, true as completed from customer where c_acctbal < 0
union all
select c_custkey as key_id, false as completed from customer
where c_custkey not in (select c_custkey from customer where c_acctbal < 0)""")
def insert_if_absent(spark, sf):
    """Ledger of keys: rows started earlier (negative balance) keep their state,
    every other customer key is inserted once as not completed."""
    c = Tables(spark, sf).customer
    existing = c.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("key_id"), F.lit(True).alias("completed"))
    new = c.select(F.col("c_custkey").alias("key_id"), F.lit(False).alias("completed"))
    return I.insert_if_absent(existing, new, "key_id")


@register("upsert_by_key", "SNK8, JON11", """
select o.o_orderkey, coalesce(u.st, o.o_orderstatus) as o_orderstatus, round(coalesce(u.price, o.o_totalprice), 2) as o_totalprice
from orders o left join (select l_orderkey, 'R' as st, sum(l_extendedprice) as price from lineitem
                         where l_returnflag = 'R' group by l_orderkey) u on o.o_orderkey = u.l_orderkey""")
def upsert_by_key(spark, sf):
    t = Tables(spark, sf)
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    upd = (t.lineitem.where(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("o_orderkey"))
           .agg(F.lit("R").alias("o_orderstatus"), F.sum("l_extendedprice").alias("o_totalprice")))
    out = I.upsert_by_key(base, upd, "o_orderkey", ["o_orderstatus", "o_totalprice"])
    return out.withColumn("o_totalprice", F.round("o_totalprice", 2))


_DATE_TEXT_SQL = """(select o_orderkey, case o_orderkey % 7
    when 0 then 'today' when 1 then 'Yesterday'
    when 2 then strftime(o_orderdate, '%d/%m/%Y') || ' x'
    when 3 then strftime(o_orderdate, '%-d %B %Y') || ' (3 days ago)'
    when 4 then 'added on ' || strftime(o_orderdate, '%-d %B %Y')
    when 5 then 'rubbish' end as raw
 from orders)"""


@register("quarantine_rows", "SNK9, TXT18, DAT3", f"""
select o_orderkey, raw, case when raw is null then 'missing' else 'unparseable' end as reason,
       strftime(timestamp '{AS_OF} 00:00:00', '%Y-%m-%d %H:%M:%S') as logged_at
from {_DATE_TEXT_SQL}
where raw is null or (lower(trim(regexp_replace(raw, '(?i)^added on ', ''))) not in ('today', 'now', 'yesterday')
  and coalesce(cast(try_strptime(substr(trim(regexp_replace(raw, '(?i)^added on ', '')), 1, 10), '%d/%m/%Y') as date),
               case when contains(raw, ' (') then cast(try_strptime(split_part(trim(regexp_replace(raw, '(?i)^added on ', '')), ' (', 1), '%d %B %Y') as date) end) is null)""")
def quarantine_rows(spark, sf):
    from quarry.plans.q_html import _date_text

    t = _date_text(spark, sf).withColumn("parsed", D.parse_flexible_date("raw", AS_OF))
    _, errors = I.quarantine(t, {"missing": F.col("raw").isNull(), "unparseable": F.col("parsed").isNull()},
                             as_of_ts=f"{AS_OF} 00:00:00")
    return errors.select("o_orderkey", "raw", "reason", D.timestamp_string("logged_at").alias("logged_at"))


@register("completed_partitions", "ING2", f"""
select outcode_id, bool_and(coalesce(availability_lag, 0) >= {LAG_FAIL}) as completed, count(*) as n_records
from {LISTINGS_SQL} group by outcode_id having bool_and(coalesce(availability_lag, 0) >= {LAG_FAIL})""")
def completed_partitions(spark, sf):
    ls = listings(spark, sf)
    return I.completed_partitions(ls, "outcode_id", F.coalesce(F.col("availability_lag"), F.lit(0)) >= LAG_FAIL)


@register("pending_partitions", "ING1", f"""
select n_nationkey as outcode_id from nation where n_nationkey not in (
  select outcode_id from {LISTINGS_SQL} group by outcode_id having bool_and(coalesce(availability_lag, 0) >= {LAG_FAIL}))""")
def pending_partitions(spark, sf):
    ls = listings(spark, sf)
    ledger = I.completed_partitions(ls, "outcode_id", F.coalesce(F.col("availability_lag"), F.lit(0)) >= LAG_FAIL)
    keys = Tables(spark, sf).nation.select(F.col("n_nationkey").alias("outcode_id"))
    return I.pending_partitions(keys, ledger, "outcode_id")


@register("ledger_process", "ING1, ING2", f"""
select n_nationkey as outcode_id, coalesce(ok, true) as completed, case when coalesce(ok, true) then 'finish' else 'failed' end as last_event, 'second' as last_run
from nation left join (select outcode_id, bool_and(coalesce(availability_lag, 0) >= {LAG_FAIL}) as ok from {LISTINGS_SQL} group by outcode_id) l on l.outcode_id = n_nationkey""")
def ledger_process(spark, sf):
    """A run that starts a third of the outcodes and is lost, then one that takes up those and the others."""
    from quarry.operators.commits import Ledger

    ledger = Ledger(spark, scratch_path(spark, "ledger"), "outcode_id")
    keys = Tables(spark, sf).nation.select(F.col("n_nationkey").cast("long").alias("outcode_id"))
    ledger.record(keys.where(F.col("outcode_id") % 3 == 0), "start", "first")
    ok = F.coalesce(F.col("availability_lag"), F.lit(0)) >= LAG_FAIL
    records = listings(spark, sf).select(F.col("outcode_id").cast("long").alias("outcode_id"), ok.alias("ok"))
    ledger.process(keys, lambda todo: records.join(F.broadcast(todo), "outcode_id"), "second")  # a row an outcode
    return ledger.state().select("outcode_id", "completed", "last_event", "last_run")


@register("upsert_merge_on_read", "SNK8, JON11 (storage)", """
select o.o_orderkey, case when o.o_custkey % 20 = 0 then 'C' else coalesce(u.st, o.o_orderstatus) end as o_orderstatus,
       round(coalesce(u.price, o.o_totalprice), 2) as o_totalprice
from orders o left join (select l_orderkey, 'R' as st, sum(l_extendedprice) as price from lineitem
                         where l_returnflag = 'R' group by l_orderkey) u on o.o_orderkey = u.l_orderkey""")
def upsert_merge_on_read(spark, sf):
    """Orders stored by key; an update of two columns, a compaction, then one of one column, merged where they are read."""
    from quarry.operators.commits import KeyedTable

    t = Tables(spark, sf)
    stored = KeyedTable(spark, scratch_path(spark, "orders"), "o_orderkey", "o_orderkey long, o_orderstatus string, o_totalprice double")
    stored.create(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"))
    stored.update(t.lineitem.where(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("o_orderkey"))
                  .agg(F.lit("R").alias("o_orderstatus"), F.sum("l_extendedprice").alias("o_totalprice")))
    stored.compact()
    stored.update(t.orders.where(F.col("o_custkey") % 20 == 0).select("o_orderkey", F.lit("C").alias("o_orderstatus")))
    return stored.read().withColumn("o_totalprice", F.round("o_totalprice", 2))


_BATCH_SQL = "(select * from events union all select * from events where event_type = 'click')"


@register("ingest_batch", "ING3", f"""
select event_id, ts, user_id, event_type, value, props
from (select distinct * from {_BATCH_SQL}) b
where event_id not in (select event_id from events where ts < timestamp '{STORED_BEFORE}')
  and value is not null and try_cast(json_extract_string(props, '$.k') as integer) is not null""")
def ingest_batch(spark, sf):
    ev = Tables(spark, sf).events
    batch = ev.unionByName(ev.where(F.col("event_type") == "click"))  # re-sent rows
    known = ev.where(F.col("ts") < F.lit(STORED_BEFORE).cast("timestamp_ntz")).select("event_id")
    k = F.get_json_object("props", "$.k").try_cast("int")
    good, _ = I.ingest_batch(batch, known, "event_id", "ts",
                             {"no_value": F.col("value").isNull(), "bad_props": k.isNull()})
    return good.select("event_id", "ts", "user_id", "event_type", "value", "props")


@register("ingest_stream", "ING3 (stream), SNK9", f"""
select event_id, ts, user_id, event_type, value, props, case when value is null or value < 1 then 'no_value' when user_id % 10 = 0 then 'bad_user' end as reason
from events where event_id % 7 <> 0""")
def ingest_stream(spark, sf):
    """Two file drops of ``events`` drained by an availableNow stream: every seventh id is
    stored already, rows without a value or of certain users are quarantined."""
    from quarry.streaming.ingest import ingest_stream as run

    ev = Tables(spark, sf).events
    src, sink, bad, ckpt = (scratch_path(spark, n) for n in ("events_src", "events_sink", "events_bad", "events_ckpt"))
    known = ev.where(F.col("event_id") % 7 == 0).select("event_id")
    checks = {"no_value": F.col("value").isNull() | (F.col("value") < 1), "bad_user": F.col("user_id") % 10 == 0}
    first = ev.where(F.col("ts") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))
    first.write.parquet(f"{src}/drop=1")
    run(spark, f"{src}/drop=1", ev.schema, sink, ckpt, "event_id", "ts", known, checks, bad)
    # second drop overlaps the first (re-sent clicks) and brings the rest
    second = ev.where(F.col("ts") >= F.lit(STORED_BEFORE).cast("timestamp_ntz")).unionByName(
        first.where(F.col("event_type") == "click"))
    second.write.parquet(f"{src}/drop=2")
    good, errors = run(spark, f"{src}/drop=*", ev.schema, sink, ckpt, "event_id", "ts", known, checks, bad)
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(errors.drop("logged_at")).select(*ev.columns, "reason")


@register("status_refresh", "ING4", """
select user_id, arg_min(removed, (ts, not removed)) as removed, arg_min(let_agreed, (ts, not removed)) as let_agreed, min(ts) as flagged_ts
from (select user_id, ts, event_type = 'signup' as removed, event_type = 'purchase' as let_agreed from events
      where event_type in ('signup', 'purchase')) group by user_id""")
def status_refresh(spark, sf):
    ev = Tables(spark, sf).events
    return I.status_refresh(ev, "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "purchase")


@register("status_refresh_stream", "ING4 (stream)", """
select user_id, arg_min(removed, (ts, not removed)) as removed, arg_min(let_agreed, (ts, not removed)) as let_agreed, min(ts) as flagged_ts
from (select user_id, ts, event_type = 'signup' as removed, event_type = 'purchase' as let_agreed from events
      where event_type in ('signup', 'purchase')) group by user_id""")
def status_refresh_stream(spark, sf):
    """The status refresh as a stateful stream over two file drops of ``events``."""
    from quarry.streaming.ingest import status_refresh_stream as run

    ev = Tables(spark, sf).events
    src, sink, ckpt = (scratch_path(spark, n) for n in ("polls_src", "polls_sink", "polls_ckpt"))
    cut = F.lit(STORED_BEFORE).cast("timestamp_ntz")
    ev.where(F.col("ts") < cut).write.parquet(f"{src}/drop=1")
    args = ("user_id", "ts", "event_type = 'signup'", "event_type = 'purchase'")
    run(spark, f"{src}/drop=*", ev.schema, sink, ckpt, *args)
    ev.where(F.col("ts") >= cut).write.parquet(f"{src}/drop=2")
    return run(spark, f"{src}/drop=*", ev.schema, sink, ckpt, *args)


@register("enrich_missing", "ING5", f"""
select l.id, coalesce(l.num_photos, cast(v.n as integer)) as num_photos
from {LISTINGS_SQL} l left join (select l_orderkey, count(*) as n from lineitem group by l_orderkey) v on l.id = v.l_orderkey""")
def enrich_missing(spark, sf):
    ls = listings(spark, sf, customer=False).select("id", "num_photos")
    vals = Tables(spark, sf).lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.count(F.lit(1)).cast("int").alias("num_photos"))
    return I.enrich_missing(ls, vals, "id", "num_photos").select("id", "num_photos")


@register("select_keys", "ING7", f"""
select c_custkey, c_nationkey from customer where c_nationkey in (
  select cast(x as integer) from (select unnest(string_split({S.q(KEY_ARG)}, ' ')) as x) where x <> '')""")
def select_keys(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_nationkey")
    return I.select_keys(c, "c_nationkey", KEY_ARG)


_CLEAN_SQL = r"""regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'),
                 '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g')"""


@register("first_seen_ids", "TOP7", rf"""
select substr(link, 2) as link_id, arg_min(page_id, (page_id, pos)) as page_id, arg_min(pos, (page_id, pos)) as pos
from (select page_id, unnest(l) as link, unnest(range(0, len(l))) as pos
      from (select page_id, list_transform(regexp_extract_all({_CLEAN_SQL}, '(?i)href\s*=\s*("[^"]*"|''[^'']*'')', 1), lambda q: q[2:-2]) as l from pages))
where regexp_full_match(link, '/[^/?#]+')
group by link""")
def first_seen_ids(spark, sf):
    p = Tables(spark, sf).pages
    ex = explode_nonempty(p, ["page_id"], H.links("html"), "link", "pos").where(F.col("link").rlike(r"^/[^/?#]+$"))
    out = I.first_seen(ex, "link", ["page_id", "pos"])
    return out.select(F.substr("link", F.lit(2)).alias("link_id"), "page_id", F.col("pos").cast("long").alias("pos"))


@register("clean_text", "ING6, TXT7, TXT8, TXT10", f"""
select doc_id, len(g) as n_tokens, array_to_string(g, ' ') as tokens_joined from (
  select doc_id, case when len(t) >= 12 then t end as g from (
    select doc_id, list_filter(list_filter(list_filter(list_transform({S.TOK2},
        lambda x: trim(trim(trim(regexp_replace(x, '[^\\x00-\\x7F]', '', 'g'), ' '), '-'), '_')), lambda x: x <> ''),
        lambda x: not list_contains({S.STOPWORD_LIST}, x)), lambda x: not regexp_matches(x, '\\p{{N}}')) as t
    from documents))""")
def clean_text(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text")
    out = clean_tokens(d, stop=C.stopwords(spark))
    return out.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), T.join_tokens("tokens").alias("tokens_joined"))
