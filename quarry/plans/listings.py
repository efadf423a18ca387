"""The listing record derived from the order tables, in Spark and SQL.

id = order key; outcode = the customer's nation; price from the total; the
advertised date is the order date and the latest date the last ship date;
let agreed = status F, removed = status P; lag = days from order to first
shipment; coordinates from the customer key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import numeric as N
from quarry.sources.tables import Tables

AS_OF = "2001-08-01"


def listings(spark: SparkSession, sf: str, customer: bool = True) -> DataFrame:
    """The listing record; without ``customer`` its two customer columns, and the join they need, are left out."""
    t = Tables(spark, sf)
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_items"), F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"))
    o = t.orders.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    of_customer = []
    if customer:
        c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
        o = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
        of_customer = [F.col("c_nationkey").alias("outcode_id"), F.col("c_mktsegment").alias("furnishing")]
    return o.select(
        F.col("o_orderkey").alias("id"),
        *of_customer,
        F.col("o_custkey").alias("customer_id"),
        F.floor(F.col("o_totalprice") / 100).cast("int").alias("monthly_price"),
        F.to_date("o_orderdate").alias("date_advertised"),
        F.to_date("last_ship").alias("latest_date"),
        (F.col("o_orderstatus") == "F").alias("let_agreed"),
        (F.col("o_orderstatus") == "P").alias("removed"),
        F.datediff(F.to_date("first_ship"), F.to_date("o_orderdate")).alias("availability_lag"),
        (F.col("o_orderpriority") != "5-LOW").alias("usable"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_share"),
        F.col("n_items").cast("int").alias("num_bedrooms"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("n_items").cast("int")).alias("num_photos"),
        (F.lit(50.0) + (F.col("o_custkey") % 800) / 100.0).alias("latitude"),
        (F.lit(-5.0) + (F.col("o_custkey") % 600) / 100.0).alias("longitude"),
        N.train_fraction("o_orderkey").alias("test_train"),
    )


LISTINGS_SQL = """(select o.o_orderkey as id, c.c_nationkey as outcode_id, o.o_custkey as customer_id,
  cast(floor(o.o_totalprice / 100) as integer) as monthly_price,
  cast(o.o_orderdate as date) as date_advertised, cast(li.last_ship as date) as latest_date,
  o.o_orderstatus = 'F' as let_agreed, o.o_orderstatus = 'P' as removed,
  cast(datediff('day', cast(o.o_orderdate as date), cast(li.first_ship as date)) as integer) as availability_lag,
  o.o_orderpriority <> '5-LOW' as usable, o.o_orderpriority = '1-URGENT' as is_share,
  cast(li.n_items as integer) as num_bedrooms,
  case when o.o_orderkey % 3 <> 0 then cast(li.n_items as integer) end as num_photos,
  c.c_mktsegment as furnishing,
  50.0 + (o.o_custkey % 800) / 100.0 as latitude, -5.0 + (o.o_custkey % 600) / 100.0 as longitude,
  (cast('0x' || substr(md5(cast(o.o_orderkey as varchar)), 1, 8) as bigint) % 1000) / 1000.0 as test_train
from orders o
left join (select l_orderkey, count(*) as n_items, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship
           from lineitem group by l_orderkey) li on o.o_orderkey = li.l_orderkey
left join customer c on o.o_custkey = c.c_custkey)"""
