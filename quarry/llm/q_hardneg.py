"""Query and SQL of operator 11."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import hardneg
from quarry.llm.frames import read


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").where(hardneg.usable(F.col("embedding")))
    rows = rows.select("vec_id", label.alias("label"), hardneg.whole(F.col("embedding")).alias("embedding"))
    return hardneg.mine(rows, F.col("vec_id") % 100 == 0)


SQL = """
with usable as (
  select row_number() over () as uid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.uid as auid, a.vec_id as anchor_id, b.uid, b.vec_id as id, a.label = b.label as same,
    cast(list_inner_product(a.v, b.v) as bigint) as score
  from usable a join usable b on a.vec_id % 100 = 0 and a.uid <> b.uid and len(a.v) = len(b.v)
), positives as (
  select *, row_number() over (partition by auid order by score desc, id nulls last) as k from pairs where same
), negatives as (
  select p.auid, p.anchor_id, p.uid as puid, p.id as positive_id, p.score as positive_score, n.id as negative_id, n.score as negative_score,
    row_number() over (partition by p.auid, p.uid order by n.score desc, n.id nulls last) as rank
  from positives p join pairs n on n.auid = p.auid and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
  where p.k <= 5
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 10"""

QUERIES = {"op11_hard_negatives": op11_hard_negatives}
ORACLE = {"op11_hard_negatives": SQL}
