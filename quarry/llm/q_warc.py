"""Query and SQL of operator 12."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import warc
from quarry.llm.frames import read
from quarry.session import scratch_path


def op12_warc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = scratch_path(spark, "warc")
    warc.write_warc(read(spark, sf_dir, "pages").select("page_id", "url", "html"), to)
    back = warc.read_warc(spark, to, payloads=False)
    return back.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def _base32(digest: str) -> str:
    """Of 40 hex digits: a letter for each five bits, taken from the two hex digits that they span."""
    digit = lambda at: f"(strpos('0123456789abcdef', substr({digest}, cast({at} as int), 1)) - 1)"
    pair = f"(16 * {digit('5 * i // 4 + 1')} + {digit('5 * i // 4 + 2')})"
    letter = f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + (({pair} >> (3 - (5 * i) % 4)) & 31) as int), 1)"
    return f"list_reduce(list_transform(range(32), lambda i: {letter}), lambda a, b: a || b)"


SQL = f"""
with p as (select row_number() over () as uid, page_id, url, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages),
r as (select *, row_number() over w as k, first_value(page_id) over w as first_id from p
  window w as (partition by hex order by page_id nulls first, url nulls first rows between unbounded preceding and unbounded following))
select page_id, payload_bytes, {_base32("hex")} as payload_digest, case when k = 1 then 'response' else 'revisit' end as record_type,
  case when k > 1 then first_id end as refers_to from r"""

QUERIES = {"op12_warc_files": op12_warc_files}
ORACLE = {"op12_warc_files": SQL}
