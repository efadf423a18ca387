"""Query of operator 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import urls
from quarry.llm.frames import read

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("allow", "com/fr/"), ("block", "com/de/"), ("block", "example.org/en/1")]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urls.url_filter(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH p AS (
  SELECT page_id, url, strpos(coalesce(url, ''), '://') AS mark FROM pages
), r AS (
  SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM p
), s AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM r
), t AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM s
), rules(verdict, rh, rp) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), m AS (
  SELECT t.page_id, t.host, t.path, rules.verdict, rh || rp AS rule,
         row_number() OVER (PARTITION BY t.page_id ORDER BY length(rh || rp) DESC, rules.verdict DESC) AS k
  FROM t JOIN rules ON (t.host = rh OR ends_with(t.host, '.' || rh)) AND starts_with(t.path, rp)
)
SELECT t.page_id, t.host, t.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM t LEFT JOIN m ON m.page_id = t.page_id AND m.k = 1
"""
QUERIES = {"op5_url_rules": op5_url_rules}
ORACLE = {"op5_url_rules": SQL}
