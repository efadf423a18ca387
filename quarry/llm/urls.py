"""URL filter rules, indexed by their rarest literal token.

A rule is ``host/path-start`` with an action. It fits its host and all
subdomains of it where the URL's path starts with the rule's; ``*`` in the
path stands for any characters. Of a rule's literal tokens that every URL it
fits must hold in full, the one that occurs in the fewest URLs files it; a
URL's tokens fetch the rules filed under them, and only those run their
regular expression.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.frames import col, without
from quarry.operators.util import bounded_broadcast

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules without a token that must occur in full are tried on every URL, under this token.
EVERY = "*"


def host_of(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host, path):
    """Distinct tokens of a URL: labels of its host, letter-and-digit runs of its path."""
    hosts = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    paths = F.transform(F.regexp_extract_all(path, F.lit("[A-Za-z0-9]+"), F.lit(0)), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(hosts, paths, F.array(F.lit(EVERY))))


def literal_tokens(rule: str) -> list[str]:
    """The tokens that every URL the rule fits holds in full: host labels, and path runs that end inside the literal."""
    host, _, path = rule.partition("/")
    inner = re.findall(r"(?<![A-Za-z0-9*])[A-Za-z0-9]+(?![A-Za-z0-9*])(?=.)", "/" + path)
    return [f"h:{x}" for x in host.translate(str.maketrans(UPPER, LOWER)).split(".")] * bool(host) + [f"p:{x}" for x in inner]


def rule_regex(rule: str) -> str:
    """The rule as a regular expression over host and path run together."""
    host, _, path = rule.partition("/")
    quote = lambda s: "".join(c if c.isalnum() else "\\" + c for c in s)
    body = ".*".join(quote(x) for x in ("/" + path).split("*"))
    name = rf"(?:[^/]*\.)?{quote(host.translate(str.maketrans(UPPER, LOWER)))}" if host else "[^/]*"
    return f"(?s)^{name}{body}"


def rule_index(rules: list[tuple[str, str]], urls: DataFrame) -> DataFrame:
    """``(token, rule, verdict, pattern)``: each rule under its rarest token among ``urls`` (host, path)."""
    spark = urls.sparkSession
    rows = [(a, r, rule_regex(r), literal_tokens(r) or [EVERY]) for a, r in sorted(set(rules))]
    table = spark.createDataFrame(rows, "verdict string, rule string, pattern string, tokens array<string>")
    listed = table.select("verdict", "rule", "pattern", F.explode("tokens").alias("token")).distinct()
    wanted = bounded_broadcast(listed.select("token").distinct())
    seen = urls.select(F.explode(url_tokens(F.col("host"), F.col("path"))).alias("token")).join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("verdict", "rule").orderBy(F.coalesce("n", F.lit(0)), "token")
    return (listed.join(seen, "token", "left").withColumn("_r", F.row_number().over(order))
            .where("_r = 1").select("token", "rule", "verdict", "pattern"))


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` are (verdict, ``host/path``) pairs. The longest rule that fits
    decides; of two of equal length the one whose verdict sorts last (block
    over allow). Where none fits ``rule`` is null and the verdict is
    ``default``; so also for null URLs and URLs without ``://``. Every row
    comes back, repeated rows too; input columns named like the output are
    replaced. Each distinct URL is judged once, so a URL repeated on a third
    of all rows costs one judgement; the join back to the rows is by URL and
    can be split by AQE where a URL is hot.
    """
    pages = without(pages, *({"host", "path", "rule", "verdict", "_url"} - {url}))
    urls = pages.select(col(url).alias("_url")).where(F.col("_url").isNotNull()).distinct()
    urls = urls.select("_url", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    index = rule_index(rules, urls)
    fetched = urls.withColumn("token", F.explode(url_tokens(F.col("host"), F.col("path")))).join(bounded_broadcast(index), "token")
    fits = fetched.where(F.expr("rlike(concat(host, path), pattern)"))
    best = fits.groupBy("_url").agg(F.max(F.struct(F.length("rule").alias("n"), "verdict", "rule")).alias("_best"))
    best = best.select(F.col("_url").alias("_key"), "_best.rule", "_best.verdict")
    out = pages.join(best, col(url) == F.col("_key"), "left")
    return (out.withColumn("host", host_of(col(url))).withColumn("path", path_of(col(url)))
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))).drop("_key"))
