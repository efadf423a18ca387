"""Query and SQL of operator 13."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import merkle
from quarry.llm.frames import read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf(text: Column) -> Column:
    return merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, _leaf(F.translate(text, UPPER, LOWER)))
    rows = read(spark, sf_dir, "documents").select("doc_id", "lang", _leaf(text).alias("leaf"), tampered.alias("tampered"))
    proven = merkle.manifest(rows, keep=("tampered",))
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("witness"))
    out = proven.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("witness")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}

#: Levels that the SQL writes out for a tree: 8 ** 11 rows.
LEVELS = 11


def _tree(name: str, leaves: str, part: str) -> str:
    """Tables ``<name>0 ..``: the nodes of each level with their runs' text, from ``leaves(part, pos, n, d)``."""
    out = [f"{name}0 as materialized (select {part}, pos, n, d from ({leaves}) t)"]
    for i in range(1, LEVELS + 1):
        below = f"{name}{i - 1}"
        out.append(f"{name}r{i} as materialized (select {part}, pos // 8 as pos, (n + 7) // 8 as n, n = 1 as alone, string_agg(d, '' order by pos) as run from {below} group by 1, 2, 3, 4)")
        out.append(f"{name}{i} as materialized (select {part}, pos, n, case when alone then run else sha256(run) end as d from {name}r{i})")
    return ",\n".join(out)


def _folds(name: str, part: str, source: str, prefix: str) -> str:
    """Tables ``<prefix>0 ..``: every row of ``source`` with ``f``, its node folded up level by level."""
    out = [f"{prefix}0 as materialized (select *, start as f from {source})"]
    for i in range(1, LEVELS + 1):
        at = f"64 * ((x.pos // {8 ** (i - 1)}) % 8)"
        out.append(f"""{prefix}{i} as materialized (select x.* exclude (f, proof), case when r.alone then x.f else sha256(substr(r.run, 1, {at}) || x.f || substr(r.run, {at} + 65)) end as f,
  x.proof || case when r.alone then '' else substr(r.run, 1, {at}) || substr(r.run, {at} + 65) end as proof
  from {prefix}{i - 1} x join {name}r{i} r on r.{part} is not distinct from x.{part} and r.pos = x.pos // {8**i})""")
    return ",\n".join(out)


def _field(c: str) -> str:
    return f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _sql() -> str:
    steps = ", ".join(f"c{i} as (select i, xor(c >> 1, (c & 1) * 3988292384) as c from c{i - 1})" for i in range(1, 9))
    plain = f"translate(text, '{UPPER}', '{LOWER}')"
    return f"""with c0 as (select i, i as c from range(256) t(i)), {steps},
crc as (select list(c order by i) as t from c8),
rows as (select lang, doc_id, {_sql_leaf("text")} as d, {_sql_leaf(plain)} as low,
  xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda ch: ascii(ch)::bigint)),
    lambda a, b: xor(a >> 8, crc.t[1 + (xor(a, b) & 255)])), 4294967295) % 3 = 0 as bad from documents cross join crc),
leaves as materialized (select *, row_number() over (partition by lang order by doc_id nulls first, d) - 1 as pos, count(*) over (partition by lang) as n from rows),
{_tree("t", "select lang, pos, n, d from leaves", "lang")},
subs as materialized (select lang, 0 as one, d, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from t{LEVELS}),
{_tree("s", "select one, pos, n, d from subs", "one")},
b as (select doc_id, lang, pos, d, case when bad then low else d end as start, '' as proof from leaves),
{_folds("t", "lang", "b", "f")},
u as (select f.doc_id, f.d, f.f as start, f.proof, subs.d as subroot, subs.pos, subs.one from f{LEVELS} f join subs on subs.lang is not distinct from f.lang),
{_folds("s", "one", "u", "g")}
select doc_id, g.d as leaf, subroot, top.d as root, sha256(proof) as proof_sha256, g.f as folded_root, g.f = top.d as verified
from g{LEVELS} g cross join s{LEVELS} top"""


ORACLE = {"op13_merkle_manifest": _sql()}
