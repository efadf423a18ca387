"""Every SQL text of the folder, run by DuckDB beside its query."""

import math

import duckdb
import pytest

from quarry.llm import registry

SF = "/root/testdata/sf0.001"


def rows(names, table):
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted(([clean(r[n]) for n in names] for r in table), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, name):
    found = registry.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    result = con.execute(registry.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(found.columns)
    wanted = [dict(zip(names, r)) for r in result.fetchall()]
    assert rows(names, [r.asDict() for r in found.collect()]) == rows(names, wanted) and wanted
