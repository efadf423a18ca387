import duckdb

import __spark_entry__ as E
from quarry.plans.registry import INVENTORY
from quarry.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["source", "avg_score", "n_docs"]


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(INVENTORY) <= set(q)
    assert len(q) >= 100


def test_some_oracles_match_at_smallest_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    q, o = E.queries(), E.oracle_sql()
    for name in ["lexicon_sentiment", "tf_idf", "group_cosine", "segment_by_header", "page_blocks", "status_refresh"]:
        df = q[name](spark, SF)
        a = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect())
        res = con.execute(o[name])
        cols = [d[0] for d in res.description]
        b = sorted(tuple(round(r[cols.index(c)], 6) if isinstance(r[cols.index(c)], float) else r[cols.index(c)]
                         for c in sorted(cols)) for r in res.fetchall())
        assert a == b, name
