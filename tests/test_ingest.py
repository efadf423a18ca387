import datetime

from pyspark.sql import functions as F

from quarry.operators import ingest as I
from quarry.operators.features import balance_classes


def ts(h):
    return datetime.datetime(2024, 1, 1, h)


def test_status_refresh_polls(spark):
    polls = [(1, ts(1), "view"), (1, ts(2), "view"),
             (2, ts(1), "view"), (2, ts(2), "let"), (2, ts(3), "removed"),
             (3, ts(5), "removed")]
    df = spark.createDataFrame(polls, "id long, ts timestamp, kind string")
    out = {r.id: r for r in I.status_refresh(df, "id", "ts", F.col("kind") == "removed", F.col("kind") == "let").collect()}
    assert 1 not in out
    assert (out[2].removed, out[2].let_agreed, out[2].flagged_ts) == (False, True, ts(2))  # sticky first flag
    assert (out[3].removed, out[3].let_agreed) == (True, False)


def test_upsert_insert_quarantine(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k long, s string, v double")
    upd = spark.createDataFrame([(2, None, 5.0), (3, "c", 3.0)], "k long, s string, v double")
    got = sorted(tuple(r) for r in I.upsert_by_key(base, upd, "k", ["s", "v"]).collect())
    assert got == [(1, "a", 1.0), (2, "b", 5.0)]
    ins = sorted(tuple(r) for r in I.insert_if_absent(base, upd, "k").collect())
    assert [r[0] for r in ins] == [1, 2, 3] and ins[1] == (2, "b", 2.0)
    good, bad = I.quarantine(upd, {"no_s": F.col("s").isNull()}, as_of_ts="2024-01-01 00:00:00")
    assert [r.k for r in good.collect()] == [3]
    assert [(r.k, r.reason) for r in bad.collect()] == [(2, "no_s")]


def test_ingest_batch_dedupes_and_skips_known(spark):
    batch = spark.createDataFrame([(1, ts(2), "x"), (1, ts(1), "y"), (2, ts(1), "z"), (3, ts(1), "w")],
                                  "k long, ts timestamp, v string")
    known = spark.createDataFrame([(2,)], "k long")
    good, _ = I.ingest_batch(batch, known, "k", "ts")
    assert sorted((r.k, r.v) for r in good.collect()) == [(1, "y"), (3, "w")]


def test_stream_ingest_is_incremental(spark, tmpdir_path):
    from quarry.streaming.ingest import ingest_stream

    schema = "k long, ts timestamp, v string"
    src, sink, ck = f"{tmpdir_path}/src", f"{tmpdir_path}/sink", f"{tmpdir_path}/ck"
    spark.createDataFrame([(1, ts(1), "a"), (2, ts(1), "b")], schema).write.parquet(f"{src}/d=1")
    first, _ = ingest_stream(spark, f"{src}/d=*", schema, sink, ck, "k", "ts")
    assert first.count() == 2
    spark.createDataFrame([(2, ts(2), "b2"), (3, ts(2), "c")], schema).write.parquet(f"{src}/d=2")
    second, _ = ingest_stream(spark, f"{src}/d=*", schema, sink, ck, "k", "ts")
    assert sorted((r.k, r.v) for r in second.collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_select_keys_and_first_seen(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k long, v long")
    assert sorted(r.k for r in I.select_keys(df, "k", " 1  3 x ").collect()) == [1, 3]
    seen = spark.createDataFrame([("a", 2, 5), ("a", 1, 9), ("b", 1, 1)], "link string, page long, pos long")
    got = {r.link: (r.page, r.pos) for r in I.first_seen(seen, "link", ["page", "pos"]).collect()}
    assert got == {"a": (1, 9), "b": (1, 1)}


def test_balance_classes(spark):
    df = spark.createDataFrame([(i, 0 if i < 7 else 1) for i in range(10)], "id long, c int")
    got = sorted((r.c, r.id) for r in balance_classes(df, "c", "id").collect())
    assert got == [(0, 0), (0, 1), (0, 2), (1, 7), (1, 8), (1, 9)]


def test_status_refresh_stream_matches_batch(spark, tmpdir_path):
    from quarry.streaming.ingest import status_refresh_stream

    schema = "id long, ts timestamp, kind string"
    src, sink, ck = f"{tmpdir_path}/src", f"{tmpdir_path}/sink", f"{tmpdir_path}/ck"
    spark.createDataFrame([(1, ts(1), "view"), (2, ts(1), "view"), (2, ts(2), "let")], schema).write.parquet(f"{src}/d=1")
    args = ("id", "ts", "kind = 'removed'", "kind = 'let'")
    status_refresh_stream(spark, f"{src}/d=*", schema, sink, ck, *args)
    spark.createDataFrame([(2, ts(3), "removed"), (3, ts(5), "removed")], schema).write.parquet(f"{src}/d=2")
    out = {r.id: r for r in status_refresh_stream(spark, f"{src}/d=*", schema, sink, ck, *args).collect()}
    assert set(out) == {2, 3}
    assert (out[2].removed, out[2].let_agreed, out[2].flagged_ts) == (False, True, ts(2))  # sticky across batches
    assert (out[3].removed, out[3].let_agreed) == (True, False)
