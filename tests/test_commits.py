import threading

import pytest
from pyspark.sql import functions as F

from quarry.operators.commits import CommitLog, KeyedTable, Ledger, SeenKeys


def ids(df, c="k"):
    return sorted(r[c] for r in df.collect())


def test_log_gives_each_writer_a_number_of_its_own(spark, tmpdir_path):
    logs = [CommitLog(spark, f"{tmpdir_path}/t") for _ in range(4)]
    threads = [threading.Thread(target=lambda log=log, i=i: [log.commit({"w": i}) for _ in range(5)]) for i, log in enumerate(logs)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    entries = logs[0].entries()
    assert [n for n, _ in entries] == list(range(1, 21)) and sorted(e["w"] for _, e in entries) == sorted([0, 1, 2, 3] * 5)


def test_ledger_takes_up_keys_that_were_started_and_lost(spark, tmpdir_path):
    keys = spark.range(6).withColumnRenamed("id", "k")
    led = lambda: Ledger(spark, f"{tmpdir_path}/ledger", "k")
    records = lambda todo: todo.select("k", (F.col("k") != 2).alias("ok")).where("k <> 5")

    def killed(todo):
        raise KeyboardInterrupt

    assert ids(led().pending(keys)) == [0, 1, 2, 3, 4, 5]
    with pytest.raises(KeyboardInterrupt):  # the driver dies between start and finish
        led().process(keys.where("k < 3"), killed, "run1")
    assert ids(led().half_done()) == [0, 1, 2] and ids(led().pending(keys)) == [0, 1, 2, 3, 4, 5]
    done = led().process(keys, records, "run2")
    assert ids(done) == [0, 1, 2, 3, 4]
    state = {r["k"]: (r["completed"], r["last_event"], r["last_run"]) for r in led().state().collect()}
    assert state[0] == (True, "finish", "run2") and state[2] == (False, "failed", "run2")
    assert state[5] == (True, "finish", "run2")  # no record of it failed
    assert ids(led().pending(keys)) == [2]
    led().compact()
    seen = []
    led().process(keys, lambda todo: seen.extend(ids(todo)) or todo.select("k", F.lit(True).alias("ok")), "run3")
    assert seen == [2] and led().pending(keys).count() == 0 and led().events().where("event = 'start'").count() == 1


def test_rows_without_a_commit_do_not_count(spark, tmpdir_path):
    led = Ledger(spark, f"{tmpdir_path}/ledger", "k")
    led.record(spark.range(3).withColumnRenamed("id", "k"), "start", "a")
    spark.range(9).withColumnRenamed("id", "k").write.parquet(led.log.folder())  # a writer that died before its commit
    assert ids(led.state()) == [0, 1, 2]


def test_updates_rewrite_only_their_buckets(spark, tmpdir_path):
    import os

    t = KeyedTable(spark, f"{tmpdir_path}/t", "k", "k long, s string, v double", buckets=32)
    rows = spark.range(500).select(F.col("id").alias("k"), F.concat(F.lit("s"), "id").alias("s"), F.col("id").cast("double").alias("v"))
    assert len(t.create(rows)) == 32
    ten = spark.createDataFrame([(i * 37, None, -1.0) for i in range(10)] + [(900, "new", 0.0)], "k long, s string, v double")
    touched = t.update(ten)
    assert len(touched) <= 11
    t.update(spark.createDataFrame([(37, "late"), (37, "early")], "k long, s string"))
    want = {i: (f"s{i}", -1.0 if i % 37 == 0 and i < 370 else float(i)) for i in range(500)}
    want[37] = ("late", -1.0)
    get = lambda: {r["k"]: (r["s"], r["v"]) for r in t.read().collect()}
    assert get() == want
    assert len(t.compact()) <= 11 and get() == want and t.compact() == []
    folder = t.log.entries()[-1][1]["folder"].removeprefix("file:")
    assert sum(n.startswith("bucket=") for n in os.listdir(folder)) <= 11
    assert len(t.insert(spark.createDataFrame([(5, "no", 1.0), (900, "yes", 2.0), (900, "a", 1.0)], "k long, s string, v double"))) == 1
    want[900] = ("yes", 2.0)
    assert get() == want


def test_a_batch_reads_only_its_own_buckets(spark, tmpdir_path):
    seen = SeenKeys(spark, f"{tmpdir_path}/seen", "k", "bigint", buckets=16)
    keyed = spark.range(4000).select(F.col("id").alias("k"), F.pmod(F.xxhash64("id"), F.lit(16)).alias("b"))
    few, others = keyed.where("b = 3").select("k"), keyed.where("b <> 3").select("k")
    seen.add(few.where("k < 1000"), 0)
    files = lambda n: len(seen.among(few, n).inputFiles())
    read = lambda n: seen.among(few, n)._jdf.queryExecution().executedPlan().toString().count("PartitionFilters")
    before = ids(seen.among(few, 1))
    for n in range(1, 6):
        seen.add(others.where(F.col("k") % 5 == n - 1), n)
    assert ids(seen.among(few, 6)) == before == ids(few.where("k < 1000"))
    scans = [s for s in seen.among(few, 6)._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in s]
    assert scans and all("bucket" in s.split("PartitionFilters")[1] for s in scans) and files(6) >= 1 and read(6) >= 1
    assert ids(seen.among(few, 0)) == []  # a replayed batch does not see itself


def test_seen_batches_fold(spark, tmpdir_path):
    seen = SeenKeys(spark, f"{tmpdir_path}/seen", "k", "bigint", buckets=4)
    seen.FOLD = 3
    for n in range(8):
        seen.add(spark.createDataFrame([(10 * n,), (10 * n + 1,)], "k long"), n)
    assert len(seen._folders()) < 6 and any(f.startswith("fold=") for f in seen._folders())
    every = spark.createDataFrame([(i,) for i in range(100)], "k long")
    assert ids(seen.among(every, 99)) == sorted(10 * n + i for n in range(8) for i in (0, 1))
