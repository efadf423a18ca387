"""Tables that change by commits: an ingestion ledger, an updatable table, a set of seen keys (ING1, ING3, SNK8, JON11).

Rows are plain Parquet folders that Spark writes; a folder counts once an
entry of the commit log names it. Entries are small numbered files, created
so that of two writers one gets the number and the other takes the next, so a
reader sees a write whole or not at all and nothing stored is overwritten.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators.ingest import completed_partitions
from quarry.operators.util import checkpoint


class CommitLog:
    """Numbered entries under ``path``: JSON objects in the order of their commits."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(self._conf)
        self._local = self._fs.getUri().getScheme() == "file"

    def _plain(self, path: str) -> str:
        return self._path(path).toUri().getPath()

    def entries(self) -> list[tuple[int, dict]]:
        """``(number, entry)`` of every commit, in order: one small file each."""
        folder = self._path(f"{self.path}/_log")
        if not self._fs.exists(folder):
            return []
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(folder))
        out = []
        for name in names:
            if name.endswith(".json"):
                out.append((int(name[:-5]), json.loads(self._read(f"{self.path}/_log/{name}"))))
        return out

    def _read(self, path: str) -> str:
        if self._local:
            with open(self._plain(path), encoding="utf-8") as f:
                return f.read()
        stream = self._fs.open(self._path(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def commit(self, entry: dict) -> int:
        """Adds an entry under the next free number and returns the number."""
        self._fs.mkdirs(self._path(f"{self.path}/_log"))
        text = json.dumps(entry)
        number = max((n for n, _ in self.entries()), default=0) + 1
        while not self._create(f"{self.path}/_log/{number:020d}.json", text):
            number += 1
        return number

    def _create(self, path: str, text: str) -> bool:
        """Creates the file whole, unless there is one."""
        temporary = f"{self.path}/_log/.{uuid.uuid4().hex}"
        if self._local:
            with open(self._plain(temporary), "w", encoding="utf-8") as f:
                f.write(text)
            try:
                os.link(self._plain(temporary), self._plain(path))
                return True
            except FileExistsError:
                return False
            finally:
                os.remove(self._plain(temporary))
        out = self._fs.create(self._path(temporary), False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        # elsewhere a rename does not replace a file
        if self._fs.exists(self._path(path)) or not self._fs.rename(self._path(temporary), self._path(path)):
            self._fs.delete(self._path(temporary), False)
            return False
        return True

    def folder(self) -> str:
        """A fresh folder for rows to be committed."""
        return f"{self.path}/rows-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- ING1

class Ledger:
    """ING1: which keys were started, finished or failed, as events that are only ever added.

    A finish stands for good. A key that was started and never finished is
    taken up again by the next run, whether its work failed or its driver was
    lost.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str = "bigint"):
        self.spark, self.key, self.log = spark, key, CommitLog(spark, path)
        self.schema = StructType.fromDDL(f"{key} {key_type}, event string, run string, at timestamp, entry string")

    def record(self, keys: DataFrame, event: str, run: str) -> int:
        """Adds ``event`` (start, finish or failed) for distinct ``keys``; one commit."""
        folder = self.log.folder()
        rows = keys.select(F.col(self.key).cast(self.schema[0].dataType).alias(self.key)).distinct()
        rows.select(self.key, F.lit(event).alias("event"), F.lit(run).alias("run"), F.current_timestamp().alias("at"), F.lit(folder).alias("entry")).write.parquet(folder)
        return self.log.commit({"folder": folder})

    def events(self) -> DataFrame:
        """Every event since the last compaction with its commit's number ``seq`` (a compaction's own rows first)."""
        entries = self.log.entries()
        first = max((i for i, (_, e) in enumerate(entries) if e.get("state")), default=0)
        kept = [(e["folder"], n) for n, e in entries[first:]]
        if not kept:
            return self.spark.createDataFrame([], self.schema).withColumn("seq", F.lit(0).cast("long"))
        numbers = self.spark.createDataFrame(kept, "entry string, seq long")  # a row a commit
        return self.spark.read.schema(self.schema).parquet(*[f for f, _ in kept]).join(F.broadcast(numbers), "entry")

    def state(self) -> DataFrame:
        """``(<key>, completed, last_event, last_run, last_at)``: of each key ever started."""
        last = F.max(F.struct("seq", "at", "event", "run")).alias("_l")
        got = self.events().groupBy(self.key).agg(F.bool_or(F.col("event") == "finish").alias("completed"), last)
        return got.select(self.key, "completed", F.col("_l.event").alias("last_event"), F.col("_l.run").alias("last_run"), F.col("_l.at").alias("last_at"))

    def pending(self, keys: DataFrame) -> DataFrame:
        """The work list: distinct ``keys`` that are not finished."""
        return keys.select(self.key).distinct().join(self.state().where("completed").select(self.key), self.key, "left_anti")

    def half_done(self) -> DataFrame:
        """Keys started and never finished."""
        return self.state().where(~F.col("completed")).select(self.key, "last_event", "last_run")

    def process(self, keys: DataFrame, work: Callable[[DataFrame], DataFrame], run: str) -> DataFrame:
        """ING1 + ING2: starts the pending keys, works on them, finishes those none of whose records failed.

        ``work`` gets the keys and returns records ``(<key>, ok, ..)``; a key
        without records has none that failed. Returns the records.
        """
        todo = checkpoint(self.pending(keys))
        self.record(todo, "start", run)
        records = checkpoint(work(todo))
        bad = records.select(self.key).join(completed_partitions(records, self.key, F.coalesce("ok", F.lit(False))), self.key, "left_anti").distinct()
        bad = checkpoint(bad)
        self.record(todo.join(bad, self.key, "left_anti"), "finish", run)
        self.record(bad, "failed", run)
        return records

    def compact(self) -> int:
        """Writes the state as one entry that later reads begin with."""
        folder = self.log.folder()
        state = self.state().select(self.key, F.when(F.col("completed"), "finish").otherwise(F.col("last_event")).alias("event"),
                                    F.col("last_run").alias("run"), F.col("last_at").alias("at"), F.lit(folder).alias("entry"))
        state.write.parquet(folder)
        return self.log.commit({"folder": folder, "state": True})


# ---------------------------------------------------------------- SNK8, JON11

class KeyedTable:
    """SNK8 / JON11 on storage: rows by key in ``buckets``, updates beside them, merged where they are read.

    An update writes its own rows alone, into the buckets of its keys;
    ``compact`` rewrites only buckets that have updates. A NULL in an update
    keeps the value; of several updates of a key the last commit's counts, in
    one commit the greatest row. Keys that are not in the table are not
    inserted by ``update``; ``insert`` adds rows of keys that are not there.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, buckets: int = 64):
        self.spark, self.key, self.buckets, self.log = spark, key, buckets, CommitLog(spark, path)
        self.schema = StructType.fromDDL(schema)
        self.columns = [f.name for f in self.schema.fields if f.name != key]
        self._full = StructType.fromDDL(f"{schema}, bucket int")

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def _write(self, kind: str, rows: DataFrame) -> list[int]:
        """Rows to a folder by bucket, one file a bucket, and the commit; the buckets that were written."""
        folder = self.log.folder()
        dealt = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields], self._bucket())
        dealt.repartition("bucket").write.partitionBy("bucket").parquet(folder)
        touched = sorted(r[0] for r in self.spark.read.schema(self._full).parquet(folder).select("bucket").distinct().collect())
        self.log.commit({"kind": kind, "folder": folder, "buckets": touched})
        return touched

    def _layers(self) -> tuple[dict[int, list[str]], dict[int, list[tuple[int, str]]]]:
        """Of each bucket: folders of its rows, and of its updates with their commits' numbers."""
        rows: dict[int, list[str]] = {}
        updates: dict[int, list[tuple[int, str]]] = {}
        for n, e in self.log.entries():
            for b in e["buckets"]:
                if e["kind"] == "base":
                    rows[b], updates[b] = [e["folder"]], []
                elif e["kind"] == "insert":
                    rows.setdefault(b, []).append(e["folder"])
                else:
                    updates.setdefault(b, []).append((n, e["folder"]))
        return rows, {b: u for b, u in updates.items() if u}

    def _scan(self, layers: dict[int, list], only: list[int] | None) -> DataFrame:
        """Rows of those folders and buckets with their commit's number; a folder is read once, its other buckets are pruned."""
        by: dict[tuple[int, str], list[int]] = {}
        for b, folders in layers.items():
            if only is None or b in only:
                for f in folders:
                    by.setdefault(f if isinstance(f, tuple) else (0, f), []).append(b)
        out = self.spark.createDataFrame([], self._full).withColumn("_seq", F.lit(0).cast("long"))
        for (n, folder), wanted in sorted(by.items()):
            out = out.unionByName(self.spark.read.schema(self._full).parquet(folder).where(F.col("bucket").isin(wanted)).withColumn("_seq", F.lit(n).cast("long")))
        return out

    def create(self, rows: DataFrame) -> list[int]:
        return self._write("base", rows)

    def insert(self, rows: DataFrame) -> list[int]:
        """SNK7 / JON5: adds rows whose key is not in the table; reads keys of their buckets alone."""
        fresh = rows.groupBy(self.key).agg(F.max(F.struct(*self.columns)).alias("_r")).select(self.key, *[F.col(f"_r.{c}").alias(c) for c in self.columns])
        fresh = checkpoint(fresh.withColumn("bucket", self._bucket()))
        own = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
        known = self._scan(self._layers()[0], own).select(self.key)
        return self._write("insert", fresh.drop("bucket").join(known, self.key, "left_anti"))

    def update(self, updates: DataFrame) -> list[int]:
        """Adds an update; columns that ``updates`` lacks are kept."""
        full = [F.col(c) if c in updates.columns else F.lit(None).alias(c) for c in self.columns]
        last = updates.select(self.key, *full).groupBy(self.key).agg(F.max(F.struct(*self.columns)).alias("_r"))
        return self._write("update", last.select(self.key, *[F.col(f"_r.{c}").alias(c) for c in self.columns]))

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The table as it is: buckets without updates straight, the others merged by key."""
        rows, updates = self._layers()
        base = self._scan(rows, buckets).drop("_seq")
        if not updates:
            return base.drop("bucket")
        changed = sorted(updates)
        news = self._scan(updates, buckets)
        latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_seq"))).alias(f"_{c}") for c in self.columns]
        merged = base.where(F.col("bucket").isin(changed)).join(news.groupBy(self.key).agg(*latest), self.key, "left")
        merged = merged.select(self.key, *[F.coalesce(f"_{c}", c).alias(c) for c in self.columns])
        order = [f.name for f in self.schema.fields]
        return base.where(~F.col("bucket").isin(changed)).select(*order).unionByName(merged.select(*order))

    def compact(self) -> list[int]:
        """Rewrites the buckets that have updates, each into one file."""
        changed = sorted(self._layers()[1])
        return self._write("base", self.read(changed)) if changed else []


# ---------------------------------------------------------------- ING3

class SeenKeys:
    """ING3: keys that a stream has stored, in files by bucket: a batch looks only into the buckets of its own keys.

    ``batch=N`` holds what batch N added; a replayed batch overwrites its own
    folder and does not see it. Every ``FOLD`` batches that can no longer be
    replayed become one folder, a file a bucket.
    """

    FOLD = 32

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str, buckets: int = 256):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = StructType.fromDDL(f"{key} {key_type}, bucket int")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key).cast(self.schema[0].dataType)), F.lit(self.buckets)).cast("int")

    def _folders(self) -> dict[str, int]:
        """Complete folders by name, with the last batch in each."""
        if not self._fs.exists(self._path(self.path)):
            return {}
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        names = [n for n in names if self._fs.exists(self._path(f"{self.path}/{n}/_SUCCESS"))]
        folds = {n: int(n.split("=")[1]) for n in names if n.startswith("fold=")}
        upto = max(folds.values(), default=-1)
        return folds | {n: int(n.split("=")[1]) for n in names if n.startswith("batch=") and int(n.split("=")[1]) > upto}

    def among(self, batch: DataFrame, number: int) -> DataFrame:
        """Keys seen before batch ``number`` in the buckets of ``batch``'s keys."""
        wanted = [r[0] for r in batch.select(self._bucket().alias("b")).distinct().collect()]  # at most ``buckets``
        out = self.spark.createDataFrame([], self.schema)
        for name, last in self._folders().items():
            if last != number:
                out = out.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.path}/{name}").where(F.col("bucket").isin(wanted)))
        return out.select(self.key)

    def _write(self, keys: DataFrame, name: str) -> None:
        keyed = keys.select(F.col(self.key).cast(self.schema[0].dataType).alias(self.key), self._bucket().alias("bucket"))
        keyed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}")

    def add(self, keys: DataFrame, number: int) -> None:
        """Stores batch ``number``'s keys, and folds older batches when there are enough of them."""
        self._write(keys, f"batch={number}")
        old = sorted(n for name, n in self._folders().items() if name.startswith("batch=") and n < number)
        if len(old) >= self.FOLD:
            parts = [self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={n}") for n in old]
            whole = parts[0]
            for p in parts[1:]:
                whole = whole.unionByName(p)
            self._write(whole, f"fold={old[-1]}")
            for n in old:
                self._fs.delete(self._path(f"{self.path}/batch={n}"), True)
