"""WARC archives from a deterministic sharded writer, and their reader.

Records are sorted by (key, payload digest, copy) over *shards*, ranges of
that order with about ``SHARD_BYTES`` of payload each. The cuts are whole
steps of the running sum of sizes, so they depend on the records alone, not
on partitions or samples. A task compresses its rows' records first, each a
gzip member of its own with headers and digests made anew, so what is
shuffled is compressed; the shard's task then appends members and starts a
new file when one would pass ``roll`` compressed bytes.

Equal payloads are stored once: the record of the smallest key is the
``response``, the others are ``revisit`` records that refer to it. Who they
refer to is found on digests and keys alone; those rows meet the payloads in
the shard's sort, ahead of the records they speak of.

A file is written under a temporary name of its task attempt and renamed when
it is whole; attempts write the same bytes, so any of them may win. The files
count once the manifest is there, a Parquet table of their names, records,
bytes and sha256 that Spark commits last; a reader takes the manifest's files
and checks them. A write that died is written again to the same place.

Files are opened by ``pyarrow.fs``: a shared folder, hdfs or an object store.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.frames import col
from quarry.operators.util import bounded_broadcast, checkpoint, split_hot_join

SHARD_BYTES = 64 << 20  # of payload, before compression
ROLL = 32 << 20  # of a file, compressed
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-record")
MANIFEST = "manifest"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a qualified path (as Spark's checkpoint folder is) and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


# ---------------------------------------------------------------- records

def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{key}/{digest}/{copy}')}>"


def _uri(url: str) -> str:
    """A URL for a header line: control characters, and blanks at the ends, as percent escapes."""
    inner = url.strip(" ")
    left = len(url) - len(url.lstrip(" "))
    padded = "%20" * left + inner + "%20" * (len(url) - len(inner) - left if inner else 0)
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in padded)


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member whose bytes depend on the record alone."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(f"WARC/1.1\r\n{lines}\r\n".encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _record(kind: str, key: int | None, digest: str, copy: int, url: str | None, size: int, date: str, mime: str, payload: bytes, more: list[tuple[str, str]]) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {mime}\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id(key, digest, copy)), ("WARC-Date", date)]
    headers += [("WARC-Target-URI", _uri(url))] if url is not None else []
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    headers += [("X-Record-Key", str(key))] if key is not None else []
    return member(headers + more, http + payload)


def response(key: int | None, digest: str, copy: int, url: str | None, payload: bytes, date: str, mime: str) -> bytes:
    return _record("response", key, digest, copy, url, len(payload), date, mime, payload, [])


def revisit(key: int | None, digest: str, copy: int, url: str | None, size: int, date: str, mime: str, first: int | None) -> bytes:
    more = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first, digest, 1))]
    more += [("X-Refers-To-Key", str(first))] if first is not None else []
    return _record("revisit", key, digest, copy, url, size, date, mime, b"", more)


def info(name: str, date: str) -> bytes:
    """The record that opens a file."""
    head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(SPACE, name)}>"), ("WARC-Date", date), ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields")]
    return member(head, b"format: WARC File Format 1.1\r\nconformsTo: http://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/\r\n")


# ---------------------------------------------------------------- writing

_MEMBERS = "shard int, key long, digest string, copy long, kind int, url string, size long, first long, member binary"
_FILES = "name string, shard int, file int, records long, bytes long, sha256 string"


def _sort_key(key: int | None, digest: str, copy: int) -> tuple[int, int, str, int]:
    return (0, 0, digest, copy) if key is None else (1, key, digest, copy)


def _compress(cuts: list[tuple], date: str, mime: str):
    """Rows to members with their shard. ``kind`` 0: who a row refers to (no payload), 1: a record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("key", pa.int64()), ("digest", pa.string()), ("copy", pa.int64()), ("kind", pa.int32()),
                            ("url", pa.string()), ("size", pa.int64()), ("first", pa.int64()), ("member", pa.binary())])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for r in batch.slice(at, 256).to_pylist():
                    payload, digest = r.pop("payload"), base64.b32encode(bytes.fromhex(r["digest"])).decode()
                    made = response(r["key"], digest, r["copy"], r["url"], payload, date, mime) if r["kind"] == 1 and payload is not None else None
                    rows.append({**r, "digest": digest, "shard": bisect_right(cuts, _sort_key(r["key"], r["digest"], r["copy"])), "member": made})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


class _Files:
    """The files of one shard, one after the other."""

    def __init__(self, to: str, shard: int, roll: int, date: str):
        self.store, self.folder = filesystem(to)
        self.shard, self.roll, self.date = shard, roll, date
        self.n, self.out, self.done = 0, None, []

    def _open(self) -> None:
        self.name = f"part-{self.shard:06d}-{self.n:05d}.warc.gz"
        self.temporary = f"{self.folder}/_temporary/{self.name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.temporary, compression=None)
        self.sum, self.bytes, self.records = hashlib.sha256(), 0, 0
        self._put(info(self.name, self.date))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sum.update(data)
        self.bytes += len(data)

    def append(self, data: bytes) -> None:
        if self.out is not None and self.records and self.bytes + len(data) > self.roll:
            self.close()
        if self.out is None:
            self._open()
        self._put(data)
        self.records += 1

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.store.move(self.temporary, f"{self.folder}/{self.name}")
        self.done.append({"name": self.name, "shard": self.shard, "file": self.n, "records": self.records, "bytes": self.bytes, "sha256": self.sum.hexdigest()})
        self.n, self.out = self.n + 1, None


def _write(to: str, roll: int, date: str, mime: str):
    """Sorted members to files; yields the files' rows of the manifest."""
    schema = pa.schema([("name", pa.string()), ("shard", pa.int32()), ("file", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, told = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if files is None or files.shard != r["shard"]:
                    if files is not None:
                        files.close()
                        yield pa.RecordBatch.from_pylist(files.done, schema=schema)
                    files = _Files(to, r["shard"], roll, date)
                if r["kind"] == 0:  # the record of this key, digest and copy comes next
                    told = r
                elif told is not None and (told["key"], told["digest"], told["copy"]) == (r["key"], r["digest"], r["copy"]):
                    files.append(revisit(r["key"], r["digest"], r["copy"], r["url"], r["size"], date, mime, told["first"]))
                else:
                    files.append(r["member"])
        if files is not None:
            files.close()
            yield pa.RecordBatch.from_pylist(files.done, schema=schema)

    return run


def _copies(rows: DataFrame, revisit_bytes: int) -> DataFrame:
    """``rows`` with ``copy``: 1, or 1, 2, .. for rows of equal key and payload, by url; later copies that will be revisits carry no payload.

    Only rows whose key and digest repeat are grouped. A group is first
    counted (equal rows fold in the map tasks) and then dealt out again, so
    no task holds a group.
    """
    light = rows.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("_k"), F.col("digest").alias("_d"))
    light = checkpoint(light)
    if not light.limit(1).count():
        return rows.withColumn("copy", F.lit(1).cast("long"))
    twice = bounded_broadcast(light)
    same = F.col("key").eqNullSafe(F.col("_k")) & (F.col("digest") == F.col("_d"))
    single = rows.join(twice, same, "left_anti").withColumn("copy", F.lit(1).cast("long"))
    # the payload is the digest's: one stands for all
    counted = checkpoint(rows.join(twice, same, "left_semi").groupBy("key", "digest", "size", "url").agg(F.count(F.lit(1)).alias("n"), F.max("payload").alias("payload")))
    before = Window.partitionBy("key", "digest").orderBy("url").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    dealt = starts.select("key", "digest", "size", "url", "payload", "_before", F.explode(F.sequence(F.lit(1), "n")).alias("_i"))
    dealt = dealt.withColumn("copy", (F.col("_before") + F.col("_i")).cast("long"))
    dealt = dealt.withColumn("payload", F.when((F.col("copy") == 1) | (F.col("size") < revisit_bytes), F.col("payload")))
    return single.unionByName(dealt.select(*single.columns))


def _cuts(light: DataFrame, shard_bytes: int) -> list[tuple]:
    """First sort keys of all shards but the first: where the running sum of sizes enters a new multiple of ``shard_bytes``.

    A row a shard comes to the driver: 100 TB of payload make 1.6 million
    at 64 MB each; take larger shards there.
    """
    rows = light.select(F.col("key").isNotNull().cast("int").alias("_has"), F.coalesce("key", F.lit(0)).alias("_key"), "digest", "copy", (F.col("size") + 512).alias("_w"))
    order = ["_has", "_key", "digest", "copy"]
    ranged = checkpoint(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()))
    sums = ranged.groupBy("_pid").agg(F.sum("_w").alias("_sum"))
    # a row a partition
    before = sums.select("_pid", F.coalesce(F.sum("_sum").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    running = F.sum("_w").over(Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = ranged.withColumn("_run", running).join(F.broadcast(before), "_pid")
    placed = placed.withColumn("_shard", ((F.col("_off") + F.col("_run") - F.col("_w")) / shard_bytes).cast("long"))
    firsts = placed.groupBy("_shard").agg(F.min(F.struct(*order)).alias("first")).orderBy("_shard")
    return [tuple(r["first"]) for r in firsts.collect()][1:]


def write_warc(records: DataFrame, to: str, key: str = "page_id", url: str = "url", payload: str = "html", revisit_bytes: int = 0,
               shard_bytes: int = SHARD_BYTES, roll: int = ROLL, date: str = "1970-01-01T00:00:00Z", mime: str = "text/html; charset=utf-8") -> None:
    """Every row of ``records`` as a WARC record in files under ``to``, ended by a manifest.

    A null payload is empty, text is UTF-8; a null key sorts first and stands
    in no header; a null url leaves out its header. Of equal payloads of at
    least ``revisit_bytes`` the one of the smallest key (null before all; of
    equal keys, the first by url) is the response. Repeated rows stay, as
    records of their own. ``date`` stands in every record, so that the same
    records make the same files. An empty table makes a manifest without
    files. The folder ``to`` may hold what a write that died has left.
    """
    spark = records.sparkSession
    body = F.coalesce(col(payload).cast("binary"), F.lit(b""))
    rows = records.select(col(key).cast("long").alias("key"), col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    rows = _copies(rows, revisit_bytes)
    light = checkpoint(rows.select("key", "digest", "copy", "size"))
    ranked = F.struct(F.col("key").isNotNull().alias("has"), F.col("key").alias("key"), F.col("copy").alias("copy"))
    firsts = light.where(F.col("size") >= revisit_bytes).groupBy("digest").agg(F.min(ranked).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = checkpoint(firsts)
    counts, many = firsts.select("digest", "n"), light.count()
    told = split_hot_join(light, firsts.select("digest", "first"), "digest", counts, many)
    told = told.where(~(F.col("key").eqNullSafe(F.col("first.key")) & (F.col("copy") == F.col("first.copy"))))
    nothing = F.lit(None)
    told = told.select("key", nothing.cast("string").alias("url"), nothing.cast("binary").alias("payload"), "digest", "size", "copy",
                       F.lit(0).alias("kind"), F.col("first.key").alias("first"))
    both = rows.select("key", "url", "payload", "digest", "size", "copy", F.lit(1).alias("kind"), nothing.cast("long").alias("first")).unionByName(told)
    cuts = _cuts(light, shard_bytes)
    members = both.select("key", "url", "payload", "digest", "size", "copy", "kind", "first").mapInArrow(_compress(cuts, date, mime), _MEMBERS)
    store, folder = filesystem(to)
    store.create_dir(f"{folder}/_temporary", recursive=True)
    dealt = members.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", "key", "digest", "copy", "kind")
    dealt.mapInArrow(_write(to, roll, date, mime), _FILES).write.mode("overwrite").parquet(f"{to}/{MANIFEST}")
    store.delete_dir(f"{folder}/_temporary")


# ---------------------------------------------------------------- reading

def _members(stream, size: int, checked: hashlib._hashlib.HASH, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file, one gzip member each, in pieces of ``chunk`` bytes."""
    rest, unpack, out, left = b"", None, [], size
    while True:
        if not rest:
            rest = stream.read(chunk)
            if not rest:
                break
            checked.update(rest)
            left -= len(rest)
        if unpack is None:
            unpack, out = zlib.decompressobj(31), []
        out.append(unpack.decompress(rest))
        rest = unpack.unused_data if unpack.eof else b""
        if unpack.eof:
            yield b"".join(out)
            unpack = None
    if unpack is not None or left:
        raise ValueError("a file of the archive ends early")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record, checked against its length and digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if rest[len(block):] != b"\r\n\r\n" or headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("a record does not match its headers")
    return headers, block


_READ = pa.schema([("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("file", pa.string())])


def _row(headers: dict[str, str], block: bytes, file: str) -> dict | None:
    kind = headers["warc-type"]
    if kind == "warcinfo":
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(line for line in http.decode().split("\r\n") if line.lower().startswith("content-length:")).split(":")[1])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("a payload does not match its headers")
    number = lambda name: int(headers[name]) if name in headers else None
    return {"key": number("x-record-key"), "url": headers.get("warc-target-uri"), "record_type": kind, "payload": payload if kind == "response" else None,
            "payload_bytes": size, "payload_digest": digest, "refers_to": number("x-refers-to-key"), "file": file}


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of a written archive: ``key, url, record_type, payload, payload_bytes, payload_digest, refers_to, file``.

    A task reads whole files, record by record, and checks lengths, digests
    and the manifest's sum. A revisit's payload is null (its size and digest
    are the full payload's). Without ``payloads`` the column is null and
    payloads stay in the task. No manifest is an error: the write did not end.
    """
    files = spark.read.schema(_FILES).parquet(f"{path}/{MANIFEST}")
    n = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem(path)
        for batch in batches:
            for f in batch.to_pylist():
                rows, held, seen, sum_ = [], 0, 0, hashlib.sha256()
                with store.open_input_stream(f"{folder}/{f['name']}", compression=None) as stream:
                    for record in _members(stream, f["bytes"], sum_):
                        row = _row(*parse(record), f["name"])
                        if row is None:
                            continue
                        seen += 1
                        held += len(record) if payloads else 0
                        rows.append(row if payloads else {**row, "payload": None})
                        if held > 8 << 20 or len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                            rows, held = [], 0
                if seen != f["records"] or sum_.hexdigest() != f["sha256"]:
                    raise ValueError(f"{f['name']} does not match the manifest")
                yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    schema = "key long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long, file string"
    return files.repartition(n, "name").mapInArrow(run, schema)
