"""Operator 12: round trips, equal files from equal records, and writes that died."""

import gzip
import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import q_warc, warc

SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(table):
    rows = [(i, f"https://example.org/{i}", f"<p>page {i % 70}</p>" * (1 + i % 7)) for i in range(400)]
    rows += [(1000 + i, "https://example.org/same", "<p>copy</p>") for i in range(300)]
    rows += [(5000, "u", "x" * 300_000), (5001, None, None), (5002, "a\r\nb: c ", ""), (5003, " ", "é日本\r\n\r\nWARC/1.1\r\n"), (None, "n", "<p>copy</p>"),
             (7, "z", "<p>copy</p>"), (7, "a", "<p>copy</p>"), (7, "a", "<p>copy</p>"), (7, "a", "<p>other</p>"), (None, None, None)]
    return rows, table(rows, SCHEMA)


def expected(rows, least=0):
    """(key, bytes, digest, type, refers_to) of every row, by plain grouping."""
    groups = {}
    for key, url, html in rows:
        data = (html or "").encode()
        groups.setdefault(data, []).append((key is not None, key or 0, url or "", key))
    out = []
    for data, members in groups.items():
        for n, m in enumerate(sorted(members)):
            first = n == 0 or len(data) < least
            out.append((m[3], len(data), warc.base32_sha1(data), "response" if first else "revisit", None if first else min(members)[3]))
    return sorted(out, key=repr)


def found(df):
    return sorted([(r["key"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()], key=repr)


def folder(path):
    return {n: hashlib.sha256(open(f"{path}/{n}", "rb").read()).hexdigest() for n in sorted(os.listdir(path)) if n.endswith(".gz")}


def test_round_trip(spark, pages, tmp_path):
    rows, df = pages
    to = f"{tmp_path}/w"
    warc.write_warc(df, to, shard_bytes=20_000, roll=4_000)
    back = warc.read_warc(spark, to)
    assert found(back) == expected(rows)
    payload = {(r["key"], r["payload_digest"]): r["payload"] for r in back.where("record_type = 'response'").collect()}
    for (_, digest), data in payload.items():
        assert warc.base32_sha1(bytes(data)) == digest
    assert {bytes(p) for p in payload.values()} == {(h or "").encode() for _, _, h in rows}
    assert found(warc.read_warc(spark, to, payloads=False)) == expected(rows)
    files = spark.read.parquet(f"{to}/manifest").collect()
    assert len(files) > 5 and {f["name"] for f in files} == set(folder(to)) and not os.path.exists(f"{to}/_temporary")
    # files roll by compressed size: only a file of one record is larger
    assert all(f["bytes"] <= 4_000 or f["records"] == 1 for f in files)
    # in order of shard and file, keys ascend
    by_file = {}
    for r in back.select("file", "key").collect():
        by_file.setdefault(r["file"], []).append(r["key"])
    keys = [k for f in sorted(files, key=lambda f: (f["shard"], f["file"])) for k in by_file[f["name"]]]
    assert [k for k in keys if k is not None] == sorted(k for k in keys if k is not None) and keys[0] is None


def test_same_records_same_files(pages, tmp_path):
    _, df = pages
    for name, parts in (("a", 1), ("b", 7)):
        warc.write_warc(df.repartition(parts), f"{tmp_path}/{name}", shard_bytes=20_000, roll=4_000)
    assert folder(f"{tmp_path}/a") == folder(f"{tmp_path}/b")


def test_small_payloads_stay_whole(spark, pages, tmp_path):
    rows, df = pages
    warc.write_warc(df, f"{tmp_path}/w", revisit_bytes=12)
    assert found(warc.read_warc(spark, f"{tmp_path}/w")) == expected(rows, least=12)


def test_records_read_by_gzip(spark, pages, tmp_path):
    """Any reader of the format: gzip members, headers, lengths."""
    _, df = pages
    warc.write_warc(df.where("page_id < 3 or page_id = 5002"), f"{tmp_path}/w")
    name = next(iter(folder(f"{tmp_path}/w")))
    data, at, kinds = gzip.open(f"{tmp_path}/w/{name}").read(), 0, []
    while at < len(data):
        head = data[at:data.index(b"\r\n\r\n", at)].decode()
        fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
        kinds.append(fields["WARC-Type"])
        assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["WARC-Record-ID"]) and "a\r\nb" not in head
        at += len(head.encode()) + 4 + int(fields["Content-Length"]) + 4
    assert kinds == ["warcinfo"] + ["response"] * 4


def test_write_that_died(spark, pages, tmp_path):
    rows, df = pages
    to = f"{tmp_path}/w"
    warc.write_warc(df, to)
    whole = folder(to)
    os.makedirs(f"{to}/_temporary")
    name = next(iter(whole))
    open(f"{to}/_temporary/{name}.1234", "wb").write(b"half")
    open(f"{to}/{name}", "ab").write(b"junk")
    with pytest.raises(Exception, match="manifest|WARC|early|decompress"):
        warc.read_warc(spark, to).collect()
    warc.write_warc(df, to)
    assert folder(to) == whole and found(warc.read_warc(spark, to)) == expected(rows)
    with pytest.raises(Exception):
        warc.read_warc(spark, f"{tmp_path}/none").collect()


def test_nothing_and_query(spark, pages, tmp_path):
    rows, df = pages
    warc.write_warc(spark.createDataFrame([], SCHEMA), f"{tmp_path}/w")
    assert warc.read_warc(spark, f"{tmp_path}/w").collect() == []
    df.withColumn("key", F.lit("k")).withColumn("digest", F.lit(1)).withColumn("copy", F.lit(2)).write.parquet(f"{tmp_path}/pages.parquet")
    got = q_warc.op12_warc_files(spark, str(tmp_path)).collect()
    assert sorted([tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got], key=repr) == expected(rows)
