"""Token ids on disk in Simple-8b: 64-bit words of a 4-bit selector and up to 60 bits of ids.

A token file is a folder of Parquet files (so Spark's committer makes a write
whole or not at all, on any store) whose rows are *segments*: a few thousand
documents' ids end to end. A segment's ``payload`` is

    "S8B1" | ids, blocks, words, escapes: 4 unsigned 32-bit | first word of each
    block | first escape of each block (unsigned 32-bit each) | words (unsigned
    64-bit) | escapes (unsigned 32-bit), all little-endian.

A block is ``BLOCK`` ids. Its words each pack ``COUNTS[s]`` ids of ``BITS[s]``
bits, the first in the lowest bits, ``s`` in the top four. A slot of all ones
says that the id stands in the list of escapes, in order, so a rare large id
does not widen its neighbours. The encoder takes for each word the selector
that costs the fewest bytes an id. Blocks start at word and escape offsets of
their own, so many blocks are packed, and unpacked, in step.

The segments also carry their shard (the range of ids they hold) and place in
it; ``start`` follows from a running sum over shards and segments.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.bpe import slices
from quarry.llm.frames import col
from quarry.llm.pieces import Cutter, UnitCache, bare_model, byte_alphabet, give_back, held
from quarry.operators.util import bounded_broadcast

# fixed values: ids per word and bits per id, by selector
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
BLOCK = 256
MAGIC = b"S8B1"
LIMIT = 1 << 32
SEGMENT_BYTES = 4 << 20
#: Ids whose selectors are looked for at a time: few enough to stay in a core's cache.
STRETCH = 16_384
#: Text that is encoded at a time, in segments: common units are looked up once for all of it.
ENCODE_BYTES = 3 * SEGMENT_BYTES


def _selectors(ids: np.ndarray, widest: int) -> np.ndarray:
    """The selector of the fewest bytes an id for a word that begins at each id but the last ``max(COUNTS)``; all are below ``widest``."""
    width = len(ids) - max(COUNTS)
    best, least = np.zeros(width, np.int8), np.full(width, np.inf, np.float32)
    before = np.zeros(len(ids) + 1, np.int32)
    escape, better, cost = np.empty(len(ids), bool), np.empty(width, bool), np.empty(width, np.float32)
    for s, (c, b) in enumerate(zip(COUNTS, BITS)):
        np.greater_equal(ids, np.uint32(min((1 << b) - 1, LIMIT - 1)), out=escape)
        np.cumsum(escape, out=before[1:])
        np.subtract(before[c: c + width], before[:width], out=cost, casting="unsafe")
        cost *= np.float32(4 / c)
        cost += np.float32(8 / c)
        np.less(cost, least, out=better)
        np.copyto(best, np.int8(s), where=better)
        np.minimum(least, cost, out=least)
        if widest < 1 << b:  # nothing escapes: words of fewer ids only cost more
            break
    return best


def pack(ids: np.ndarray) -> bytes:
    """The payload for non-negative ids below 2**32."""
    ids = np.asarray(ids, np.uint64)
    if len(ids) and int(ids.max()) >= LIMIT:
        raise ValueError("ids of 32 bits at most")
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    width = blocks * BLOCK
    padded = np.zeros(width + max(COUNTS), np.uint64)
    padded[:n] = ids
    # best[i]: the selector of the fewest bytes an id for a word that begins at i
    best = np.empty(width, np.int8)
    widest = int(ids.max()) + 1 if n else 0
    small = padded.astype(np.uint32)
    for at in range(0, width, STRETCH):
        best[at:at + STRETCH] = _selectors(small[at:at + STRETCH + max(COUNTS)], widest)
    at = np.arange(blocks, dtype=np.int64) * BLOCK
    end = np.minimum(at + BLOCK, n)
    live = np.arange(blocks)
    steps: list[tuple[np.ndarray, ...]] = []
    counts = np.array(COUNTS, np.int64)
    while len(live):
        here = at[live]
        pick = best[here]
        took = np.minimum(counts[pick], end[live] - here)
        steps.append((live, here, pick, took))
        at[live] += took
        live = live[at[live] < end[live]]
    block = np.concatenate([s[0] for s in steps]) if steps else np.zeros(0, np.int64)
    order = np.argsort(block, kind="stable")  # steps come in order, so words of a block stay in theirs
    begin, pick, took = (np.concatenate([s[k] for s in steps])[order] if steps else np.zeros(0, np.int64) for k in (1, 2, 3))
    words = pick.astype(np.uint64) << np.uint64(60)
    escaped_at = [np.zeros(0, np.int64)]
    for s, (c, b) in enumerate(zip(COUNTS, BITS)):
        of = np.flatnonzero(pick == s)
        mark = np.uint64((1 << b) - 1)
        for k in range(c):
            of = of[took[of] > k]
            if not len(of):
                break
            value = padded[begin[of] + k]
            out = value >= mark
            escaped_at.append(begin[of][out] + k)
            words[of] |= np.where(out, mark, value) << np.uint64(k * b)
    escapes = np.sort(np.concatenate(escaped_at))
    block = block[order]
    first_word = np.searchsorted(block, np.arange(blocks))
    first_escape = np.searchsorted(escapes, np.arange(blocks) * BLOCK)
    return b"".join([MAGIC, struct.pack("<4I", n, blocks, len(words), len(escapes)), first_word.astype("<u4").tobytes(),
                     first_escape.astype("<u4").tobytes(), words.astype("<u8").tobytes(), padded[escapes].astype("<u4").tobytes()])


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a payload, as unsigned 32-bit, all blocks in step."""
    if payload[:4] != MAGIC:
        raise ValueError("not a Simple-8b payload")
    n, blocks, n_words, n_escapes = struct.unpack_from("<4I", payload, 4)
    at = 20
    first_word = np.frombuffer(payload, "<u4", blocks, at).astype(np.int64)
    words = np.frombuffer(payload, "<u8", n_words, at + 8 * blocks)
    escapes = np.frombuffer(payload, "<u4", n_escapes, at + 8 * blocks + 8 * n_words)
    pick = (words >> np.uint64(60)).astype(np.int64)
    count = np.array(COUNTS, np.int64)[pick]
    before = np.cumsum(count) - count
    block = np.repeat(np.arange(blocks), np.diff(np.append(first_word, n_words)))
    begin = block * BLOCK + before - before[first_word][block] if n_words else before
    out = np.zeros(blocks * BLOCK + max(COUNTS), np.uint32)
    marked = np.zeros(len(out), bool)
    room = np.minimum((block + 1) * BLOCK, n)  # a block's last word may have more slots than ids are left
    for s, (c, b) in enumerate(zip(COUNTS, BITS)):
        of = np.flatnonzero(pick == s)
        mark = np.uint64((1 << b) - 1)
        for k in range(c):
            of = of[begin[of] + k < room[of]]
            if not len(of):
                break
            value = words[of] >> np.uint64(k * b) & mark
            to = begin[of] + k
            out[to] = value
            marked[to] = value == mark
    out[np.flatnonzero(marked)] = escapes
    return out[:n]


#: Distinct units, and distinct pre-tokens, of a generation whose ids a Python worker keeps.
KEEP = 250_000


class LibraryIds:
    """Texts to ids, by the library's own model on distinct pre-tokens, many at a time."""

    def __init__(self, path: str):
        self.cut = Cutter(path, model=False)
        self._model = bare_model(path)
        self._units = UnitCache(self.cut, KEEP, KEEP)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share out the cores
        vocab, end = self._model.get_vocab(), self._model.model.end_of_word_suffix
        # a pre-token's last token shows that it is the last, where every byte has such a token
        self._last = None
        if end and all(c + end in vocab for c in byte_alphabet().values()):
            self._last = np.zeros(max(vocab.values()) + 1, bool)
            self._last[[i for t, i in vocab.items() if t.endswith(end)]] = True

    def _ids(self, pieces: set[str]) -> Iterator[tuple[str, bytes]]:
        """Each pre-token with its ids: all of them are one sequence of words to the library."""
        words = list(pieces)
        if not words:
            return iter(())
        ends = None
        if self._last is not None:  # the fast call gives ids alone
            ids = np.array(self._model.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self._last[ids]) + 1
        if ends is None or len(ends) != len(words):
            found = self._model.encode(words, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            ends = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(words)), side="right")
        raw, ends = ids.astype("<u4").tobytes(), (4 * ends).tolist()
        return zip(words, map(raw.__getitem__, map(slice, [0, *ends], ends)))

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each whole text, end to end."""
        return self._units.encode(texts, self._ids)


def library_encoder(path: str) -> LibraryIds:
    """The Python worker's encoder for this file."""
    return held(("library", path), lambda: LibraryIds(path))


SEGMENT = "shard int, segment int, n_ids long, doc_ids array<long>, n_tokens array<int>, payload binary"


def write_tokens(docs: DataFrame, to: str, path: str, end_id: int, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode every whole text and write the token file ``to``, in ascending order of ``doc_id``.

    Each document ends with ``end_id``; a null or empty text has only that.
    Null ids come first; rows of equal id follow each other in the order of
    their texts' hashes, and repeated rows stay. The texts are range-partitioned by id (one shuffle) and encoded
    where they land, so a shard is a range of ids; a segment holds about
    4 MB of text, a longer text one of its own. The write is Spark's, whole or
    not at all.
    """
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    # rows of one id are ranged and sorted by their texts too; equal rows part at their place in the input
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, segment = library_encoder(path), TaskContext.get().partitionId(), 0
        schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                            ("n_tokens", pa.list_(pa.int32())), ("payload", pa.binary())])
        for whole in batches:
            for some in slices(whole, "text", ENCODE_BYTES):
                encoded = enc.encode(some.column("text"))
                at = 0
                for batch in slices(some, "text", SEGMENT_BYTES):
                    raw = [r + last for r in encoded[at:at + batch.num_rows]]
                    at += batch.num_rows
                    ids = np.frombuffer(b"".join(raw), "<u4")
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(ids)]),
                                                      pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                                                      pa.array([[len(r) // 4 for r in raw]], pa.list_(pa.int32())), pa.array([pack(ids)], pa.binary())], schema=schema)
                    segment += 1
                del encoded, raw, ids
                give_back()

    ordered.mapInArrow(run, SEGMENT).write.mode("error").option("compression", "none").parquet(to)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a token file, each with ``first``: the ids of all segments before it."""
    table = spark.read.schema(SEGMENT).parquet(path)
    within = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    index = table.select("shard", "segment", "n_ids")
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # one row per shard, as many as the write had tasks
    before = shards.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    starts = index.withColumn("_within", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(bounded_broadcast(before), "shard")
    starts = starts.select("shard", "segment", (F.col("_before") + F.col("_within")).alias("first"))
    return table.join(bounded_broadcast(starts), ["shard", "segment"])


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each segment: document ids, each one's first id in the file, ends within the segment, and the ids."""
    for row in range(batch.num_rows):
        get = lambda c: batch.column(batch.schema.get_field_index(c))[row].as_py()  # noqa: E731,B023
        ends = np.cumsum(get("n_tokens"), dtype=np.int64)
        yield get("doc_ids"), get("first") + np.append(0, ends[:-1]), ends, unpack(get("payload"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids)`` of every document of a token file, read block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, start, ends, ids in _documents(batch):
                lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, ends)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start), lists.cast(pa.list_(pa.int32()))], names=["doc_id", "start", "ids"])

    return segments(spark, path).select("doc_ids", "n_tokens", "payload", "first").mapInArrow(run, "doc_id long, start long, ids array<int>")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document of a token file: the crc of its ids as little-endian 32-bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, start, ends, ids in _documents(batch):
                raw = memoryview(ids.astype("<u4").tobytes())
                bounds = np.append(0, ends) * 4
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start), pa.array(np.diff(ends, prepend=0)), pa.array(crc, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments(spark, path).select("doc_ids", "n_tokens", "payload", "first").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
