"""N-gram Jaccard join with Bayesian candidate pruning.

1. Texts become sets of word 5-grams and MinHash signatures; equal texts are
   one class from here on.
2. Classes that share a band of their signatures meet in a bucket. Large
   buckets are cut into blocks, and blocks meet in pairs, so no task holds a
   bucket. A pair counts only in the first band it shares.
3. A pair's MinHash values are compared a few at a time. After ``m`` matches of
   ``n`` the similarity has a Beta(m + 1, n - m + 1) posterior (uniform prior);
   once the probability that it reaches the threshold is below ``TOLERANCE``
   the pair is dropped.
4. The pairs left are verified on their whole sets. A block pair returns, per
   text, how many links it found and one link of a local spanning forest; the
   pairs themselves never leave the task.
5. Links are joined up by contraction to the smallest neighbour.

With ``BANDS`` bands of ``ROWS`` values a pair of similarity 0.8 shares no band
with probability (1 - 0.8**4)**24, about 3e-6, and less above; there is no cap
on partners, candidates or bucket sizes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import slices
from quarry.llm.frames import col
from quarry.llm.pieces import bounded, held
from quarry.operators.util import bounded_broadcast, checkpoint

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
#: MinHash values compared at a time, and the posterior probability below which a pair is dropped.
STEP, TOLERANCE = 16, 1e-6
#: A block holds about this many texts and shingles at most.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 1_000_000
#: Pairs that are compared, and columns of the incidence matrix that are multiplied, at a time.
PAIRS, COLUMNS = 1 << 20, 4096
#: Bytes of text that are hashed at a time.
SLICE = 2 << 20

_draw = np.random.default_rng(20240817)
FACTORS = _draw.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLY = _draw.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)


class WordHashes(bounded(400_000)):
    """Word -> its 64-bit hash as 8 bytes; kept between batches."""

    def __missing__(self, word: str) -> bytes:
        return self.put(word, xxhash.xxh3_64_intdigest(word).to_bytes(8, "little"))


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' word 5-grams end to end, and how many each text has.

    Words are runs free of white space. A text of one to four words has one
    shingle, all of it; a null or blank text has none.
    """
    words = [t.split() if t else [] for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    pad = bytes(8 * (SHINGLE - 1))
    of = held("words", WordHashes).__getitem__
    h = np.frombuffer(b"".join([b"".join(map(of, w)) + pad for w in words]), "<u8")
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    with np.errstate(over="ignore"):
        mixed = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
        for j, f in enumerate(FACTORS):
            mixed += h[j: len(mixed) + j] * f
        mixed ^= mixed >> np.uint64(29)
        mixed *= MULTIPLY[0]
        mixed ^= mixed >> np.uint64(32)
    width = n + SHINGLE - 1
    begin = np.cumsum(width) - width
    first = np.repeat(begin - (np.cumsum(count) - count), count)
    return mixed[first + np.arange(len(first))], count


def distinct(h: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """The set of each text's shingles, sorted, from ``shingles``."""
    return [np.unique(x) for x in np.split(h, np.cumsum(count)[:-1])] if len(count) else []


def signatures(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """MinHash values, a row for each text (all ones for a text without shingles), and the sizes of the shingle sets."""
    h, count = shingles(texts)
    out = np.full((len(texts), HASHES), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(count)
    if len(some):
        starts = (np.cumsum(count) - count)[some]
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                out[some, k] = np.minimum.reduceat((h * MULTIPLY[k] + ADD[k] >> np.uint64(32)).astype(np.uint32), starts)
    return out, np.array([len(x) for x in distinct(h, count)], np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """Number of compared values -> matches below which a pair is dropped.

    The posterior probability of reaching ``threshold`` is that of at most
    ``m`` successes in ``n + 1`` draws of chance ``threshold``.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = 0.0, 0
        for m in range(n + 1):
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if chance >= tolerance:
                break
        out[n] = m
    return out


def text_key(text: Column) -> Column:
    """Names a text's class: 16 bytes; null as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def grouped(batches: Iterator[pa.RecordBatch], by: list[str], most: int) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``by``, about ``most`` rows each."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = [table.column(c).to_numpy() for c in by]
        change = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            change |= k[1:] != k[:-1]
        cut = np.flatnonzero(change)
        if len(cut):
            yield table.slice(0, int(cut[-1]) + 1)
            held = table.slice(int(cut[-1]) + 1).to_batches()
            rows = sum(x.num_rows for x in held)
        else:
            held = table.to_batches()
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def binary_rows(column: pa.ChunkedArray, dtype: str, width: int) -> np.ndarray:
    """A binary column of fixed width as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of equal keys."""
    change = np.ones(len(keys[0]), bool)
    change[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    begin = np.flatnonzero(change)
    return begin, np.append(begin[1:], len(keys[0]))


def pairs_of(begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within runs, the earlier row first, about ``PAIRS`` at a time."""
    ends = np.repeat(end, end - begin)
    row = np.arange(len(ends))
    after = ends - row - 1
    total = np.cumsum(after)
    at = 0
    while at < len(row):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        n = after[at:to]
        a = np.repeat(row[at:to], n)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        at = to


def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block pairs ``(band, bucket, i, j, block, key, n, sig)`` -> the texts and pairs that are left for verification.

    A row for each block pair with such pairs: the keys, and the pairs as
    32-bit positions in them.
    """
    least = least_matches()
    for table in grouped(batches, ["bucket", "i", "j"], 4096):
        band, bucket, i, j, block, n = (table.column(c).to_numpy() for c in ("band", "bucket", "i", "j", "block", "n"))
        sig = binary_rows(table.column("sig"), "<u4", HASHES)
        begin, end = runs(bucket, i, j)
        group = np.repeat(np.arange(len(begin)), end - begin)
        found = []
        for a, b in pairs_of(begin, end):
            ok = (i[a] == j[a]) | (block[a] != block[b])  # a pair within a block counts where the block meets itself
            ok &= np.minimum(n[a], n[b]) >= THRESHOLD * np.maximum(n[a], n[b]) - 1e-9  # sizes of sets: a passage said twice counts once
            a, b = a[ok], b[ok]
            for k in range(BANDS):  # only in the first band that the two share
                if not len(a):
                    break
                cut = slice(k * ROWS, (k + 1) * ROWS)
                ok = (band[a] <= k) | (sig[a, cut] != sig[b, cut]).any(1)
                a, b = a[ok], b[ok]
            matches = np.zeros(len(a), np.int32)
            for to in range(STEP, HASHES + 1, STEP):
                if not len(a):
                    break
                matches += (sig[a, to - STEP: to] == sig[b, to - STEP: to]).sum(1, dtype=np.int32)
                ok = matches >= least[to]
                a, b, matches = a[ok], b[ok], matches[ok]
            if len(a):
                found.append((a, b))
        if not found:
            continue
        a, b = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(group[a], kind="stable")
        a, b = a[order], b[order]
        keys = table.column("key").to_pylist()
        lists, places = [], []
        for x, y in zip(*runs(group[a])):
            used, back = np.unique(np.concatenate([a[x:y], b[x:y]]), return_inverse=True)
            lists.append([keys[r] for r in used])
            places.append(back.reshape(2, -1).astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.binary())), pa.array(places, pa.binary())], names=["keys", "pairs"])


def shared(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``a`` and ``b`` (sorted, distinct)."""
    if len(a) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)], np.int64)
    size = np.array([len(s) for s in sets])
    value, at, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    keep = often[at] > 1  # the others are in no intersection
    number = np.cumsum(often > 1) - 1
    row, at = row[keep], number[at[keep]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    product = np.zeros((len(sets), len(sets)), np.float64)
    for c in range(0, int((often > 1).sum()), COLUMNS):
        x, y = np.searchsorted(at, (c, c + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[x:y], at[x:y] - c] = 1
        product += part @ part.T
    return product[a, b].astype(np.int64)


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(task, place, key, copies, pairs, shingles)`` -> per text of a block pair its links and a linked text.

    ``links`` are linked texts, ``linked`` their documents, ``other`` the text
    that stands for its connected texts in this block pair.
    """
    schema = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("linked", pa.int64()), ("other", pa.binary())])
    for table in grouped(batches, ["task"], 1024):
        begin, end = runs(table.column("task").to_numpy())
        for x, y in zip(begin.tolist(), end.tolist()):
            part = table.slice(x, y - x)
            keys, copies = part.column("key").to_pylist(), part.column("copies").to_numpy()
            sets = [np.frombuffer(s, "<u8") for s in part.column("shingles").to_pylist()]
            a, b = np.frombuffer(part.column("pairs")[0].as_py(), "<i4").reshape(2, -1)
            size = np.array([len(s) for s in sets])
            common = shared(sets, a, b)
            union = size[a] + size[b] - common
            real = (common >= THRESHOLD * union - 1e-9) | (union == 0)
            a, b = a[real], b[real]
            if not len(a):
                continue
            links = np.bincount(a, minlength=len(keys)) + np.bincount(b, minlength=len(keys))
            linked = np.bincount(a, copies[b], len(keys)) + np.bincount(b, copies[a], len(keys))
            root = np.arange(len(keys))
            while True:
                low = np.minimum(root[a], root[b])
                new = root.copy()
                np.minimum.at(new, a, low)
                np.minimum.at(new, b, low)
                new = new[new]
                if (new == root).all():
                    break
                root = new
            on = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array([keys[k] for k in on], pa.binary()), pa.array(links[on], pa.int64()),
                                              pa.array(linked[on].astype(np.int64)), pa.array([keys[root[k]] for k in on], pa.binary())], schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """``(key, root)`` of every key of ``edges`` (``key``, ``other``): keys that are connected have one root.

    Each round, every key joins the smallest of its neighbours and itself, and
    edges go on between those; keys are hashes, so their order is as good as
    random and the number of keys with edges falls by half or more a round on
    average. Both tables are written each round; the driver sees a count.
    """
    both = edges.select("key", "other").union(edges.select(F.col("other").alias("key"), F.col("key").alias("other")))
    left = checkpoint(both.where("key <> other").distinct())
    roots = checkpoint(both.select("key").distinct().withColumn("root", F.col("key")))
    while left.limit(1).count():
        up = left.groupBy("key").agg(F.min("other").alias("low")).select(F.col("key").alias("root"), F.least("key", "low").alias("up"))
        up = checkpoint(up)
        roots = checkpoint(roots.join(up, "root", "left").select("key", F.coalesce("up", "root").alias("root")))
        moved = (left.join(up.select(F.col("root").alias("key"), F.col("up").alias("a")), "key")
                 .join(up.select(F.col("root").alias("other"), F.col("up").alias("b")), "other"))
        left = checkpoint(moved.where("a <> b").select(F.col("a").alias("key"), F.col("b").alias("other")).distinct())
    return roots


def similar_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, key, root, class_id, n_links, n_texts)`` for every row of ``docs``.

    Two documents are linked if the Jaccard similarity of their shingle sets
    is ``THRESHOLD`` or more; two without any shingle are linked too. Classes
    are the connected groups, named by ``root``; ``class_id`` is the smallest id
    in it (null only where all its ids are; an id that repeats with unlike
    texts may be that of two classes). ``n_links`` counts the other documents linked to
    the row's text, copies included; ``n_texts`` the linked texts. Null texts
    are empty texts. Repeated rows are copies of each other. Other columns are
    left behind.
    """
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"), text_key(col(text)).alias("key"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                sig, n = signatures(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(n, pa.int64()), pa.array([s.astype("<u4").tobytes() for s in sig], pa.binary())],
                                                 names=["doc_id", "key", "n", "sig"])

    signed = checkpoint(rows.mapInArrow(sign, "doc_id long, key binary, n long, sig binary"))
    texts = checkpoint(signed.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    verified = checkpoint(links_of(rows, texts))
    counts = verified.groupBy("key").agg(F.sum("links").alias("n_texts"), F.sum("linked").alias("linked"))
    roots = components(verified.select("key", "other"))
    placed = texts.select("key", "first_id", "copies").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    names = placed.groupBy("root").agg(F.min("first_id").alias("class_id"))
    classes = placed.join(names, "root").join(counts, "key", "left").select(
        "key", "root", "class_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("n_texts", F.lit(0)).alias("n_texts"))
    return signed.select("doc_id", "key").join(classes, "key").select("doc_id", "key", "root", "class_id", "n_links", "n_texts")


def links_of(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links of ``texts`` (key, first_id, copies, n: distinct shingles, sig), as ``verify`` gives them; ``rows`` (doc_id, text, key) are where the texts are."""
    width = 4 * ROWS
    bands = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", b * width + 1, width)) for b in range(BANDS)])
    listed = texts.select("key", "n", F.posexplode(bands).alias("band", "bucket"))
    sizes = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).where("c > 1")
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK_TEXTS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    met = (listed.drop("n").join(sizes.select("bucket", blocks.alias("blocks")), "bucket").withColumn("block", F.pmod(F.xxhash64("key", "bucket"), F.col("blocks")).cast("int"))
           .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("band", "bucket", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "key"))
    dealt = met.join(texts.select("key", "n", "sig"), "key").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    columns = ["band", "bucket", "i", "j", "block", "key", "n", "sig"]
    left = checkpoint(dealt.select(*columns).mapInArrow(candidates, "keys array<binary>, pairs binary").withColumn("task", F.monotonically_increasing_id()))
    asked = left.select("task", "pairs", F.posexplode("keys").alias("place", "key")).select(
        "task", "place", "key", F.when(F.col("place") == 0, F.col("pairs")).alias("pairs"))
    wanted = asked.select("key").distinct().join(texts.select("key", "first_id", "copies"), "key")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                h, n = shingles(b.column("text").to_pylist())
                out = [x.astype("<u8").tobytes() for x in distinct(h, n)]
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("copies"), pa.array(out, pa.binary())], names=["key", "copies", "shingles"])

    one = bounded_broadcast(wanted.withColumnRenamed("first_id", "doc_id"))
    held = rows.join(one, (rows["key"] == one["key"]) & rows["doc_id"].eqNullSafe(one["doc_id"])).select(rows["key"], "copies", "text")
    held = held.mapInArrow(sets, "key binary, copies long, shingles binary").dropDuplicates(["key"])
    full = asked.join(held, "key").repartition("task").sortWithinPartitions("task", "place")
    return full.select("task", "place", "key", "copies", "pairs", "shingles").mapInArrow(verify, "key binary, links long, linked long, other binary")


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` less all but one row of each class: that of its smallest id, with all its columns.

    Of several texts under that id the one with the smallest key stays, of
    several equal rows one. A class without ids keeps a row too.
    """
    found = similar_classes(docs, text, doc_id)
    # one row a class: its smallest id (null where it has none) and text
    chosen = found.groupBy("root").agg(F.first("class_id").alias("_class_id"), F.min(F.when(F.col("doc_id").eqNullSafe(F.col("class_id")), F.col("key"))).alias("_class_text"))
    here = docs.withColumn("_class_key", text_key(col(text)))
    kept = here.join(chosen.drop("root"), col(doc_id).cast("long").eqNullSafe(F.col("_class_id")) & (F.col("_class_key") == F.col("_class_text")))
    return kept.dropDuplicates(["_class_id", "_class_text"]).select(*[col(c) for c in docs.columns])
