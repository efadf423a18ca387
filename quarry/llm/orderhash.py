"""Document fingerprints by Order MinHash (DataFrame functions only).

A text's symbols are its words, cut after ``WORD`` characters; its k-mers are
the pairs of neighbouring symbols. Each k-mer is hashed together with the
number of its occurrence in the text, so a passage that comes twice counts
twice. Under each of ``SKETCHES`` orders the ``TUPLE`` smallest k-mers are
taken and put back into the order in which the text has them, and the hash of
that tuple is one entry of the fingerprint. Two texts agree in an entry only
if they share those k-mers *in the same order*, so likeness falls with edit
distance and not only with the set of k-mers.

The orders are rotations of one hash: order ``j`` starts at the ``j``-th of
``SKETCHES`` equal arcs and goes round. One sort of a text's k-mers then
serves all orders, and a text of any length costs one pass. K-mers travel as
longs, hash above, position below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.frames import col, row_key

WORD = 8
ARC_BITS = 5
SKETCHES = 1 << ARC_BITS
TUPLE = 2
POSITION_BITS = 24  # texts of up to 16 million symbols keep their exact order
POSITION = (1 << POSITION_BITS) - 1
#: Rows of a run of consecutive documents, and how many runs there are at most.
RUN_ROWS, RUNS = 2048, 65_536


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often ``body`` uses it, inner functions included."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hash_part(x: Column) -> Column:
    return F.shiftright(x, POSITION_BITS)


def _with_position(h: Column, at: Column) -> Column:
    return h.bitwiseAND(F.lit(~POSITION)).bitwiseOR(at.bitwiseAND(F.lit(POSITION)))


def _indices(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _run_starts(a: Column, of: Callable[[Column], Column]) -> Column:
    """Indices at which ``of`` the sorted array's elements changes, the first included."""
    return F.filter(_indices(F.size(a)), lambda i: (i == 0) | (of(F.get(a, i)) != of(F.get(a, F.greatest(i - 1, F.lit(0))))))


def kmers(text: Column) -> Column:
    """Hashes of the k-mers with their positions, sorted. A text of one symbol has that one."""
    symbols = F.transform(F.regexp_extract_all(text, F.lit(rf"\S{{1,{WORD}}}"), F.lit(0)), lambda s: F.xxhash64(s))

    def pairs(h: Column) -> Column:
        n = F.size(h)
        two = F.zip_with(F.slice(h, F.lit(1), n - 1), F.slice(h, F.lit(2), n - 1), lambda a, b: F.xxhash64(a, b))
        return F.when(n > 1, two).otherwise(h)

    return F.sort_array(F.transform(let(symbols, pairs), lambda h, i: _with_position(h, i.cast("long"))))


def numbered(s: Column) -> Column:
    """Sorted k-mers, each later occurrence of one hashed anew with its number."""

    def again(starts: Column) -> Column:
        n = F.size(s)

        def one(first: Column, j: Column) -> Column:
            last = F.coalesce(F.get(starts, j + 1), n) - 1
            return F.transform(F.sequence(first, last), lambda i: F.when(i == first, F.get(s, i)).otherwise(
                _with_position(F.xxhash64(_hash_part(F.get(s, i)), i - first), F.get(s, i))))

        return F.when(F.size(starts) == n, s).otherwise(F.sort_array(F.flatten(F.transform(starts, one))))

    return let(_run_starts(s, _hash_part), again)


def sketch(e: Column) -> Column:
    """The fingerprint's entries from sorted numbered k-mers; none for none."""
    arc = lambda x: F.shiftright(x, 64 - ARC_BITS) + (SKETCHES >> 1)

    def entries(starts: Column) -> Column:
        n = F.size(e)

        def entry(j: Column) -> Column:
            begin = F.coalesce(F.get(F.filter(starts, lambda i: arc(F.get(e, i)) >= j), F.lit(0)), F.lit(0))
            taken = F.transform(F.sequence(F.lit(0), F.least(F.lit(TUPLE), n) - 1), lambda t: F.get(e, (begin + t) % n))
            # position above, hash below: sorted, they are in the text's order
            in_order = F.sort_array(F.transform(taken, lambda x: F.shiftleft(x.bitwiseAND(F.lit(POSITION)), 64 - POSITION_BITS).bitwiseXOR(F.lit(-(1 << 63)))
                                                .bitwiseOR(F.shiftrightunsigned(x, POSITION_BITS))))
            return F.aggregate(in_order, F.lit(0).cast("long"), lambda acc, x: F.xxhash64(acc, x.bitwiseAND(F.lit((1 << (64 - POSITION_BITS)) - 1))))

        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.lit(SKETCHES - 1)), lambda j: entry(j).bitwiseAND(F.lit(0xFFFFFFFF))))

    return F.coalesce(let(_run_starts(e, arc), entries), F.array().cast("array<bigint>"))


def order_minhash(text: Column) -> Column:
    """The entries of a text's fingerprint (array of long below 2**32); an empty array for a null or blank text."""
    return let(let(kmers(F.coalesce(text, F.lit(""))), numbered), sketch)


def as_string(entries: Column) -> Column:
    """Eight hexadecimal digits an entry; empty for a text without symbols."""
    return F.array_join(F.transform(entries, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries; 1 for two texts without symbols, 0 where only one has none."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(SKETCHES))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(same)


def next_in_order(docs: DataFrame, order: str, columns: dict[str, str]) -> DataFrame:
    """``docs`` with, for each ``column: name``, the value of the next row by ``order`` as ``name``; after the last comes the first.

    No window spans the table: quantiles of ``order`` (a long column; null
    sorts first) cut it into runs of about ``RUN_ROWS`` rows, and the rows at
    which a run begins go into the run before as well, as the next of its last
    row. One shuffle. Rows of equal ``order`` follow by a hash of the row.
    """
    at = F.coalesce(col(order).cast("long"), F.lit(-(1 << 63)))
    n = docs.select(F.count(F.lit(1))).first()[0]
    runs = int(max(1, min(RUNS, -(-n // RUN_ROWS))))
    cuts = docs.select(F.percentile_approx(at, [i / runs for i in range(runs)], 10 * runs)).first()[0] or [0]
    cuts = sorted({*cuts[1:], docs.select(F.min(at)).first()[0] or 0}) if n else [0]
    bounds = F.array(*[F.lit(x).cast("long") for x in cuts])
    key = docs.withColumn("_at", at).withColumn("_tie", row_key(docs))
    # binary search for the last cut at or below the row
    steps = F.sequence(F.lit(1), F.lit(max(1, len(cuts).bit_length())))
    halve = lambda acc, _: F.when(acc["hi"] - acc["lo"] <= 1, acc).otherwise(
        let(((acc["lo"] + acc["hi"]) / 2).cast("int"), lambda mid: F.when(F.get(bounds, mid) <= F.col("_at"), F.struct(mid.alias("lo"), acc["hi"].alias("hi")))
            .otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi")))))
    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")), halve)
    placed = key.withColumn("_run", found["lo"])
    own = F.struct(F.col("_run").alias("run"), F.lit(False).alias("extra"))
    before = F.struct(F.pmod(F.col("_run") - 1, F.lit(len(cuts))).alias("run"), F.lit(True).alias("extra"))
    begins = F.get(bounds, F.col("_run")) == F.col("_at")
    dealt = placed.withColumn("_in", F.explode(F.when(begins, F.array(own, before)).otherwise(F.array(own))))
    order_in = Window.partitionBy("_in.run").orderBy("_in.extra", "_at", "_tie")
    led = dealt.select("*", *[F.lead(col(c)).over(order_in).alias(name) for c, name in columns.items()])
    return led.where(~F.col("_in.extra")).drop("_at", "_tie", "_run", "_in")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, ``text``, ``entries`` of its fingerprint, ``next_text`` and ``next_entries`` of the next document by id.

    Null texts are empty. Every row comes back; other columns are left behind.
    """
    rows = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    return next_in_order(rows.withColumn("entries", order_minhash(F.col("text"))), "doc_id", {"text": "next_text", "entries": "next_entries"})
