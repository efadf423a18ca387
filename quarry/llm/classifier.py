"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal.

A word is hashed twice: as itself in lower case, and as its *form*, with each
run of capitals, small letters or digits down to one mark and punctuation kept
(``ONE!!`` and ``TWO!!`` are both ``A!!``; a word equal to the one before it
has a form of its own). Single words and pairs of neighbours, of both kinds,
index ``2**BITS`` weights; a feature's value is ``SCALE`` times its share of
the text's features, so texts of any length weigh the same. A score is the
sigmoid of the sparse dot product of that vector with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quarry.llm.bpe import slices
from quarry.llm.frames import col, without
from quarry.llm.pieces import bounded, held

BITS = 18
SCALE = 20.0
#: At most this many labelled rows train the model, those with the smallest hash of their id.
TRAIN_ROWS = 8_000
#: Fewer labelled rows are gone through more than once, to about this many updates, PASSES times at most.
UPDATES, PASSES = 8_000, 8
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.1, 0.0
THRESHOLD = 0.3
MIX = np.uint64(0x9E3779B97F4A7C15)  # 2**64 over the golden ratio
REPEATED, SALT = np.uint64(0x5EED), np.uint64(0xA5)


class Kinds(dict):
    """Character -> its mark in a word's form."""

    def __missing__(self, c: str) -> str:
        mark = self[c] = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return mark


KINDS = Kinds()


class WordHashes(bounded(300_000)):
    """Word -> its two 64-bit hashes as 16 bytes; kept between batches."""

    def __missing__(self, word: str) -> bytes:
        form = "".join(k for k, _ in groupby(map(KINDS.__getitem__, word)))
        return self.put(word, np.array([xxhash.xxh3_64_intdigest(word.lower()), xxhash.xxh3_64_intdigest("\0" + form)], "<u8").tobytes())


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices of all texts, as a matrix with a row for each of the four kinds and a column for each word,
    -1 where a text has no such feature; and the number of words of each text."""
    words = [t.split() if t else [] for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    of = held("word and form", WordHashes).__getitem__
    h = np.frombuffer(b"".join([b"".join(map(of, w)) for w in words]), "<u8").reshape(-1, 2)
    total = len(h)
    starts = (np.cumsum(n) - n)[n > 0]
    plain, form = h[:, 0], h[:, 1].copy()
    begins = np.zeros(total, bool)
    begins[starts] = True
    same = np.zeros(total, bool)
    same[1:] = plain[1:] == plain[:-1]
    form[same & ~begins] = REPEATED
    keys = np.zeros((4, total), np.uint64)
    with np.errstate(over="ignore"):
        keys[0], keys[1] = plain, form
        keys[2, 1:] = plain[:-1] * MIX ^ plain[1:]
        keys[3, 1:] = form[:-1] * MIX ^ (form[1:] + SALT)
        index = (keys * MIX >> np.uint64(64 - BITS)).astype(np.int32)
    index[2:, begins] = -1
    return index, n


def sums_by_text(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``n`` values; 0 for an empty run."""
    out = np.zeros(len(n))
    if len(values):
        out[n > 0] = np.add.reduceat(values, (np.cumsum(n) - n)[n > 0])
    return out


def score_texts(texts: list[str | None], weights: np.ndarray, bias: float) -> np.ndarray:
    """Scores of texts; one without words scores as the bias alone."""
    index, n = features(texts)
    padded = np.append(weights, 0.0)  # index -1 is the zero at the end
    dots = sums_by_text(padded[index].sum(0), n)
    return 1 / (1 + np.exp(-np.clip(bias + SCALE * dots / np.maximum(4 * n - 2, 1), -35, 35)))


class Ftrl:
    """FTRL-proximal: per coordinate, a learning rate that falls with the gradients seen and an L1 pull to zero."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def held_out(doc_id: Column) -> Column:
    """Rows that never train: crc32 of the id as text leaves no remainder by 5. Null ids never train either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> tuple[np.ndarray, float]:
    """Weights and bias learned from at most ``TRAIN_ROWS`` labelled rows that are not held out.

    The rows are those whose ids have the smallest hashes, so a larger table
    only thins the sample. Their texts go to one task in that order, which
    makes the updates one after another and returns ``2**BITS`` weights; the
    driver holds those and no text. Several labels of one id count as their
    largest; null labels are left out. Without any labelled row all weights
    are 0 and every score is 0.5.
    """
    known = labels.where(col(label).isNotNull() & ~held_out(col(doc_id))).groupBy(col(doc_id).alias("_id")).agg(F.max(col(label)).cast("double").alias("_y"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_ROWS).cache()
    passes = max(1, min(PASSES, UPDATES // max(1, sample.count())))
    # an id that repeats gives one text, that of the smallest hash: as many rows as ids
    rows = (docs.select(col(doc_id).alias("_id"), col(text).alias("text")).join(F.broadcast(sample), "_id")
            .groupBy("_id", "_y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
            .withColumn("_pass", F.explode(F.sequence(F.lit(1), F.lit(passes)))))
    ordered = rows.repartition(1).sortWithinPartitions("_pass", F.xxhash64("_id"), "_id", F.xxhash64("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Ftrl((1 << BITS) + 1)  # the last coordinate is the bias
        for batch in batches:
            for t, y in zip(batch["text"], batch["_y"]):
                index, n = features([t])
                at, count = np.unique(index[index >= 0], return_counts=True)
                x = SCALE * count / max(1, count.sum())
                model.update(np.append(at, 1 << BITS), np.append(x, 1.0), y)
        yield pd.DataFrame({"w": [model.weights(slice(None)).astype("<f8").tobytes()]})

    found = ordered.select("text", "_y").mapInPandas(run, "w binary").first()
    sample.unpersist()
    w = np.frombuffer(bytes(found["w"]), "<f8") if found else np.zeros((1 << BITS) + 1)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with a score in column ``to``, from the text alone; null and empty texts get the score of no words.

    Row-local: the model goes out once as a broadcast of fixed size. An input
    column named like ``to`` is replaced.
    """
    docs = without(docs, to)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        for whole in batches:
            for batch in slices(whole, text):
                found = pa.array(score_texts(batch.column(text).to_pylist(), weights, bias))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, to])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(to, DoubleType())]))


def accept(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns as they were."""
    return score(docs, model, to="_quality").where(F.col("_quality") >= threshold).drop("_quality")
