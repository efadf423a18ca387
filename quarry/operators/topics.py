"""Topic models (LDA1-LDA4, LIN4, TOP2, TOP3, RSH3).

Two routes: Spark ML's LDA (online variational Bayes) on count vectors, and
a blocked Gibbs sampler written as Spark jobs. In the sampler the topic
draws of (document, term) cells are independent given the topic-word
matrix B and the document-topic matrix T, so one iteration is:

1. m = topic-term counts, added up by shard (``doc_parts``), B ~ Dir(m + eta)
   drawn per term chunk (one RNG per (seed, iteration, chunk)) as logarithms
   of Gamma draws, normalised by per-topic log sums (K numbers);
2. each part of the documents (``doc_parts``) gets its own terms' rows of B
   and draws T ~ Dir(n + alpha) per document and a topic per cell with
   p ~ T[k] * B[v, k], again in logarithms;
3. parts and counts are written (lineage cut, survives executor loss).

Only the two norms and the K sums of each iteration reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import doc_parts as DP
from quarry.operators.util import checkpoint, discard, with_global_index


# ---------------------------------------------------------------- Spark ML LDA

def count_vectors(docs: DataFrame, tokens_col: str = "tokens", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``(vocabulary, vectors)``: every term with its ``term_index``, and ``(id, features)`` counts over all of them.

    The vocabulary is a table (``with_global_index``), of any size; only its
    row count is on the driver. Ids are unique; a document without tokens has
    no vector.
    """
    from quarry.operators.matrix import doc_term_matrix, to_ml_vectors

    dtm = checkpoint(doc_term_matrix(docs, id_col, tokens_col))
    vocab = checkpoint(with_global_index(dtm.select("term").distinct(), ["term"], "term_index"))
    return vocab, to_ml_vectors(dtm, vocab, vocab.count(), id_col)


def lda_fit(train: DataFrame, k: int = 5, max_iter: int = 50, seed: int = 1, doc_concentration: float = 0.1,
            topic_concentration: float = 0.01, features_col: str = "features"):
    """LDA1 / LDA3: online LDA with the priors of the reference's library; each iteration sees all training rows."""
    lda = LDA(k=k, maxIter=max_iter, seed=seed, optimizer="online", featuresCol=features_col, subsamplingRate=1.0,
              docConcentration=[doc_concentration] * k, topicConcentration=topic_concentration)
    return lda.fit(train)


def lda_project(model, docs: DataFrame, id_col: str = "doc_id", prefix: str = "lda") -> DataFrame:
    """LDA2 + RSH3: topic distribution of every document as columns lda1..ldaK."""
    k = model.getK()
    arr = vector_to_array(F.col("topicDistribution"))
    out = model.transform(docs).select(id_col, arr.alias("_td"))
    return out.select(id_col, *[F.col("_td")[i].alias(f"{prefix}{i + 1}") for i in range(k)])


def topic_top_words(model, vocabulary: DataFrame, n: int = 10) -> DataFrame:
    """TOP2 / LDA4: the n heaviest terms per topic with their weights.

    ``vocabulary`` is ``(term, term_index)``; the K x n chosen indices are
    broadcast to it.
    """
    topics = model.describeTopics(n)
    ex = topics.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "tw"))
    ex = ex.select("topic", (F.col("rank") + 1).alias("rank"), F.col("tw.termIndices").cast("long").alias("term_index"),
                   F.col("tw.termWeights").alias("weight"))
    return vocabulary.join(F.broadcast(ex), "term_index").select("topic", "rank", "term", "weight")


def doc_top_topics(projections: DataFrame, id_col: str = "doc_id", prefix: str = "lda", k: int | None = None,
                   n: int = 3) -> DataFrame:
    """TOP3: the n most probable topics per document (q10: theta, not B).

    A row-local sort of K (topic, p) pairs: no window, no shuffle.
    """
    cols = [c for c in projections.columns if c.startswith(prefix)] if k is None else [f"{prefix}{i + 1}" for i in range(k)]
    pairs = F.array(*[F.struct(F.col(c).alias("p"), F.lit(i + 1).alias("topic")) for i, c in enumerate(cols)])
    top = F.slice(F.sort_array(pairs, asc=False), 1, n)
    ex = projections.select(id_col, F.posexplode(top).alias("rank", "tp"))
    return ex.select(id_col, (F.col("rank") + 1).alias("rank"), F.col("tp.topic").alias("topic"), F.col("tp.p").alias("p"))


# ---------------------------------------------------------------- Gibbs LDA

CHUNK = 4096


def log_gamma_draws(shape: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Logarithms of Gamma(shape, 1) draws, for shapes however small.

    Gamma(a) has the law of Gamma(a + 1) * U ** (1 / a): its logarithm stays
    finite where the draw itself would be 0 in double precision.
    """
    return np.log(rng.standard_gamma(shape + 1.0)) + np.log1p(-rng.random(shape.shape)) / shape


def _normalised(log_p: np.ndarray) -> np.ndarray:
    """Rows of log weights as probabilities."""
    p = np.exp(log_p - log_p.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


#: A shard of log Gamma draws, with each topic's largest and the sum of the others against it.
_DRAWS = DP.SHARDS + ", peaks array<double>, totals array<double>"


def _draw_b(k: int, eta: float, seed: int, it: int):
    """Log Gamma draws of a shard's terms by chunks; the seed is the chunk's, so partitions do not matter."""

    def fn(batches):
        for pdf in batches:
            for i in range(len(pdf)):
                terms, sums = DP.rows_of(pdf.iloc[i])
                chunk = terms // CHUNK
                g = np.empty((len(terms), k))
                for c in np.unique(chunk):
                    own = chunk == c
                    g[own] = log_gamma_draws(sums[own] + eta, np.random.default_rng([seed, it, int(c), 1]))
                peaks = g.max(axis=0)
                yield pdf.iloc[[i]].assign(numbers=[g.tobytes()], peaks=[peaks.tolist()], totals=[np.exp(g - peaks).sum(axis=0).tolist()])

    return fn


def _squares(log_sums: list[float]):
    """The sum of B's squared entries by shard."""

    def fn(batches):
        for pdf in batches:
            for i in range(len(pdf)):
                yield pdf.iloc[[i]][["shard"]].assign(n=float((np.exp(DP.rows_of(pdf.iloc[i])[1] - log_sums) ** 2).sum()))

    return fn


def _doc_step(k: int, alpha: float, seed: int, it: int, log_sums: list[float]):
    """A part's documents: T ~ Dir(n + alpha) per document, then a topic per cell with p ~ T[k] * B[v, k]."""

    def fn(part: DP.Part, terms: np.ndarray, g: np.ndarray):
        rng = np.random.default_rng([seed, it, part.part, 2])
        drawn = part.z >= 0  # before the first iteration no cell has a topic
        n = np.zeros((len(part.docs), k))
        n += np.bincount(part.of[drawn] * k + part.z[drawn], part.tf[drawn], n.size).reshape(n.shape)
        log_t = log_gamma_draws(n + alpha, rng)
        own = part.own
        p = _normalised((g - log_sums)[own] + log_t[part.of])
        if not np.isfinite(p).all():
            raise ValueError("topic weights that are no numbers")
        z = np.minimum((p.cumsum(axis=1) < rng.random(len(p))[:, None]).sum(axis=1), k - 1)
        m = np.bincount(own * k + z, part.tf, len(terms) * k).reshape(-1, k)
        theta = _normalised(log_t)
        return part.state(terms, m, z, theta, float((theta**2).sum()))

    return fn


def gibbs_lda(dtm: DataFrame, k: int = 5, eta: float | None = None, alpha: float | None = None,
              max_iter: int = 20, cutoff: float = 0.01, seed: int = 0, id_col: str = "doc_id"):
    """LIN4: blocked Gibbs LDA on a long DTM ``(doc_id, term, tf)``.

    Defaults eta = 200 / V, alpha = 50 / K. The first B and T are drawn from
    their priors (all counts 0). Stops when the Frobenius norms of both B and T
    move by less than ``cutoff`` from one iteration to the next (AGG22), or
    after ``max_iter`` iterations. Returns ``(theta, beta, history, counts)``:
    ``theta(doc_id, topic, p)``, ``beta(term, topic, p)``, the norms of each
    iteration, and ``counts(doc_id, topic, n)``, the tokens of each document by
    their last topic.
    """
    from quarry.operators.matrix import attach_by_term

    spark = dtm.sparkSession
    vocab = checkpoint(with_global_index(dtm.select("term").distinct(), ["term"], "term_index"))
    v_size = vocab.count()
    eta = 200.0 / v_size if eta is None else eta
    alpha = 50.0 / k if alpha is None else alpha
    cells = attach_by_term(checkpoint(dtm.select(F.col(id_col).alias("doc_id"), "term", "tf")), vocab).select(
        F.col("doc_id").cast("long").alias("doc_id"), "term_index", "tf")
    docs, table, g = DP.DocParts(checkpoint(cells)), None, None
    history: list[tuple[int, float, float]] = []
    topics = range(k)
    for it in range(1, max_iter + 1):
        m = DP.summed(table) if table is not None else docs.zeros(k)
        discard(g)
        g = checkpoint(m.mapInPandas(_draw_b(k, eta, seed, it), _DRAWS))
        # B in logarithms: g less the logarithm of its topic's sum
        most = g.agg(*[F.max(F.col("peaks")[j]) for j in topics]).first()
        sums = g.agg(*[F.sum(F.col("totals")[j] * F.exp(F.col("peaks")[j] - most[j])) for j in topics]).first()
        log_sums = [float(most[j] + np.log(sums[j])) for j in topics]
        before, table = table, docs.step(table, g, _doc_step(k, alpha, seed, it, log_sums))
        DP.drop(before)
        norm_b = g.select("shard", "terms", "numbers").mapInPandas(_squares(log_sums), "shard long, n double").agg(F.sqrt(F.sum("n"))).first()[0]
        norm_t = DP.parts(table).agg(F.sqrt(F.sum("total"))).first()[0]
        history.append((it, float(norm_b), float(norm_t)))
        if it > 1 and all(abs(x - y) < cutoff for x, y in zip(history[-1][1:], history[-2][1:])):
            break
    long = lambda df, key, c: df.select(key, F.posexplode(F.array(*[F.col(f"{c}{j}") for j in topics])).alias("topic", "p"))
    b = DP.unpacked(g, [f"g{j}" for j in topics]).select("term_index", *[F.exp(F.col(f"g{j}") - log_sums[j]).alias(f"b{j}") for j in topics])
    theta = long(docs.unpack(table, [f"t{j}" for j in topics]), "doc_id", "t")
    beta = long(b.join(vocab, "term_index"), "term", "b")
    return theta, beta, spark.createDataFrame(history, "iteration int, norm_beta double, norm_theta double"), docs.topic_counts(table)
