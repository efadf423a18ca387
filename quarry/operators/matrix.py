"""Long sparse document-term and TF-IDF matrices (AGG4-AGG12).

Matrices are kept as ``(doc_id, term, value)`` rows: the non-zero cells
only. IDF is ``ln(N / df)`` (natural log, no smoothing) and TF is
``1 + ln(count)``; this is *not* Spark ML's smoothed IDF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.util import bounded_broadcast, checkpoint, explode_nonempty, one_row, split_hot_join, with_global_index


def explode_terms(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens",
                  term_col: str = "term", with_pos: bool = False) -> DataFrame:
    """One row per token occurrence."""
    if with_pos:
        return explode_nonempty(docs, [id_col], tokens_col, term_col, "pos")
    return explode_nonempty(docs, [id_col], tokens_col, term_col)


def doc_term_matrix(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """AGG7: ``(doc_id, term, tf)`` counts.

    Map-side partial aggregation collapses each document's tokens before the
    shuffle, so only non-zero cells cross the network.
    """
    return (explode_terms(docs, id_col, tokens_col)
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def attach_by_term(cells: DataFrame, table: DataFrame, key: str = "term", how: str = "inner") -> DataFrame:
    """Join long cells with a per-term table (vocabulary index, weights).

    Common terms are hot keys of the cell side; their rows of ``table`` go
    through a bounded broadcast (:func:`split_hot_join`), the rest shuffle.
    Counts the cells once (a job) to find the hot terms.
    """
    counts = cells.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return split_hot_join(cells, table, key, counts, cells.count(), how=how)


def term_vector(texts: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id",
                tokens_col: str = "tokens") -> DataFrame:
    """AGG6: counts of each text's tokens restricted to a given vocabulary.

    ``vocabulary`` has ``(term, term_index)``; tokens outside it are dropped.
    The vocabulary grows with the corpus, so it is never broadcast whole.
    """
    dtm = checkpoint(doc_term_matrix(texts, id_col, tokens_col))
    return attach_by_term(dtm, vocabulary.select("term", "term_index"))


def corpus_size(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """AGG5: one row ``(n_docs, n_terms)``."""
    n = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    v = explode_terms(docs, id_col, tokens_col).agg(F.count_distinct("term").alias("n_terms"))
    return n.crossJoin(one_row(v))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """AGG4 / SET1: distinct terms in sort order with a dense 0-based ``term_index``."""
    terms = explode_terms(docs, id_col, tokens_col).select("term").distinct()
    return with_global_index(terms, ["term"], "term_index")


def document_frequency(dtm: DataFrame) -> DataFrame:
    """AGG8: ``(term, df)`` — number of documents containing the term."""
    return dtm.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf(dtm: DataFrame, n_docs: DataFrame) -> DataFrame:
    """AGG9: ``(term, df, idf)`` with ``idf = ln(N / df)``.

    ``n_docs`` is a one-row DataFrame with column ``n_docs`` (broadcast).
    """
    return (document_frequency(dtm).crossJoin(one_row(n_docs))
            .select("term", "df", F.ln(F.col("n_docs") / F.col("df")).alias("idf")))


# An IDF table (one row per term) up to this size is broadcast whole.
IDF_BROADCAST_ROWS = 500_000


def tf_weight(tf) -> F.Column:
    """AGG10: ``1 + ln(x)``; absent cells are the zeros."""
    return F.lit(1.0) + F.ln(F.col(tf) if isinstance(tf, str) else tf)


def tf_idf(dtm: DataFrame, n_docs: DataFrame, drop_zero: bool = False,
           materialize: bool = True, terms: DataFrame | None = None) -> DataFrame:
    """AGG11: ``(doc_id, term, tf, idf, tfidf)``.

    The DTM feeds both the document frequencies and the join, so by default
    it is written once to the shared checkpoint folder (eager) instead of
    tokenizing the corpus twice; the checkpoint also cuts lineage.

    The join is on ``term``, whose common values are hot keys. An IDF table
    within ``IDF_BROADCAST_ROWS`` (checked with a bounded count) is
    broadcast; beyond that, with the DTM materialised, :func:`split_hot_join`
    sends terms in many documents through a broadcast of the same bound and shuffles
    only the rest (no task gets a hot term). With the DTM the IDF table is
    written too, so the document frequencies are counted once. ``drop_zero`` removes terms present in every document
    (idf = 0). ``terms`` restricts the result to those terms up front (a
    term's IDF needs only its own cells), so a dictionary query never
    weighs the whole matrix.
    """
    if terms is not None:
        dtm = dtm.join(bounded_broadcast(terms.select("term").distinct()), "term", "left_semi")
    if materialize:
        dtm = checkpoint(dtm)
    w = idf(dtm, n_docs)
    if materialize:
        w = checkpoint(w)
    weights = (w.where(F.col("idf") > 0) if drop_zero else w).select("term", "idf")
    if weights.limit(IDF_BROADCAST_ROWS + 1).count() <= IDF_BROADCAST_ROWS:
        # a vocabulary within the checked bound: one map-side join
        out = dtm.join(F.broadcast(weights), "term")
    elif materialize:
        # document frequencies are the key counts of the DTM side: terms in
        # many documents join through a bounded broadcast, the rest shuffle
        counts = w.select("term", F.col("df").alias("n"))
        out = split_hot_join(dtm, weights, "term", counts, dtm.count(), max_hot=IDF_BROADCAST_ROWS)
    else:
        out = dtm.join(weights, "term")
    return out.withColumn("tfidf", tf_weight("tf") * F.col("idf"))


def tfidf_int100(tfidf: DataFrame, value_col: str = "tfidf") -> DataFrame:
    """AGG12 / NUM6: ``int(100 * w)`` truncated, zero cells dropped.

    The weight is rounded to 9 places first so that truncation is stable
    against last-bit differences between engines.
    """
    v = F.round(F.col(value_col) * 100, 9).cast("int")
    return tfidf.withColumn("w100", v).where(F.col("w100") != 0)


def frobenius_norm(cells: DataFrame, value_col: str, group_cols: list[str] | None = None,
                   groups: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
    """AGG22: ``sqrt(sum(v^2))`` over a long matrix, optionally per group.

    ``groups`` is ``(id, *group_cols)`` where the cells do not carry their
    groups: squares are then added up by row before they meet it, so rows, not
    cells, are joined.
    """
    square = F.col(value_col) * F.col(value_col)
    if groups is not None:
        cells = cells.groupBy(id_col).agg(F.sum(square).alias("_square")).join(groups, id_col)
        square = F.col("_square")
    return cells.groupBy(*(group_cols or [])).agg(F.sqrt(F.sum(square)).alias("frobenius"))


def to_ml_vectors(cells: DataFrame, vocab: DataFrame, n_cols: int, id_col: str = "doc_id",
                  key_col: str = "term", value_col: str = "tf") -> DataFrame:
    """Long cells -> one ``pyspark.ml`` SparseVector per row id (the ML border).

    ``vocab`` maps ``key_col`` to a dense ``term_index``. Each document's
    cells are grouped (a group is one document) and converted once.
    """
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import LongType, StructField, StructType

    rows = (attach_by_term(cells, vocab.select(key_col, "term_index"), key_col).groupBy(id_col)
            .agg(F.sort_array(F.collect_list(F.struct("term_index", F.col(value_col).cast("double").alias("v")))).alias("e")))
    schema = StructType([StructField(id_col, LongType()), StructField("features", VectorUDT())])
    rdd = rows.rdd.map(lambda r: (int(r[0]), Vectors.sparse(n_cols, [int(e[0]) for e in r[1]], [e[1] for e in r[1]])))
    return cells.sparkSession.createDataFrame(rdd, schema)
