"""Porter (1980) suffix-stripping stemmer, applied to distinct terms.

This is the algorithm as published by M.F. Porter, "An algorithm for suffix
stripping" (Program, 1980), without later additions (no irregular-form
table, no "logi"/"bli" rules). Words of one or two letters are returned
unchanged.

Spark use: a corpus has far fewer distinct terms than tokens, so only the
distinct vocabulary is stemmed (``mapInPandas``, Arrow batches) and the
``(term, stem)`` map is joined back.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOWELS = frozenset("aeiou")

# The suffix rules of steps 2, 3 and 4 of the 1980 paper.
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
         ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
         ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
         ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
         ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
         "ism", "ate", "iti", "ous", "ive", "ize"]


def _is_cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC){m}[V]."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        c = _is_cons(stem, i)
        if c and prev_vowel:
            m += 1
        prev_vowel = not c
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    n = len(w)
    return (n >= 3 and _is_cons(w, n - 3) and not _is_cons(w, n - 2) and _is_cons(w, n - 1)
            and w[-1] not in "wxy")


def _longest(w: str, rules):
    best = None
    for suf, rep in rules:
        if w.endswith(suf) and (best is None or len(suf) > len(best[0])):
            best = (suf, rep)
    return best


def porter_stem(word: str) -> str:
    if word is None:
        return None
    w = word.lower()
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # step 2, step 3
    for rules in (STEP2, STEP3):
        r = _longest(w, rules)
        if r and _measure(w[: -len(r[0])]) > 0:
            w = w[: -len(r[0])] + r[1]
    # step 4
    r = _longest(w, [(s, "") for s in STEP4])
    if r:
        stem = w[: -len(r[0])]
        if _measure(stem) > 1 and (r[0] != "ion" or stem.endswith(("s", "t"))):
            w = stem
    # step 5a
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


def _stem_batches(batches):
    for pdf in batches:
        pdf["stem"] = [porter_stem(t) for t in pdf["term"]]
        yield pdf


def stem_map(terms: DataFrame, col: str = "term") -> DataFrame:
    """``(term, stem)`` for the distinct values of ``col``.

    Distinct terms are found with partial aggregation first, then spread
    round-robin over the cores (a shuffle of distinct terms only).
    """
    distinct = terms.select(F.col(col).alias("term")).where(F.col("term").isNotNull()).distinct()
    # the stemming is CPU-bound Python: give it at least one task per core
    # (AQE would otherwise coalesce a small distinct set into one task)
    distinct = distinct.repartition(terms.sparkSession.sparkContext.defaultParallelism)
    return distinct.mapInPandas(_stem_batches, "term string, stem string")


def stem_terms(df: DataFrame, col: str, out: str) -> DataFrame:
    """Replace/append a stemmed copy of a string column (distinct values stemmed once)."""
    m = stem_map(df, col).withColumnRenamed("term", "_t").withColumnRenamed("stem", "_s")
    j = df.join(m, df[col] == m["_t"], "left")
    return j.withColumn(out, F.col("_s")).drop("_t", "_s")


#: Stems that a Python worker keeps, at most ``KEPT_STEMS``.
_STEMS: dict[str, str] = {}
KEPT_STEMS = 500_000


def _stem_lists(tokens):
    """Arrow lists of tokens as lists of stems: each distinct token of a batch is stemmed once, null tokens are left out."""
    if tokens.flatten().null_count:
        tokens = pa.array([None if t is None else [x for x in t if x is not None] for t in tokens.to_pylist()], pa.list_(pa.string()))
    coded = tokens.flatten().dictionary_encode()
    if len(_STEMS) > KEPT_STEMS:
        _STEMS.clear()
    stems = []
    for t in coded.dictionary.to_pylist():
        stem = _STEMS.get(t)
        if stem is None:
            stem = _STEMS[t] = porter_stem(t)
        stems.append(stem)
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    ends = pa.array([0, *sizes.cumsum().tolist()], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(stems, pa.string()).take(coded.indices), mask=tokens.is_null())


def stem_token_arrays(df: DataFrame, tokens_col: str = "tokens", id_col: str = "doc_id",
                      max_broadcast_terms: int = 2_000_000) -> DataFrame:
    """TXT9 over token arrays, order kept, one output row per input row.

    Tokens are stemmed where their row is, in Arrow batches: no shuffle, no
    table of terms. The function is marked as not deterministic so that a
    filter on its result does not run it twice. ``id_col`` and
    ``max_broadcast_terms`` are of no effect and kept for callers.
    """
    # imported by the workers, so that what they keep outlasts a batch
    @F.arrow_udf("array<string>")
    def stems(tokens: pa.Array) -> pa.Array:
        from quarry.functions.stemmer import _stem_lists

        return _stem_lists(tokens)

    return df.withColumn(tokens_col, stems.asNondeterministic()(F.col(tokens_col)))
