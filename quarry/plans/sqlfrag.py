"""SQL fragments for the DuckDB oracles (independent of the Spark code)."""

from __future__ import annotations

from quarry.plans import fixtures as FX


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TOK1 = r"regexp_extract_all(text, '([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+)', 1)"
TOK2 = r"regexp_extract_all(lower(text), '([\p{L}\p{N}_]+)', 1)"
DOCS = "(select *, cast(1900 + doc_id % 100 as integer) as year from documents)"
DOC_TOKENS = f"(select doc_id, source, lang, cast(1900 + doc_id % 100 as integer) as year, {TOK2} as tokens from documents)"

VALENCE = ("(select term, arg_max(valence, line_no) as valence from (values "
           + ", ".join(f"({q(t)}, {v}, {i})" for i, (t, v) in enumerate(FX.VALENCE))
           + ") as v(term, valence, line_no) group by term)")
CATEGORIES = ("(select * from (values " + ", ".join(f"({q(t)}, {p})" for t, p in FX.CATEGORIES)
              + ") as c(term, polarity))")
STOPWORDS = "(select * from (values " + ", ".join(f"({q(w)})" for w in FX.STOPWORDS) + ") as s(term))"
STOPWORD_LIST = "[" + ", ".join(q(w) for w in sorted(set(FX.STOPWORDS))) + "]"
CATEGORY_DICTIONARY = ("(select distinct lower(regexp_replace(raw, '[#0-9]+$', '')) as term from (values "
                       + ", ".join(f"({q(w)})" for w in FX.CATEGORY_DICTIONARY) + ") as d(raw))")

# Long document-term matrix over TXT2 tokens and its TF-IDF.
DTM = f"(select doc_id, term, count(*) as tf from (select doc_id, unnest(tokens) as term from {DOC_TOKENS}) group by doc_id, term)"
N_DOCS = "(select count(*) as n_docs from documents)"
DF = f"(select term, count(*) as df from {DTM} group by term)"
IDF = f"(select term, df, ln(n_docs / df) as idf from {DF}, {N_DOCS})"
TFIDF = f"(select m.doc_id, m.term, m.tf, i.idf, (1 + ln(m.tf)) * i.idf as tfidf from {DTM} m join {IDF} i using (term))"
