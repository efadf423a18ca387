"""The pipeline's stages on the smallest tables."""

import hashlib

from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm import classifier, jaccard, mixing
from quarry.llm.frames import read
from quarry.llm.q_tokens import tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "n-gram Jaccard join", "mixing to target weights", "BPE encoding and decoding"]
    good = corpus_pipeline.STAGES[0][1](spark, docs, SF).cache()
    model = classifier.train(docs, read(spark, SF, "labels"))
    want = {r["doc_id"] for r in classifier.score(docs, model).where("score >= 0.3").collect()}
    assert {r["doc_id"] for r in good.collect()} == want and good.columns == docs.columns
    unlike = corpus_pipeline.STAGES[1][1](spark, good, SF).cache()
    classes = {r["class_id"] for r in jaccard.similar_classes(good).collect()}
    assert sorted(r["doc_id"] for r in unlike.collect()) == sorted(classes) and unlike.columns == docs.columns
    mixed = corpus_pipeline.STAGES[2][1](spark, unlike, SF).cache()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(unlike.withColumn("n", mixing.word_count("text")), "n").collect()}
    got = [r["doc_id"] for r in mixed.collect()]
    assert {d: got.count(d) for d in copies} == copies and mixed.columns == docs.columns
    last = corpus_pipeline.STAGES[3][1](spark, mixed, SF).collect()
    library = Tokenizer.from_file(tokenizer_path())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(r["doc_id"] for r in last) == sorted(got)
    for r in last:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r["n_tokens"] == len(ids)


def test_run_and_registration(spark):
    queries = entry.queries()
    assert {n.split("_")[0] for n in queries if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    rows = queries["pipeline"](spark, SF).count()
    assert 0 < rows <= 2 * read(spark, SF, "documents").count()


def test_stages_on_awkward_and_no_rows(spark, awkward, no_documents):
    for docs in (awkward, no_documents):
        for _, stage in corpus_pipeline.STAGES[:3]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            out.count()
        assert corpus_pipeline.STAGES[3][1](spark, docs, SF).count() == docs.count()
