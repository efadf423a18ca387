"""Operators 2, 6 and 10 against the tokenizers library and round trips."""

import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import bpe, tokencount, tokenfile
from quarry.llm.q_tokens import tokenizer_path
from quarry.session import scratch_path

PATH = tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_trie_encoding_is_the_librarys(text):
    enc = bpe.encoder(PATH)
    got = np.frombuffer(enc.encode([text])[0], "<u4").tolist()
    assert got == library_ids(text)
    assert enc.decode(got) == LIBRARY.decode(got, skip_special_tokens=False)


def test_trie_encoding_of_odd_words():
    rnd = random.Random(3)
    alphabet = "aaabbbthe ing'sſéßÅÄΣσςİıIK²½Ⅷ①_-!?.\x1c​é　日語한ﬁ 12\n\x85😀🏽"
    words = ["<|endoftext|>", "<|startoftext|>", "<|", "it's", "aaaaaaaaaaaaaaaa", "lololol", "!!!!!!!!!!!!", "----------"]
    texts = ["".join(rnd.choice(alphabet) if rnd.random() < 0.9 else rnd.choice(words) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, "", None]
    enc = bpe.encoder(PATH)
    assert [np.frombuffer(r, "<u4").tolist() for r in enc.encode(texts)] == [library_ids(t) for t in texts]


def test_shared_prefixes_are_worked_out_once():
    merges = bpe.encoder(PATH).merges
    words = ["thing", "things", "thinking", "think", "t"]
    got = dict(bpe.encode_words(words, merges))
    assert set(got) == set(words)
    assert got["things"] == library_ids("things")


def test_whole_table(awkward):
    rows = bpe.encode_decode(awkward, PATH).select("doc_id", "text", "ids", "decoded", "shard").collect()
    assert len(rows) == awkward.count() and {r["shard"] for r in rows} == {"shard"}
    for r in rows:
        assert r["ids"] == library_ids(r["text"])
        assert r["decoded"] == LIBRARY.decode(r["ids"], skip_special_tokens=False)


def test_empty_table(no_documents):
    assert bpe.encode_decode(no_documents, PATH).collect() == []
    assert tokencount.token_counts(no_documents, PATH).collect() == []


def test_other_tokenizer_layouts_are_refused():
    with pytest.raises(ValueError):
        bpe.encoder(tokenizer_path("byte_bpe_50k.json"))


def test_counts(awkward):
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in tokencount.token_counts(awkward, PATH).collect())
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), len(library_ids(r["text"]))) for r in awkward.select("doc_id", "text").collect())
    assert got == want


def test_counts_do_not_depend_on_the_broadcast_part(awkward, monkeypatch):
    real = tokencount.frequent
    for most in (0, 3):
        monkeypatch.setattr(tokencount, "frequent", lambda table, most=most: real(table, most))
        test_counts(awkward)


def test_frequent_holds_its_bound(table):
    words = table([(f"u{i}", 5000 if i < 10 else i % 7 + 1, 1) for i in range(100)], "unit string, n long, pieces long")
    for most in (0, 3, 10, 40, 100):
        assert tokencount.frequent(words, most).count() <= most
    assert tokencount.frequent(words, 100).count() == 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**32 - 1)), max_size=2000))
def test_packing_round_trip(ids):
    assert tokenfile.unpack(tokenfile.pack(np.array(ids, np.uint64))).tolist() == ids


def test_packing_escapes_and_block_edges():
    for n in (0, 1, 255, 256, 257, 5000):
        ids = np.full(n, 7, np.uint64)
        ids[::100] = 2**32 - 1
        assert (tokenfile.unpack(tokenfile.pack(ids)) == ids).all()
    small = tokenfile.pack(np.full(10_000, 7, np.uint64))
    assert len(small) < 10_000 * 0.7  # 4 bits an id and the offsets
    with pytest.raises(ValueError):
        tokenfile.pack(np.array([2**32], np.uint64))
    with pytest.raises(ValueError):
        tokenfile.unpack(b"????")


def test_token_file(spark, awkward):
    to = scratch_path(spark, "tokens-test")
    docs = awkward.where(F.coalesce("doc_id", F.lit(0)) != 8)  # equal ids may come in either order
    tokenfile.write_tokens(docs, to, PATH, 2)
    want, start = [], 0
    for r in sorted(docs.select("doc_id", "text").collect(), key=lambda r: -1 if r["doc_id"] is None else r["doc_id"]):
        ids = library_ids(r["text"]) + [2]
        want.append((r["doc_id"], start, ids))
        start += len(ids)
    got = [(r["doc_id"], r["start"], r["ids"]) for r in tokenfile.read_tokens(spark, to).orderBy("start").collect()]
    assert got == want
    digests = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokenfile.token_digests(spark, to).collect()}
    assert digests == {d: (s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, s, i in want}


def test_token_file_of_no_documents(spark, no_documents):
    to = scratch_path(spark, "tokens-none")
    tokenfile.write_tokens(no_documents, to, PATH, 2)
    assert tokenfile.read_tokens(spark, to).collect() == []


def test_token_file_of_repeated_ids(spark, table):
    """Rows of one id come in one order, whatever the partitions; equal rows stay."""
    rows = [(1, f"text {i}") for i in range(40)] + [(1, "same")] * 30 + [(None, "a"), (None, None), (2, "end")]
    found = []
    for parts in (1, 5):
        to = scratch_path(spark, "tokens-repeated")
        tokenfile.write_tokens(table(rows, "doc_id long, text string", parts=parts).repartition(parts), to, PATH, 2)
        found.append([(r["doc_id"], r["start"], r["ids"]) for r in tokenfile.read_tokens(spark, to).orderBy("start").collect()])
    assert found[0] == found[1] and len(found[0]) == len(rows)
    assert sorted(i for _, _, i in found[0]) == sorted(library_ids(t) + [2] for _, t in rows)
    assert [d for d, _, _ in found[0]] == [None] * 2 + [1] * 70 + [2]


def test_small_generations_do_not_change_ids():
    """Encodings that are dropped are worked out again; what is used again comes back from the old generation."""
    from quarry.llm.pieces import UnitCache

    enc = tokenfile.LibraryIds(PATH)
    enc._units = UnitCache(enc.cut, 4, 3)
    texts = [f"word{i % 7}, other {i % 3} Ünï <|endoftext|> the the" for i in range(40)] + ["", None, "one"]
    for at in range(0, len(texts), 5):
        got = enc.encode(texts[at:at + 5])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library_ids(t) for t in texts[at:at + 5]]
        assert len(enc._units._units) <= 4 and len(enc._units._pieces) <= 3


def test_arrow_texts_are_encoded_as_the_library_does():
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    from quarry.llm.pieces import Cutter
    from quarry.llm.q_tokens import tokenizer_path
    from quarry.llm.tokenfile import LibraryIds

    path = tokenizer_path()
    library = Tokenizer.from_file(path)
    draw = random.Random(5)
    marks = [*"abcAB.,.,$& éñÑßİıĊċΣσς漢😀\x1c\x1f́\n\t-_'0²ªº", "　", "<|endoftext|>", "</w>", "word", "Straße", "..."]
    texts = [None, "", " ", ".", ","] + ["".join(draw.choices(marks, k=draw.randint(1, 40))) for _ in range(3_000)]
    enc = LibraryIds(path)
    for i in range(0, len(texts), 700):
        part = texts[i:i + 700]
        want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in part]
        assert enc.encode(pa.array(part, pa.string())) == enc.encode(part) == want
    cut = Cutter(path, model=False)
    words = ["Word", "Straße", "İ", "Ċ", "a1", "漢", "ª", "a."]
    assert [[w] for w in cut.letters(words) if w] == [cut.pieces(u) for u, w in zip(words, cut.letters(words)) if w]
    assert cut.letters([]) == [] and cut.letters(["a."]) == [None]


HELD_MEMORY = """
import random, sys
import pandas, pyarrow as pa, pyspark.sql
from quarry.llm import bpe, pieces

def own():
    lines = open("/proc/self/smaps_rollup").read().splitlines()
    return next(int(x.split()[1]) for x in lines if x.startswith("Pss_Anon")) / 1024

class Docs:  # as the operator sees a table: its function runs here, over batches of ours
    schema = pyspark.sql.types.StructType()
    columns = []
    def select(self, *names):
        return self
    def mapInArrow(self, fn, schema):
        self.fn = fn
        return self

rnd = random.Random(1)
words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(3, 9))) for _ in range(60000)]
def batches():
    for _ in range(12):
        yield pa.RecordBatch.from_pydict({"text": [" ".join(rnd.choices(words, k=400)) for _ in range(800)]})

pieces.held("before", lambda: [b"%500d" % i for i in range(200_000)])  # 100 MB of another operator
pin = bytes(1000)
run = bpe.encode_decode(Docs(), sys.argv[1]).fn
before = own()
most = rows = 0
for out in run(batches()):
    rows += len(out.column("ids"))
    del out
    most = max(most, own())
assert rows == 9600
print(before, most, own())
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="Linux tells a process's own memory there")
def test_worker_gives_back_memory_that_it_does_not_use():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    said = subprocess.run([sys.executable, "-c", HELD_MEMORY, PATH], cwd=root, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr
    before, most, after = map(float, said.stdout.split())
    assert after - before < 30 and most - before < 80


def test_selectors_do_not_depend_on_the_stretch(monkeypatch):
    draw = np.random.default_rng(3)
    ids = (2.0 ** draw.uniform(0, 32, 5_000)).astype(np.uint32)
    ids[1_000:2_000] = 0
    want = tokenfile.pack(ids)
    for stretch in (tokenfile.BLOCK, 1_000, 100_000):
        monkeypatch.setattr(tokenfile, "STRETCH", stretch)
        assert tokenfile.pack(ids) == want
    assert (tokenfile.unpack(want) == ids).all()


def test_known_units_are_looked_up_without_sets_of_all():
    """A slice of units that are kept already asks the old generation and the pieces for nothing."""
    from quarry.llm.pieces import UnitCache

    class Asked(dict):
        def __iter__(self):
            raise AssertionError("the whole generation is gone through")

        keys = __iter__

    enc = tokenfile.LibraryIds(PATH)
    enc._units = UnitCache(enc.cut, 100, 100)
    texts = ["one two, three. <|endoftext|> four5", None, "", "one ünï"]
    want = [library_ids(t) for t in texts]
    enc._units._old_units, enc._units._old_pieces = Asked(gone=b""), Asked(gone=b"")
    for _ in range(2):
        assert [np.frombuffer(g, "<u4").tolist() for g in enc.encode(texts)] == want
