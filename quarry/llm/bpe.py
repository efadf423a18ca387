"""BPE encoding by prefix-sharing trie traversal, and decoding.

The encoding of a word's prefix is fixed by its last token: what precedes
that token is the encoding of the shorter prefix. So a prefix needs only its
*last-token state*, and all words that share a prefix share it. The distinct
words go into a trie; a depth-first walk gives every node its state from the
states of its ancestors, and words read their encoding back along the path.
The trie is the words in order: its nodes are the prefixes where one word
leaves the one before it, so no node is ever built.

A token can follow the last token of the shorter prefix only if BPE, run on
the two together, leaves them apart (``Merges.apart``); exactly one suffix of
the prefix passes that test.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quarry.llm.frames import without
from quarry.llm.pieces import Cutter, UnitCache, bounded, byte_alphabet, give_back, held

#: Distinct units and pre-tokens of a generation, and pairs of tokens, that a Python worker keeps.
KEEP, KEEP_PIECES, KEEP_PAIRS = 110_000, 80_000, 120_000
END = "</w>"


class Merges:
    """A tokenizer's tokens and merges, and which pairs of tokens stay apart. Tokens are their ids."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.vocab = vocab
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        if any(c + e not in vocab for c in byte_alphabet().values() for e in ("", END)):
            raise ValueError("a byte without a token of its own")
        self.wide = max(vocab.values()).bit_length()
        self.rank = {vocab[a] << self.wide | vocab[b]: i for i, (a, b) in enumerate(pairs) if a in vocab and b in vocab}
        made: dict[str, tuple[int, str, str]] = {}
        for i, (a, b) in enumerate(pairs):
            made.setdefault(a + b, (i, a, b))
        # the tokens that stand at a token's right / left edge while it is built, with the rank that makes each
        self._right: dict[int, tuple[tuple[int, int], ...]] = {}
        self._left: dict[int, tuple[tuple[int, int], ...]] = {}
        self.known: dict[int, bool] = bounded(KEEP_PAIRS)()  # pairs that have been looked at
        tokens: list[str] = []
        for t, i in vocab.items():
            if t not in made:
                self._right[i] = self._left[i] = ((i, -1),)
                tokens.append(t)
        for t, (rank, a, b) in made.items():  # in the order of the ranks: parts come before the whole
            i, a, b = vocab[t], vocab.get(a), vocab.get(b)
            if a in self._right and b in self._right and self._first_across(a, b) == rank:
                self._right[i] = (*self._right[b], (i, rank))
                self._left[i] = (*self._left[a], (i, rank))
                tokens.append(t)
        self._automaton(tokens)

    def _automaton(self, tokens: list[str]) -> None:
        """Every token's text in one automaton: a node is the longest end of what was read that begins some token.

        A node is ``[next nodes by character, inside, ending, back]``: the tokens that end there, the longest first, with
        their lengths, those for inside a word and those that end a word (listed by their text without the end mark),
        and the node of the next shorter end.
        """
        leaf: dict[str, list] = {}  # shared by the nodes that lead nowhere, most of them
        self.root: list = [{}, (), (), None]
        for t in tokens:
            body = t.removesuffix(END)
            node = self.root
            for c in body:
                found = node[0].get(c)
                if found is None:
                    if node[0] is leaf:
                        node[0] = {}
                    found = node[0][c] = [leaf, (), (), None]
                node = found
            node[1 + t.endswith(END)] = ((self.vocab[t], len(body)),)
        queue = list(self.root[0].values())
        for node in queue:
            node[3] = self.root
        for node in queue:  # by depth
            for k in (1, 2):
                node[k] = node[k] + node[3][k] if node[k] else node[3][k]
            for c, to in node[0].items():
                back = node[3]
                while back is not None and c not in back[0]:
                    back = back[3]
                to[3] = self.root if back is None else back[0][c]
                queue.append(to)

    def _first_across(self, a: int, b: int) -> int | None:
        """Rank of the first merge across the border of ``a`` and ``b`` when BPE runs on both; None if there is none.

        A token at an edge lives from the rank that makes it to the rank that
        builds the next one on top. A merge across needs both edge tokens
        alive at its rank; of equal ranks the leftmost pair goes first, so the
        next step on the left side beats it and it beats the right side's.
        """
        right, left, get, wide = self._right[a], self._left[b], self.rank.get, self.wide
        best = None
        for i, (x, born_x) in enumerate(right):
            ends_x = right[i + 1][1] if i + 1 < len(right) else None
            x <<= wide
            for j, (y, born_y) in enumerate(left):
                r = get(x | y)
                if r is None or r < born_x or r < born_y or ends_x is not None and r >= ends_x:
                    continue
                if j + 1 < len(left) and r > left[j + 1][1]:
                    continue
                if best is None or r < best:
                    best = r
        return best

    def apart(self, a: int, b: int) -> bool:
        """Whether BPE leaves ``a`` and ``b`` as they are, side by side; the answer goes into ``known``."""
        return self.known.put(a << self.wide | b, self._first_across(a, b) is None)


def encode_words(words: Iterable[str], merges: Merges) -> Iterator[tuple[str, list[int]]]:
    """Each distinct non-empty word with its ids, the states of shared prefixes worked out once.

    The sorted words are their trie in depth-first order: from one word to the
    next the walk goes back to the prefix they share and down the new branch.
    The path holds, for each prefix, the automaton's state, the prefix's last
    token and that token's length; a word reads its ids back along the path.
    """
    root, known, apart, wide = merges.root, merges.known, merges.apart, merges.wide
    # the path: nodes[d], last[d], size[d] of the prefix of d characters
    nodes, last, size = [root], [0], [0]
    before = ""
    for word in sorted(words):
        shared, ends = 0, len(word)
        most = min(len(before), ends - 1, len(last) - 1)
        while shared < most and before[shared] == word[shared]:
            shared += 1
        before = word
        del nodes[shared + 1:], last[shared + 1:], size[shared + 1:]
        node, depth = nodes[shared], shared
        for c in word[shared:]:
            depth += 1
            to = node[0].get(c)
            while to is None:
                node = node[3]
                if node is None:
                    to = root
                    break
                to = node[0].get(c)
            node = to
            if depth < ends:
                for t, n in node[1]:
                    if n == depth:
                        break
                    pair = last[depth - n] << wide | t
                    ok = known.get(pair)
                    if ok or ok is None and apart(pair >> wide, t):
                        break
                nodes.append(node)
                last.append(t)
                size.append(n)
        for t, n in node[2]:
            if n == depth:
                break
            pair = last[depth - n] << wide | t
            ok = known.get(pair)
            if ok or ok is None and apart(pair >> wide, t):
                break
        ids, at = [t], depth - n
        while at:
            ids.append(last[at])
            at -= size[at]
        yield word, ids[::-1]


class Encoder:
    """Encodes whole texts by their distinct units, whose encodings are kept between batches; decodes by the table of tokens."""

    def __init__(self, path: str):
        self.cut = Cutter(path, model=False)
        with open(path, encoding="utf-8") as f:
            self.merges = Merges(json.load(f))
        self.words = {i: t for t, i in self.merges.vocab.items()} | {i: t for t, i in self.cut.special.items()}
        self._strings = pa.array([self.words.get(i) for i in range(max(self.words) + 1)], pa.string())
        self._units = UnitCache(self.cut, KEEP, KEEP_PIECES)

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text, end to end."""
        return self._units.encode(texts, lambda words: ((w, array("I", ids).tobytes()) for w, ids in encode_words(words, self.merges)))

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' strings joined by spaces, as the library does for a file without a decoder; ids it has not are left out."""
        return " ".join(filter(None, map(self.words.get, ids)))


    def decode_all(self, ends: np.ndarray, ids: np.ndarray) -> pa.Array:
        """``decode`` of texts whose ids lie end to end, in Arrow: they are ids of the table, as ``encode`` gives them."""
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), self._strings.take(pa.array(ids))), " ")


def encoder(path: str) -> Encoder:
    """The Python worker's encoder for this file."""
    return held(("trie", path), lambda: Encoder(path))


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut so that a slice holds about ``most`` bytes of text, and one row at least."""
    sizes = np.array(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    at = 0
    ends = np.cumsum(sizes)
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def encode_decode(docs: DataFrame, path: str, text: str = "text", decode: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and, unless switched off, ``decoded``, worked out from ``ids``.

    Ids are those of the whole text without begin or end tokens; special
    strings inside a text become their ids, as is the library's default. A
    null or empty text has no ids and decodes to the empty text. Every row
    comes back with all its columns; input columns named ``ids`` or
    ``decoded`` are replaced. Row-local: no shuffle; a worker keeps the
    encodings of two generations of about ``KEEP`` distinct units and ``KEEP_PIECES`` pre-tokens.
    """
    docs = without(docs, *({"ids", "decoded"} - {text}))
    fields = [StructField("ids", ArrayType(IntegerType()))] + [StructField("decoded", StringType())] * decode
    schema = StructType(docs.schema.fields + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for batch in slices(whole, text):
                raw = enc.encode(batch.column(text))
                flat = np.frombuffer(b"".join(raw), "<i4")
                ends = np.cumsum([0, *(len(r) // 4 for r in raw)], dtype=np.int32)
                new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if decode:
                    new.append(enc.decode_all(ends, flat))
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *("ids", "decoded")[: len(new)]])
                del raw, flat, ends, new
                give_back()

    return docs.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> list:
    """Columns ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoded documents."""
    return [F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
            F.sha2(F.col("decoded"), 256).alias("decoded_sha256")]
