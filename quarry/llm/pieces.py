"""Cutting text into units and pre-tokens for a public tokenizer that drops white space.

A *unit* is a run free of white space, or a special string; a *piece* is a
pre-token in the tokenizer's byte alphabet. The tokenizer's normaliser and
pre-tokeniser never look across white space, so the pieces of a text are the
pieces of its units in turn, and anything worked out per distinct unit holds
wherever that unit occurs.
"""

from __future__ import annotations

import ctypes
import gc
import json
import re
from collections.abc import Callable, Iterable
from itertools import chain, filterfalse
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# White space as Unicode has it. Python's str.split also cuts at \x1c-\x1f, which are not white space there.
SPACE = "\t-\r \x85\xa0  -     　"
EXTRA_CUTS = re.compile("[\x1c-\x1f]")
#: Above this code point a unit is normalised and cut by the library's own parts.
PLAIN = "ɏ"


_HELD: dict = {}


def held(name, make):
    """What a Python worker keeps between tasks, one thing at a time: the next operator's lets the last one's go.

    Workers are used again by later stages, so without this the caches of all
    operators of a job would add up.
    """
    if name not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[name] = make()
        give_back()  # what the making alone took
    return _HELD[name]


def give_back() -> None:
    """Hands to the system what Arrow's and the C library's allocators have free: they keep it otherwise, in every worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def bounded(limit: int):
    """A dict class that starts afresh when it holds ``limit`` entries."""

    class Bounded(dict):
        def put(self, key, value):
            if len(self) >= limit:
                self.clear()
            self[key] = value
            return value

    return Bounded


def byte_alphabet() -> dict[int, str]:
    """Byte -> visible character: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Cutter:
    """Cuts texts as one ``tokenizers`` file does.

    Only files whose text passes through NFC, white space runs to one space,
    lower case, a split that drops white space, and the byte alphabet are
    taken: for others what a unit becomes may depend on its surroundings.
    """

    def __init__(self, path: str, model: bool = True):
        """Without ``model`` the library's part has no vocabulary: it cuts, and takes little memory."""
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = [x["type"] for x in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        split = spec["pre_tokenizer"]["pretokenizers"][0] if cuts else {}
        if (steps, cuts, split.get("invert"), spec["model"]["type"]) != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], True, "BPE"):
            raise ValueError(f"{path}: its pre-tokens may span white space")
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in spec["added_tokens"]):
            raise ValueError(f"{path}: its added tokens look at their surroundings")
        bare = spec | {"added_tokens": [], "model": spec["model"] | {"vocab": {}, "merges": []}, "truncation": None, "padding": None}
        self.tokenizer = Tokenizer.from_file(path) if model else Tokenizer.from_str(json.dumps(bare))
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._unit = re.compile(f"[^{SPACE}]+")
        self._piece = regex.compile(split["pattern"]["Regex"])
        self._bytes = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})
        self._break = byte_alphabet()[ord("\n")]
        self._high = re.compile(f"[^\0-{PLAIN}]")

    def units(self, text: str | None) -> list[str]:
        """The text's units in order; none for null."""
        if not text:
            return []
        if "<|" not in text and not EXTRA_CUTS.search(text):
            return text.split()
        out: list[str] = []
        for part in self._special.split(text):
            out += [part] if part in self.special else self._unit.findall(part)
        return out

    def letters(self, words: list[str]) -> list[str | None]:
        """Of each word free of white space: the one pre-token it is, if it has only letters of low code points, else None."""
        if not words:
            return []
        text = "\n".join(words)
        if self._high.search(text):
            low = [w for w in words if not self._high.search(w)]
            found = dict(zip(low, self.letters(low)))
            return [found.get(w) for w in words]
        # code points this low have no lower case that looks at other words
        text = text.lower()
        lower = text.split("\n")
        shown = lower if text.isascii() else text.encode().decode("latin-1").translate(self._bytes).split(self._break)
        return [p if w.isalpha() else None for w, p in zip(lower, shown)]

    def pieces(self, unit: str) -> list[str]:
        """The pre-tokens of a unit that is no special string."""
        if unit.isascii():
            if unit.isalpha():
                return [unit.lower()]
            if unit[-1] in ".," and unit[:-1].isalpha():
                return [unit[:-1].lower(), unit[-1]]
        elif max(unit) > PLAIN:
            parts = self.tokenizer
            return [p for p, _ in parts.pre_tokenizer.pre_tokenize_str(parts.normalizer.normalize_str(unit))]
        elif unit.lower().isalpha():  # the lower case of U+0130 holds a mark, which is no letter
            return [unit.lower().encode().decode("latin-1").translate(self._bytes)]
        # code points this low are in NFC already and have no context-dependent lower case
        found = self._piece.findall(unit.lower())
        return found if unit.isascii() and unit.isprintable() else [p.encode().decode("latin-1").translate(self._bytes) for p in found]


def bare_model(path: str):
    """The library's tokenizer of a file with the model alone: what it is given is pre-tokens already."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    none = dict.fromkeys(("normalizer", "pre_tokenizer", "post_processor", "decoder", "truncation", "padding"))
    return Tokenizer.from_str(json.dumps(spec | none | {"added_tokens": []}))


def _joined(parts: list[bytes], codes: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The parts that the codes name, end to end, for each run of codes from one of ``ends`` to the next; parts are whole 32-bit numbers."""
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    table = np.frombuffer(b"".join(parts), "<u4")
    long = size[codes]
    to = np.append(0, np.cumsum(long))
    place = np.repeat((np.cumsum(size) - size)[codes] - to[:-1], long)
    place += np.arange(len(place))
    raw, bounds = table[place].tobytes(), (4 * to[ends]).tolist()
    return [raw[a:b] for a, b in zip(bounds, bounds[1:])]


class UnitCache:
    """Encodes texts slice by slice, each distinct unit and pre-token of a slice once, and keeps encodings between slices.

    Encodings are kept in two generations of about ``units`` and ``pieces``
    entries: a full one becomes the old one, what is used again comes back from
    there, and the rest goes when the next one is full.
    """

    def __init__(self, cut: Cutter, units: int, pieces: int):
        self.cut, self._most, self._most_pieces = cut, units, pieces
        self._units: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self._old_units: dict[str, bytes] = {}
        self._old_pieces: dict[str, bytes] = {}

    def encode(self, texts: list[str | None] | pa.Array, encode: Callable[[set[str]], Iterable[tuple[str, bytes]]]) -> list[bytes]:
        """Little-endian 32-bit ids of each whole text, end to end; ``encode`` gives those of distinct pre-tokens."""
        collects = gc.isenabled()
        gc.disable()  # many small objects and no cycles: there is nothing to look for
        try:
            return self._encode(texts, encode)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts, encode) -> list[bytes]:
        special, kept, pieces = self.cut.special, self._units, self._pieces
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        # Arrow cuts where str.split does; texts that need other cuts are cut one by one
        odd = pc.or_(pc.match_substring(column, "<|"), pc.match_substring_regex(column, EXTRA_CUTS.pattern))
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        cuts = [self.cut.units(column[int(i)].as_py()) for i in at]
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", column) if len(at) else column)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # what is asked for is looked up, one by one; no set of all of it is made
        lacking = set(filterfalse(kept.__contains__, chain(distinct, *cuts)))
        lacking.discard("")
        again = list(filter(self._old_units.__contains__, lacking))
        kept.update(zip(again, map(self._old_units.__getitem__, again)))
        lacking.difference_update(again)
        named = [u for u in special if u in lacking]
        lacking.difference_update(named)
        # most units are one pre-token, or one and a full stop or comma
        bare: list[str] = []
        ended: list[str] = []
        for u in lacking:
            (ended if u[-1] in ".," else bare).append(u)
        ends = [u[-1] for u in ended]
        words = self.cut.letters(bare + [u[:-1] for u in ended])
        mixed = [(u, self.cut.pieces(u)) for u, w in zip(chain(bare, ended), words) if w is None]
        pieces[None] = b""  # of the mixed ones, which follow
        wanted = set(filterfalse(pieces.__contains__, chain(words, ends, *[ps for _, ps in mixed])))
        again = list(filter(self._old_pieces.__contains__, wanted))
        pieces.update(zip(again, map(self._old_pieces.__getitem__, again)))
        wanted.difference_update(again)
        pieces.update(encode(wanted))
        get = pieces.__getitem__
        kept.update(zip(bare, map(get, words)))
        kept.update(zip(ended, map(add, map(get, words[len(bare):]), map(get, ends))))
        kept.update((u, b"".join(map(get, ps))) for u, ps in mixed)
        del pieces[None]
        kept.update((u, special[u].to_bytes(4, "little")) for u in named)
        kept[""] = b""
        out = _joined(list(map(kept.__getitem__, distinct)), coded.indices.to_numpy(), split.offsets.to_numpy())
        del kept[""]
        get = kept.__getitem__
        for i, us in zip(at.tolist(), cuts):
            out[i] = b"".join(map(get, us))
        if len(kept) > self._most:
            self._units, self._old_units = {}, kept
        if len(pieces) > self._most_pieces:
            self._pieces, self._old_pieces = {}, pieces
        return out
