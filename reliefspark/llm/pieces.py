"""Encoding texts through a cache of their space-separated pieces.

The splitting patterns of the public tokenizers never let a pre-token run past white space
that follows a non-space character.  A text is therefore cut before each white-space run,
each distinct cut is encoded once by the tokenizer proper and the results are joined.
Single spaces and line feeds are cut by splitting, other white space by a pattern; only
texts with the control characters that tokenizers disagree about are encoded whole.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

_ODD = re.compile(r"[^\S \n]")
#: White space to Python but not to the tokenizers.
_DISPUTED = re.compile(r"[\x1c-\x1f]")
_CUTS = re.compile(r"\s*\S+|\s+")
#: Letters after which a final comma or full stop is a pre-token of its own; none of them changes into
#: a base and a mark when lower-cased.
_PLAIN = frozenset(c for c in map(chr, range(0x41, 0x250)) if c.isalpha() and c != "İ")
#: Final punctuation that is a pre-token of its own behind a letter of Latin-1.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: A space and letters that normalizers leave composed and splitting patterns keep together.
_WORD = re.compile(r" [A-Za-zÀ-ÖØ-öø-ÿ]+")
_LETTERS = frozenset(c for c in map(chr, range(0x41, 0x100)) if _WORD.fullmatch(" " + c))
#: Longer pieces are not kept.
LONGEST_KEPT = 48


def single_spaced(text: str) -> str | None:
    """text with a space before each line feed, if its cuts are then the parts between single spaces."""
    spread = text.replace("\n", " \n")
    plain = text.replace("\n", "").isprintable() or not _ODD.search(text)
    return spread if plain and "  " not in spread and "\n " not in spread and not spread.endswith((" ", "\n")) else None


class PieceCache:
    """encode_many(strings) gives each one's ids as bytes; most: pieces kept at a time."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], most: int = 800_000) -> None:
        self.encode_many, self.most = encode_many, most
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks = dict(zip(",.", encode_many([",", "."]), strict=True))

    def _pieces(self, text: str) -> list[str] | None:
        """Keys of the text's cuts: without its leading space, with its leading line feed, else behind NUL and space."""
        spread = single_spaced(text)
        if spread is not None:
            cut = spread.split(" ")
            cut[0] = "\0 " + cut[0]  # a first piece has no space before it
            return cut
        if _DISPUTED.search(text):
            return None
        return [c[1:] if c[0] == " " and len(c) > 1 and not c[1].isspace() else c if c[0] == "\n" and len(c) > 1 and not c[1].isspace() else "\0 " + c for c in _CUTS.findall(text)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of little-endian unsigned 32-bit integers."""
        cut = [self._pieces(t) for t in texts]
        whole = [k for k, p in enumerate(cut) if p is None]
        found = self.encode_many([texts[k] for k in whole]) if whole else []
        long = self._learn(set().union(*(p for p in cut if p)))
        get = self.known.__getitem__
        out = [b"".join(map(get, p)) if p is not None else b"" for p in cut]
        for k, ids in zip(whole, found, strict=True):
            out[k] = ids
        self._forget(long)
        return out

    def of_keys(self, keys: list[str]) -> list[bytes]:
        """The ids of each of the keys that _pieces gives."""
        long = self._learn(set(keys))
        out = list(map(self.known.__getitem__, keys))
        self._forget(long)
        return out

    def _learn(self, wanted: set[str]) -> list[str]:
        """Makes the keys known; gives those too long to be kept."""
        if len(self.known) > self.most // 2:  # the last half's pieces stay at hand
            self.old, self.known = self.known, {}
        known, old, marks = self.known, self.old, self.marks
        new = wanted.difference(known)
        if old:
            for x in new & old.keys():
                known[x] = old[x]
            new.difference_update(known)
        asked: list[str] = []
        for x in new:
            body = x[:-1] if x[-1:] in marks and x[-2:-1] in _PLAIN else x
            if body not in known and (body == x or body not in new):
                asked.append(body)
        found = self.encode_many([(x if x[:1] == "\n" else " " + x) if x[:2] != "\0 " else x[2:] for x in asked])
        fresh = dict(zip(asked, found, strict=True))
        known.update(fresh)
        for x in new.difference(fresh):
            known[x] = known[x[:-1]] + marks[x[-1]]
        return [x for x in new if len(x) > LONGEST_KEPT]

    def _forget(self, keys: list[str]) -> None:
        for x in keys:
            self.known.pop(x, None)


def library(path: str):
    """The tokenizer of a tokenizers file; special tokens' strings count as ordinary text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def library_encoder(path: str, t=None) -> Callable[[list[str]], list[bytes]]:
    """encode_many of a tokenizers file, or of its tokenizer t where that is at hand."""
    from array import array

    t = library(path) if t is None else t

    def as_bytes(ids: list[int]) -> bytes:
        a = array("I", ids)
        if sys.byteorder != "little":
            a.byteswap()
        return a.tobytes()

    spelled = _word_spelling(t)
    if spelled is None:
        return lambda texts: [as_bytes(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    lead, letters = spelled
    tokenize, is_word = t.model.tokenize, _WORD.fullmatch

    def encode_many(texts: list[str]) -> list[bytes]:
        out = [as_bytes([x.id for x in tokenize(lead + w[1:].translate(letters))]) if is_word(w) else None for w in texts]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, e in zip(rest, t.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False), strict=True):
            out[k] = as_bytes(e.ids)
        return out

    return encode_many


def _word_spelling(t) -> tuple[str, dict[int, str]] | None:
    """What the tokenizer t hands its model for a space and for each of the plain letters behind it; None if that cannot be told.

    A word of such letters behind a space is one pre-token, so that the model alone gives its ids.
    """

    def spelling(text: str) -> str | None:
        got = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text) if t.normalizer is not None else text)
        return got[0][0] if len(got) == 1 else None

    if t.pre_tokenizer is None or any(_LETTERS.intersection(a.content) for a in t.get_added_tokens_decoder().values() if not a.special):
        return None
    letters, behind = {ord(c): spelling(c) for c in sorted(_LETTERS)}, spelling(" a")
    if None in letters.values() or behind is None or not behind.endswith(letters[ord("a")]):
        return None
    lead = behind.removesuffix(letters[ord("a")])
    every = "".join(sorted(_LETTERS))
    for word in (every, every[::-1], *(a + b for a in "aZé" for b in every), *(b + a for a in "aZé" for b in every)):
        if spelling(" " + word) != lead + word.translate(letters) or [x.id for x in t.model.tokenize(lead + word.translate(letters))] != t.encode(" " + word, add_special_tokens=False).ids:
            return None
    return lead, letters


_caches: dict[str, PieceCache] = {}


def worker_cache(key: str, make: Callable[[], Callable[[list[str]], list[bytes]]]) -> PieceCache:
    """This worker's cache for a tokenizer; it outlives tasks."""
    if key not in _caches:
        _caches.clear()
        _caches[key] = PieceCache(make())
    return _caches[key]
