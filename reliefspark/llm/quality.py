"""Quality rules: counts of a text and its divergence from language references.

A reference holds, for one language, the share of each character class and of each of its
commonest words, counted over all documents of that language that pass the base rules.  A
document is compared with the references by Jensen-Shannon distance (base 2, so 0 to 1); it
takes the nearest reference, since a stated language may be wrong.  Short documents have
noisy histograms, so each comparison has a least length below which it says nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import wordhash
from .common import frugal, store, workspace
from .wordhash import mix

_U = np.uint64
COMMON_WORDS = 64
#: Words that a task holds before it passes on their counts.
HELD_WORDS = 500_000
#: Words of a language, at least, for it to have a reference: one or two documents say nothing of a language.
LEAST_WORDS = 1000
#: A language with a reference has one word in so many of all, at least; hence there are no more languages than this.
WORD_SHARE = 5000

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    """Thresholds of the verdict; lengths in words."""

    least_words: int = 50
    repeat_percent: int = 50
    class_distance: float = 0.28
    class_words: int = 50
    word_distance: float = 0.36
    word_words: int = 150


def _class_table() -> np.ndarray:
    """Character class by a code point's first byte; continuation bytes get the class CLASSES, which is dropped."""
    groups = ["aeiou", "bcdfghjklmnpqrstvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r\x0b\x0c", ".,;:?", "!", "'\"()-", SYMBOLS]
    table = np.full(256, len(groups), np.int64)  # other ASCII
    for k, g in enumerate(groups):
        table[[ord(c) for c in g]] = k
    table[0xC2:0xC4] = len(groups) + 1  # Latin-1 letters and marks
    table[0xC4:0xE0] = len(groups) + 2  # further two-byte scripts
    table[0xE0:] = len(groups) + 3
    table[0x80:0xC0] = len(groups) + 4
    return table


_CLASS = _class_table()
CLASSES = int(_CLASS.max())
_LETTER_BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def base_counts(raw: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each document of a block."""
    n = len(off) - 1
    at = off - off[0]
    data = raw[off[0] : off[-1]]
    h, doc, start, end = wordhash.words(raw, off)
    starts = (data & 0xC0) != 0x80

    def per_doc(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[at[1:]] - total[at[:-1]]

    n_words = np.bincount(doc, minlength=n)
    chars = per_doc(starts & ~wordhash._SPACE[data])
    symbols = per_doc(_SYMBOL[data])

    # Lines: from a document's start or behind a line feed to the next one or the document's end.
    feeds = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([at[:-1], feeds + 1]))
    line_doc = np.searchsorted(at, line_start, "right") - 1
    # A line feed at a document's very end starts that document's empty last line, which has no word: drop it.
    line_doc = np.minimum(line_doc, n - 1)
    line_end = np.minimum(np.concatenate([line_start[1:], [len(data)]]), at[line_doc + 1])
    holds = np.zeros(len(line_start), bool)
    holds[np.searchsorted(line_start, start, "right") - 1] = True
    line_start, line_end, line_doc = line_start[holds], line_end[holds], line_doc[holds]
    line_end = line_end - ((line_end > line_start) & (data[np.maximum(line_end - 1, 0)] == 10))
    key = mix(wordhash.span_hashes(data, line_start, line_end) ^ mix(line_doc.astype(_U)))
    _, first = np.unique(key, return_index=True)
    dup = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[first], minlength=n)

    repeated = np.zeros(n, np.int64)
    if len(h) > 2:
        with np.errstate(over="ignore"):
            w = mix(h[:-2] * _U(0x9E3779B97F4A7C15) + mix(h[1:-1] * _U(0xC2B2AE3D27D4EB4F) + mix(h[2:])))
            w = mix(w ^ mix(doc[:-2].astype(_U) + _U(7)))
        inside = doc[:-2] == doc[2:]
        where = np.flatnonzero(inside)
        _, back, count = np.unique(w[where], return_inverse=True, return_counts=True)
        twice = where[count[back] > 1]
        mark = np.zeros(len(h), bool)
        for k in range(3):
            mark[twice + k] = True
        repeated = np.bincount(doc[mark], minlength=n)
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeated}


def base_failed(c: dict[str, np.ndarray], rules: Rules) -> np.ndarray:
    return (c["n_words"] < rules.least_words) | (100 * c["n_repeat_words"] > rules.repeat_percent * c["n_words"])


def histograms(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents x classes counts, word hashes, their documents); words are runs of letters and digits, A-Z folded."""
    n = len(off) - 1
    at = off - off[0]
    data = raw[off[0] : off[-1]]
    doc = np.repeat(np.arange(n), np.diff(at))
    cls = np.bincount(doc * (CLASSES + 1) + _CLASS[data], minlength=n * (CLASSES + 1)).reshape(n, -1)[:, :CLASSES]
    h, wdoc, _, _ = wordhash.words(raw, off, True, _LETTER_BREAK)
    return cls, h, wdoc


def _count(rules: Rules):
    """Partial sums of the references: rows of (lang, kind, item, seen), every word counted; an item can have several."""

    def partial(lang: str, kind: str, item: np.ndarray, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(item), 50_000):
            n = len(item[a : a + 50_000])
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, n), pa.repeat(kind, n), pa.array(item[a : a + n], pa.int64()), pa.array(seen[a : a + n], pa.int64())], ["lang", "kind", "item", "seen"])

    def flush(words: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, parts in words.items():
            u, c = np.unique(np.concatenate(parts), return_counts=True)
            yield from partial(lang, "words", np.zeros(1, np.int64), np.array([c.sum()]))
            yield from partial(lang, "word", u.view(np.int64), c)
        words.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[str, np.ndarray] = {}
        words: dict[str, list[np.ndarray]] = {}
        held = 0
        for batch in batches:
            raw, off = wordhash.column_buffers(batch.column("text"))
            langs = np.array([x or "" for x in batch.column("lang").to_pylist()], object)
            for i, j in wordhash.blocks(raw, off):
                o = off[i : j + 1]
                good = ~base_failed(base_counts(raw, o), rules) & (langs[i:j] != "")
                cls, h, doc = histograms(raw, o)
                for lang in set(langs[i:j][good].tolist()):
                    own = good & (langs[i:j] == lang)
                    classes[lang] = classes.get(lang, 0) + cls[own].sum(0)
                    words.setdefault(lang, []).append(h[own[doc]])
                held += len(h)
                if held > HELD_WORDS:
                    yield from flush(words)
                    held = 0
        yield from flush(words)
        for lang, c in classes.items():
            yield from partial(lang, "class", np.arange(CLASSES), c)

    return run


@dataclass
class References:
    """Per language: class shares, sorted hashes of common words, their shares and the share of all other words."""

    langs: list[str]
    classes: np.ndarray
    words: list[np.ndarray]
    shares: list[np.ndarray]


def references(docs: DataFrame, rules: Rules = Rules()) -> References:
    """References from all rows of docs (text, lang).

    A language has one if its documents that pass the base rules have LEAST_WORDS words and a share of 1 / WORD_SHARE
    of all languages' words, so what comes to the driver is bounded: WORD_SHARE times COMMON_WORDS and the classes.
    Rows of null or empty language or text give nothing; repeated rows count each time; words of equal counts are
    ranked by hash; an empty table gives no reference. Other columns are ignored.
    """
    parts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).mapInArrow(frugal(_count(rules)), "lang string, kind string, item long, seen long")
    sums = store(parts.groupBy("lang", "kind", "item").agg(F.sum("seen").alias("seen")), workspace(docs.sparkSession, "quality"), "sums")
    totals = sums.filter("kind = 'words'")
    least = max(LEAST_WORDS, -(-(totals.agg(F.sum("seen")).first()[0] or 0) // WORD_SHARE))
    langs = totals.filter(F.col("seen") >= least).select("lang")
    # Ranked in parts first, so that no task ranks all words of a language.
    order = [F.desc("seen"), F.col("item")]
    some = sums.filter("kind = 'word'").withColumn("rank", F.row_number().over(Window.partitionBy("lang", F.pmod("item", F.lit(16))).orderBy(*order))).filter(F.col("rank") <= COMMON_WORDS)
    words = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= COMMON_WORDS).drop("rank")
    by: dict[str, dict] = {}
    for lang, kind, item, seen in words.union(sums.filter("kind <> 'word'")).join(langs, "lang").select("lang", "kind", "item", "seen").collect():
        by.setdefault(lang, {"class": {}, "word": {}, "words": {}})[kind][item] = seen
    out = References([], np.zeros((0, CLASSES)), [], [])
    for lang in sorted(by):
        c, w, total = by[lang]["class"], by[lang]["word"], by[lang]["words"].get(0, 0)
        if not c or not total:
            continue
        share = np.array([c.get(k, 0) for k in range(CLASSES)], float)
        h = np.array(list(w), np.int64).view(_U)
        order = np.argsort(h)
        seen = np.array(list(w.values()), float)[order] / total
        out.langs.append(lang)
        out.classes = np.vstack([out.classes, share / share.sum()])
        out.words.append(h[order])
        out.shares.append(np.append(seen, max(0.0, 1 - seen.sum())))
    return out


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p from q (base 2); a row of zeros is at distance 1."""
    total = p.sum(1, keepdims=True)
    p = p / np.maximum(total, 1e-300)
    m = (p + q) / 2

    def part(a):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0).sum(1)

    d = np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))
    return np.where(total[:, 0] > 0, d, 1.0)


def divergence(raw: np.ndarray, off: np.ndarray, ref: References) -> tuple[np.ndarray, np.ndarray]:
    """(least class distance, least word distance) over the references; 0 without references.

    The word distance is 1 from a reference of whose common words a text has none, and from one without any.
    """
    n = len(off) - 1
    if not ref.langs:
        return np.zeros(n), np.zeros(n)
    cls, h, doc = histograms(raw, off)
    by_class = np.stack([distance(cls.astype(float), c) for c in ref.classes]).min(0)
    all_words = np.bincount(doc, minlength=n)
    by_word = np.ones(n)
    for words, share in zip(ref.words, ref.shares, strict=True):
        hist = np.zeros((n, len(words) + 1))
        if len(words):
            k = np.minimum(np.searchsorted(words, h), len(words) - 1)
            ok = words[k] == h
            hist[:, :-1] = np.bincount(doc[ok] * len(words) + k[ok], minlength=n * len(words)).reshape(n, -1)
        hist[:, -1] = all_words - hist[:, :-1].sum(1)
        # All other words are one column: alike in that alone is no likeness.
        by_word = np.minimum(by_word, np.where(hist[:, :-1].any(1), distance(hist, share), 1.0))
    return by_class, by_word


RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, class_distance double, word_distance double, kept boolean"


def judge(docs: DataFrame, ref: References, rules: Rules = Rules()) -> DataFrame:
    """All columns of docs (text, ...) with the counts, both distances and the verdict `kept`, for every row.

    A null or empty text has no words, fails the base rules and is not kept. Texts are read whole, however
    long; repeated rows get the same counts each; an empty table gives no rows. A column of docs with one of
    the result's names is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ref)
    new = [x.split()[0] for x in RESULT.split(", ")]
    docs = docs.drop(*new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = wordhash.column_buffers(batch.column("text"))
            parts = []
            for i, j in wordhash.blocks(raw, off):
                o = off[i : j + 1]
                c = base_counts(raw, o)
                failed = base_failed(c, rules)
                by_class, by_word = divergence(raw, o, shared.value)
                odd = (by_class > rules.class_distance) & (c["n_words"] >= rules.class_words) | (by_word > rules.word_distance) & (c["n_words"] >= rules.word_words)
                parts.append([*c.values(), failed, by_class, by_word, ~failed & ~odd])
            if parts:
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))], [*batch.schema.names, *new])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(frugal(run), f"{schema}, {RESULT}")
