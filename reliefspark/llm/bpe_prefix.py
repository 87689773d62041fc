"""Byte-level BPE by dynamic programming over prefixes.

For each byte prefix of a pre-token the table holds the one valid last token: the token t
ending there whose predecessor - the last token of the prefix before t - can stand left of
t, that is, whose bytes with t's encode to exactly that pair.  A sequence is the BPE
encoding of its bytes if and only if all adjacent pairs are, so each prefix has exactly one
such token, and the encoding is read off backwards.  Appending bytes extends the table; an
edit keeps the table up to it and stops as soon as the old table is reached again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal
from .pieces import PieceCache, worker_cache


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Ranks, the matcher of tokens and the memory of which tokens may be neighbours."""

    #: Neighbour pairs remembered at a time.
    MOST_PAIRS = 1_000_000

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import ahocorasick

        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.tokens = {i: t for t, i in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.spine: dict[int, tuple] = {}
        self.matcher = ahocorasick.Automaton()
        for t, i in ranks.items():
            if self.merge(t) == [i]:  # a token that its own bytes don't give never occurs
                self.matcher.add_word(t.decode("latin-1"), (len(t), i))
        self.matcher.make_automaton()

    def merge(self, data: bytes, edges: list | None = None) -> list[int]:
        """BPE by its definition: merge the neighbours of lowest rank, the leftmost of equals, while any can be.

        edges: gets (first part, last part) at the start and after each merge.
        """
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        while True:
            if edges is not None:
                edges.append((ranks[parts[0]], ranks[parts[-1]]))
            best, at = None, 0
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return [ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def spines(self, token: int) -> tuple[list[tuple[int, bytes]], list[tuple[int, bytes]], bool]:
        """What stands at the token's left and at its right edge while it forms, each with its rank
        (0 for the single bytes), and whether all these ranks rise, so that a rank tells the time."""
        known = self.spine.get(token)
        if known is None:
            edges: list[tuple[int, int]] = []
            self.merge(self.tokens[token], edges)
            sides = []
            for side in zip(*edges, strict=True):
                own = list(dict.fromkeys(side))
                sides.append([(-1 if k == 0 else i, self.tokens[i]) for k, i in enumerate(own)])
            rising = all(a[0] < b[0] for s in sides for a, b in zip(s, s[1:], strict=False))
            known = self.spine[token] = (sides[0], sides[1], rising)
        return known

    def neighbours(self, a: int, b: int) -> bool:
        """Whether the bytes of tokens a and b together encode to just these two.

        Both tokens form as if alone unless, at some time, the parts on either side of the
        border merge; that takes a merge of lower rank than the next one of either part (of
        equal rank: the left part's own merge comes first, the right part's comes last).
        """
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > self.MOST_PAIRS:
                self.pairs.clear()
            (_, left, rises), (right, _, rises_too) = self.spines(a), self.spines(b)
            if rises and rises_too:
                known, i, j, ranks = True, 0, 0, self.ranks
                while True:
                    own = left[i + 1][0] if i + 1 < len(left) else 1 << 60
                    other = right[j + 1][0] if j + 1 < len(right) else 1 << 60
                    across = ranks.get(left[i][1] + right[j][1])
                    if across is not None and across < own and across <= other:
                        known = False
                        break
                    if own == other == 1 << 60:
                        break
                    if own <= other:
                        i += 1
                    else:
                        j += 1
            else:
                known = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
            self.pairs[a, b] = known
        return known


class PrefixTable:
    """The last tokens of all prefixes of one pre-token's bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", [(0, -1)]  # (length, id) by prefix length
        self.append(data)

    def _fill(self, data: bytes, begin: int, stop_at=None) -> int:
        """Extend self.last from prefix length `begin` on; stop_at(end) may end it early. Returns the end."""
        v, last = self.vocabulary, self.last
        from_ = max(0, begin - v.longest)  # tokens over `begin` start behind this
        for end, (length, i) in v.matcher.iter(data.decode("latin-1"), from_):
            end += 1
            if len(last) > end:
                continue
            before = last[end - length][1]
            if before < 0 or v.neighbours(before, i):
                last.append((length, i))
                if stop_at is not None and stop_at(end):
                    return end
        return len(data)

    def append(self, data: bytes) -> None:
        begin = len(self.data)
        self.data += data
        self._fill(self.data, begin)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes start..end by new; returns how many prefixes were computed anew.

        Behind the edit, once the table has agreed with the old one over the longest
        token's length, all further entries agree, since each depends on no more than that.
        """
        old, shift, tail = self.last, len(new) - (end - start), end
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        need, same = self.vocabulary.longest, 0
        seen = start + len(new)

        def again(done: int) -> bool:
            nonlocal same, seen
            while seen < done:
                seen += 1
                length, i = self.last[seen]
                agrees = seen - length >= start + len(new) and seen - shift > tail and old[seen - shift] == (length, i)
                same = same + 1 if agrees else 0
            return same >= need

        done = self._fill(self.data, start, again)
        self.last += old[done - shift + 1 :] if done < len(self.data) else []
        return done - start

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            length, i = self.last[at]
            out.append(i)
            at -= length
        return out[::-1]


def encode_bytes(v: Vocabulary, data: bytes) -> list[int]:
    """PrefixTable(v, data).ids() without keeping the table."""
    if (whole := v.ranks.get(data)) is not None and len(data) == 1:
        return [whole]
    last: list[tuple[int, int]] = [(0, -1)]
    pairs, neighbours = v.pairs, v.neighbours
    for end, (length, i) in v.matcher.iter(data.decode("latin-1")):
        end += 1
        if len(last) > end:
            continue
        before = last[end - length][1]
        if before < 0 or (pairs[before, i] if (before, i) in pairs else neighbours(before, i)):
            last.append((length, i))
    out, at = [], len(data)
    while at:
        length, i = last[at]
        out.append(i)
        at -= length
    return out[::-1]


def encoder(path: str, pattern: str):
    """encode_many for PieceCache, with the vocabulary at hand for decoding."""
    import regex

    v, find = Vocabulary(read_ranks(path)), regex.compile(pattern).findall

    def encode_many(texts: list[str]) -> list[bytes]:
        out = []
        for t in texts:
            ids: list[int] = []
            for part in find(t):
                ids += encode_bytes(v, part.encode("utf-8"))
            out.append(np.array(ids, "<u4").tobytes())
        return out

    encode_many.vocabulary = v
    return encode_many


def _cache(path: str, pattern: str) -> PieceCache:
    return worker_cache(f"bpe:{path}", lambda: encoder(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """docs (doc_id, text, ...) with `ids`, the tokens as little-endian unsigned 32-bit integers; the text goes.

    A null or empty text has no tokens.  Every input row gives one row; columns other than
    doc_id and text are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                ids = cache.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(frugal(run), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """encoded (doc_id, ids) with `data`, the bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _cache(path, pattern).encode_many.vocabulary.tokens.__getitem__
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                data = [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(data, pa.binary())], ["doc_id", "ids", "data"])

    return encoded.mapInArrow(frugal(run), "doc_id long, ids binary, data binary")


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))
