"""Encoding whole columns of texts: plain words in bulk, all else through the cache of pieces.

Texts with single spaces and line feeds are split, told apart and joined again as Arrow columns.
A plain word (letters of Latin-1, punctuation behind them) is a pre-token of letters and one of marks,
so that the merges alone give its ids.  A group's distinct words go through the merges in one call: each
symbol that the model sees for a letter is one ASCII code, each merged token a string of codes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import give_back
from .pieces import _LETTERS, _MARKS, PieceCache, _word_spelling, library, library_encoder, single_spaced

#: Bytes of text encoded at a time, about.
GROUP_BYTES = 4 << 20
#: Longer words are left to the cache of pieces.
LONGEST = 250
_SPACE, _LINE, _BARE = 0, 1, 2
_IS_MARK = np.zeros(256, bool)
_IS_MARK[[ord(c) for c in _MARKS]] = True
#: Bytes of plain letters in UTF-8: all but the two signs among them, which are told apart by two bytes.
_IS_PLAIN = np.zeros(256, bool)
_IS_PLAIN[[b for c in _LETTERS for b in c.encode()]] = True
_END = 10


class Merges:
    """Ids of plain words by the merges of a tokenizers file; of() gives None for a file of another kind."""

    def __init__(self, core, code: np.ndarray, last: np.ndarray, lead: bytes, line: bytes, ids: np.ndarray) -> None:
        self.core, self.code, self.last, self.lead, self.line, self.ids = core, code, last, np.frombuffer(lead, np.uint8), line, ids

    @classmethod
    def of(cls, path: str, t) -> Merges | None:
        """Of a tokenizers file and its tokenizer t."""
        try:
            from tiktoken._tiktoken import CoreBPE
        except ImportError:
            return None
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        spelled, suffix, vocab = _word_spelling(t), model.get("end_of_word_suffix") or "", model["vocab"]
        if spelled is None or model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")):
            return None
        lead, letters = spelled
        symbol: dict[int, str] = {}  # of each byte of a letter
        for c, spelling in letters.items():
            own = chr(c).encode()
            if len(spelling) != len(own) or any(symbol.setdefault(b, s) != s for b, s in zip(own, spelling, strict=True)):
                return None
        free = iter([k for k in range(1, 128) if k != _END])
        inner: dict[str, int] = {}
        for s in [*symbol.values(), *lead]:
            if s not in inner:
                inner[s] = next(free, 0)
        final = inner if not suffix else {s: next(free, 0) for s in dict.fromkeys(symbol.values())}
        if not all((*inner.values(), *final.values())):
            return None
        ids, ranks, sides = {}, {b"\0": 0, b"\n": _END}, {}
        for table, end in ((inner, ""), (final, suffix)):
            for s, k in table.items():
                if s + end not in vocab:
                    return None
                ids[k], ranks[bytes([k])] = vocab[s + end], k

        def coded(token: str) -> bytes | None:
            body = token.removesuffix(suffix) if suffix else token
            tail = final if len(body) < len(token) else inner
            got = [*map(inner.get, body[:-1]), tail.get(body[-1:])]
            return None if None in got else bytes(got)

        merges = model["merges"]
        made: set[str] = set()
        for k, m in enumerate(merges, 128):
            a, b = m.split(" ") if isinstance(m, str) else m
            made.add(a + b)
            x, y = coded(a), coded(b)
            if x and y:
                ids[k], ranks[x + y], sides[x, y] = vocab[a + b], k, k
        if len(made) < len(merges) or not _sound(sides):
            return None
        del model, vocab, merges, made, sides
        table = np.zeros(max(ids) + 1, np.uint32)
        table[list(ids)] = list(ids.values())
        code, last = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
        for b, s in symbol.items():
            code[b], last[b] = inner[s], final[s]
        bare, behind = (np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in ("a", "\na"))
        # The special token never occurs; without one, the core looks for the empty string at every letter.
        out = cls(CoreBPE(ranks, {"\0\0": 1 << 30}, r"[^\n]+|\n"), code, last, bytes(inner[s] for s in lead), behind.removesuffix(bare), table)
        if not behind.endswith(bare):
            return None
        every = "".join(sorted(_LETTERS))
        tried = [a + b + c for a in "aZé" for b in every for c in ("", "aß", "ÉX")] + [every, every[::-1], "Internationalisation", "straßenbahn"]
        for kind, before in ((_SPACE, " "), (_LINE, "\n"), (_BARE, "")):
            want = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch_fast([before + w for w in tried], add_special_tokens=False)]
            if [(out.line if kind == _LINE else b"") + x for x in out.words(*_bytes_of(pa.array(tried, pa.string())), np.full(len(tried), kind)).to_pylist()] != want:
                return None
        alone = lambda x: t.encode(x, add_special_tokens=False).ids
        if any(alone(w + m) != alone(w) + alone(m) for w in ("a", "É") for m in (*_MARKS, "***", ".\"", "',")):
            return None
        return out

    def words(self, data: np.ndarray, lengths: np.ndarray, kinds: np.ndarray) -> pa.Array:
        """Ids of the words whose bytes stand in data one behind the other, without those of a line feed before them."""
        n, lead = len(lengths), len(self.lead) * (kinds == _SPACE)
        if not n:
            return pa.array([], pa.binary())
        stops = np.cumsum(lengths + lead + 1)  # behind each word's end mark
        out = np.empty(int(stops[-1]), np.uint8)
        starts = stops - 1 - lengths
        own = np.ones(len(out), bool)
        own[stops - 1] = False
        for k in range(len(self.lead)):
            at = (starts - len(self.lead) + k)[lead > 0]
            own[at], out[at] = False, self.lead[k]
        out[own] = self.code[data]
        out[stops - 1] = _END
        out[stops - 2] = self.last[data[np.cumsum(lengths) - 1]]
        got = np.frombuffer(self.core.encode_to_tiktoken_buffer(out.tobytes().decode("ascii"), set()), np.uint32)
        ends = got == _END
        offsets = np.zeros(n + 1, np.int32)
        offsets[1:] = 4 * (np.flatnonzero(ends) - np.arange(n))
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(self.ids[got[~ends]].astype("<u4"))])


def _sound(sides: dict[tuple[bytes, bytes], int]) -> bool:
    """Whether each merged token, alone, is merged from the two that its merge names.

    Then no other two tokens that spell it ever stand side by side before its turn, in any word: the merges between
    its two ends are those of the token alone.  So looking up what two neighbours spell is looking up their merge.
    """
    for (x, y), rank in sides.items():
        parts = [bytes([c]) for c in x + y]
        while len(parts) > 2:
            found = [sides.get(p, rank) for p in zip(parts, parts[1:], strict=False)]
            least = min(found)
            if least >= rank:
                return False
            k = found.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        if parts != [x, y]:
            return False
    return True


def _bytes_of(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of a string array without nulls."""
    offsets = np.frombuffer(a.buffers()[1], np.int32, len(a) + 1, 4 * a.offset).astype(np.int64) if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, np.diff(offsets)


class ColumnEncoder:
    """encode(texts) gives each one's ids, as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        t = library(path)
        self.cache, self.merges = PieceCache(library_encoder(path, t)), Merges.of(path, t)
        give_back()

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        held: list[tuple[int, str]] = []
        rest, size = [], 0
        for k, text in enumerate(texts):
            spread = single_spaced(text) if self.merges is not None and len(text) <= GROUP_BYTES else None
            if spread is None:
                rest.append(k)
                continue
            held.append((k, spread))
            size += len(spread)
            if size > GROUP_BYTES:
                self._encode_spread(held, out)
                held, size = [], 0
        if held:
            self._encode_spread(held, out)
        for k, ids in zip(rest, self.cache.encode([texts[k] for k in rest]), strict=True):
            out[k] = ids
        return out

    def _encode_spread(self, held: list[tuple[int, str]], out: list[bytes]) -> None:
        """Puts the ids of texts whose pieces are their parts between single spaces, given with their place in out, there."""
        parts = pc.split_pattern(pa.array([t for _, t in held], pa.string()), " ")
        ends, pieces = parts.offsets.to_numpy(), parts.flatten()
        coded, first = pieces.dictionary_encode(), pieces.take(pa.array(ends[:-1])).dictionary_encode()
        at = coded.indices.to_numpy().copy()
        at[ends[:-1]] = first.indices.to_numpy() + len(coded.dictionary)  # a first piece has no space before it
        bare = np.repeat([False, True], [len(coded.dictionary), len(first.dictionary)])
        ids = self._distinct(pa.concat_arrays([coded.dictionary, first.dictionary]), bare).take(pa.array(at))
        starts = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, 4 * ids.offset)[ends].tolist()
        data = memoryview(ids.buffers()[2]) if starts[-1] else memoryview(b"")
        for (k, _), a, b in zip(held, starts, starts[1:], strict=False):
            out[k] = bytes(data[a:b])

    def _distinct(self, pieces: pa.Array, bare: np.ndarray) -> pa.Array:
        """The ids of each piece; bare: of those that no space stands before."""
        data, lengths = _bytes_of(pieces)
        n, stops = len(lengths), np.cumsum(lengths)
        starts = stops - lengths
        line = np.zeros(n, bool)
        line[lengths > 0] = data[starts[lengths > 0]] == _END
        # The last byte of each that is no mark ends its letters.
        solid = np.zeros(len(data) + 1, np.int32)
        np.maximum.accumulate(np.where(_IS_MARK[data], np.int32(0), np.arange(1, len(data) + 1, dtype=np.int32)), out=solid[1:])
        body_stop, body_start = np.maximum(solid[stops], starts), starts + line
        odd = ~_IS_PLAIN[data]
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        odds = np.zeros(len(data) + 1, np.int32)
        np.cumsum(odd, out=odds[1:])
        plain = (body_stop > body_start) & (body_stop - body_start <= LONGEST) & (odds[body_stop] == odds[np.minimum(body_start, body_stop)])
        lens, tail_lens = (body_stop - body_start)[plain], (stops - body_stop)[plain]
        edge = np.zeros(len(data) + 1, np.int8)
        for where, step in ((body_start, 1), (body_stop, -1)):
            np.add.at(edge, where[plain], step)
        letters = self.merges.words(data[np.cumsum(edge[:-1], dtype=np.int8) > 0], lens, np.where(line, _LINE, np.where(bare, _BARE, _SPACE))[plain])
        # Marks behind the letters, of which there are few kinds, are pieces of their own without a space.
        edge[:] = 0
        for where, step in ((body_stop, 1), (stops, -1)):
            np.add.at(edge, where[plain], step)
        offsets = np.concatenate([[0], np.cumsum(tail_lens)]).astype(np.int32)
        marks = pa.Array.from_buffers(pa.string(), len(tail_lens), [None, pa.py_buffer(offsets), pa.py_buffer(data[np.cumsum(edge[:-1], dtype=np.int8) > 0])]).dictionary_encode()
        tails = pa.array(self.cache.of_keys(["\0 " + m for m in marks.dictionary.to_pylist()]), pa.binary()).take(marks.indices)
        heads = pa.array([b"", self.merges.line], pa.binary()).take(pa.array(line[plain].astype(np.int8)))
        joined = pc.binary_join_element_wise(heads, letters, tails, pa.scalar(b"", pa.binary()))
        others = ["\0 " + x if b else x for x, b in zip(pieces.filter(pa.array(~plain)).to_pylist(), bare[~plain].tolist(), strict=True)]
        order = np.empty(n, np.int64)
        order[plain], order[~plain] = np.arange(len(lens)), len(lens) + np.arange(len(others))
        return pa.concat_arrays([joined, pa.array(self.cache.of_keys(others), pa.binary())]).take(pa.array(order))


def slices(batch: pa.RecordBatch, column: str, size: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """batch in parts of about `size` bytes of the string column, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right")))
        yield batch.slice(a, b - a)
        a = b


_encoders: dict[str, ColumnEncoder] = {}


def worker_encoder(path: str) -> ColumnEncoder:
    """This worker's encoder for a tokenizers file; it outlives tasks."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = ColumnEncoder(path)
    return _encoders[path]
