"""Bounded-space online best-fit packing of token sequences.

Each task takes its pieces in a random but fixed order and keeps a fixed number of open
bins.  Which amounts of free space are open is one bit set, so the best fit - the least
free space that still holds the piece - is one shift and one lowest-bit operation; when a
new bin is needed and the limit is reached, the fullest bin closes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, store, workspace
from .plain_words import slices, worker_encoder

OPEN_BINS = 4096
#: Pieces that one task packs, about: its last open bins are spread over that many.
GROUP_PIECES = 150_000


class BestFit:
    """Sequence number and offset of each piece put in, at once and for good."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        self.n_open = self.made = 0

    def put(self, length: int) -> tuple[int, int]:
        if not 0 <= length <= self.capacity:
            raise ValueError(f"a piece of {length} does not fit {self.capacity}")
        fits = self.bits >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            stack = self.free[space]
            bin_ = stack.pop()
            self.n_open -= 1
            if not stack:
                self.bits &= ~(1 << space)
        else:
            if self.n_open >= self.open_bins:  # the fullest closes
                least = (self.bits & -self.bits).bit_length() - 1
                self.free[least].pop()
                self.n_open -= 1
                if not self.free[least]:
                    self.bits &= ~(1 << least)
            space, bin_ = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            self.free[left].append(bin_)
            self.bits |= 1 << left
            self.n_open += 1
        return bin_, self.capacity - space


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces behind a possibly shorter first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * (first > 0) + [(s, capacity) for s in range(first, n, capacity)]


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of docs (doc_id, text, ...)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for some in slices(batch, "text"):
                rows = []
                for doc, x in zip(some.column("doc_id").to_pylist(), encoder.encode([t or "" for t in some.column("text").to_pylist()]), strict=True):
                    x += end
                    for k, (s, n) in enumerate(cut(len(x) // 4, capacity)):
                        own = x[4 * s : 4 * (s + n)]
                        rows.append((doc, k, s, n, zlib.crc32(own), own) if with_ids else (doc, k, s, n, zlib.crc32(own)))
                cols = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=False)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(cols)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(frugal(run), "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def pack(pieces: DataFrame, capacity: int, n_pieces: int, open_bins: int = OPEN_BINS) -> DataFrame:
    """pieces (doc_id, piece, length, ...) with sequence_id and offset, by bounded-space best-fit in each task.

    Columns besides these pass through. n_pieces sets the number of tasks. The order
    within a task is fixed by a hash of the piece, so a repeated task packs alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = BestFit(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            at = [bins.put(n) for n in batch.column("length").to_pylist()]
            placed = np.array(at, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base + placed[:, 0]), pa.array(placed[:, 1])], [*batch.schema.names, "sequence_id", "offset"])

    key = F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32")
    groups = max(1, round(n_pieces / GROUP_PIECES))
    dealt = pieces.repartition(groups, key).sortWithinPartitions(key, "doc_id", "piece")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.mapInArrow(frugal(run), f"{schema}, sequence_id long, offset long")


def best_fit_sequences(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of docs (doc_id, text, ...).

    A null or empty text has the end id only. Repeated rows are packed each on its own.
    Sequence ids are unique but not dense. Empty input gives no rows. Other columns are
    ignored.
    """
    at = workspace(docs.sparkSession, "packing")
    pieces = store(tokenized_pieces(docs, tokenizer, capacity, end_id, with_ids), at, "pieces")
    return pack(pieces, capacity, pieces.count())
