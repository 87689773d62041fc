"""Token files of patched frame-of-reference blocks.

File layout (little-endian):

    "RPF1" | block bodies | document table | block index | footer
    body:     minimum u32 | width u8 | exceptions u16 | count u16
              | count values of `width` bits, lowest bit first
              | exceptions: positions u16, high parts u32 (what `width` bits don't hold)
    document table: per document doc_id i64, tokens i64 (id null: lowest i64)
    block index:    per block start u64 (byte offset of its body), first token u64
    footer:   documents u64 | blocks u64 | tokens u64 | offset of the document table u64 | "RPF1"

A block subtracts its minimum and packs at the width that a percentile of its values
needs; the few wider values go to the exception list.  Any token range can be read by its
blocks alone.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import frugal, open_filesystem, read_tasks, store, workspace
from .plain_words import slices, worker_encoder

MAGIC = b"RPF1"
BLOCK = 4096
#: Share of a block's values that its packed width holds at least.
PERCENTILE = 98
#: Tokens of one file, about; a document is never divided.
FILE_TOKENS = 4_000_000
NO_ID = -(1 << 63)
#: Widths that are whole bytes: the packed values are plain integers.
_WHOLE = {8: "u1", 16: "<u2", 32: "<u4"}


def pack_block(values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    low = int(values.min())
    rest = (values - np.uint32(low)).astype(np.uint32)
    at = min(len(rest) - 1, int(np.ceil(len(rest) * percentile / 100)) - 1)
    width = int(np.partition(rest, at)[at]).bit_length()
    odd = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    head = struct.pack("<IBHH", low, width, len(odd), len(rest))
    if width in _WHOLE:
        body = rest.astype(_WHOLE[width]).tobytes()
    else:
        bits = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        body = np.packbits(bits.ravel(), bitorder="little").tobytes()
    return head + body + odd.astype("<u2").tobytes() + (rest[odd] >> np.uint32(width)).astype("<u4").tobytes()


def unpack_block(data: bytes, at: int = 0) -> np.ndarray:
    low, width, n_odd, n = struct.unpack_from("<IBHH", data, at)
    at += 9
    size = (n * width + 7) // 8
    if width in _WHOLE:
        values = np.frombuffer(data, _WHOLE[width], n, at).astype("<u4")
    else:
        bits = np.zeros((n, 32), np.uint8)
        bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
        values = np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
    at += size
    if n_odd:
        where = np.frombuffer(data, "<u2", n_odd, at)
        values[where] |= np.frombuffer(data, "<u4", n_odd, at + 2 * n_odd) << np.uint32(width)
    return values + np.uint32(low)


class TokenFile:
    """One file under construction, written as its blocks fill."""

    def __init__(self, uri: str) -> None:
        fs, path = open_filesystem(uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.uri, self.out = uri, fs.open_output_stream(path, compression=None)
        self.out.write(MAGIC)
        self.at, self.tokens = 4, 0
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.docs: list[tuple[int, int]] = []
        self.index: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((NO_ID if doc_id is None else doc_id, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        self.tokens += len(ids)
        if self.n_held >= 16 * BLOCK:
            self._flush(False)

    def _flush(self, all_: bool) -> None:
        values = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        whole = len(values) if all_ else len(values) // BLOCK * BLOCK
        first = self.tokens - len(values)
        for k in range(0, whole, BLOCK):
            body = pack_block(values[k : k + BLOCK])
            self.index.append((self.at, first + k))
            self.out.write(body)
            self.at += len(body)
        self.held, self.n_held = [values[whole:]], len(values) - whole

    def close(self) -> tuple[str, int, int, int]:
        """(uri, documents, tokens, bytes)."""
        self._flush(True)
        table = np.array(self.docs, "<i8").tobytes() + np.array(self.index, "<u8").tobytes()
        self.out.write(table + struct.pack("<QQQQ", len(self.docs), len(self.index), self.tokens, self.at) + MAGIC)
        self.out.close()
        return self.uri, len(self.docs), self.tokens, self.at + len(table) + 36


class TokenReader:
    """Documents and token ranges of one file."""

    def __init__(self, uri: str) -> None:
        fs, path = open_filesystem(uri)
        self.file = fs.open_input_file(path)
        self.file.seek(self.file.size() - 36)
        n_docs, n_blocks, self.tokens, self.table_at, magic = struct.unpack("<QQQQ4s", self.file.read(36))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        self.file.seek(self.table_at)
        docs = np.frombuffer(self.file.read(16 * n_docs), "<i8").reshape(-1, 2)
        self.doc_ids, self.lengths = docs[:, 0], docs[:, 1]
        self.index = np.frombuffer(self.file.read(16 * n_blocks), "<u8").reshape(-1, 2)

    def read(self, start: int, end: int) -> np.ndarray:
        """Tokens start..end, from the blocks that hold them only."""
        if end <= start:
            return np.zeros(0, np.uint32)
        firsts = self.index[:, 1]
        a, b = int(np.searchsorted(firsts, start, "right")) - 1, int(np.searchsorted(firsts, end, "left"))
        begin = int(self.index[a, 0])
        stop = int(self.index[b, 0]) if b < len(self.index) else self.table_at
        self.file.seek(begin)
        data = self.file.read(stop - begin)
        values = np.concatenate([unpack_block(data, int(x) - begin) for x in self.index[a:b, 0]])
        return values[start - int(firsts[a]) : end - int(firsts[a])]

    def documents(self, together: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc_id, first token, ids) in order, reading about `together` tokens at a time."""
        starts = np.concatenate([[0], np.cumsum(self.lengths)])
        k, n = 0, len(self.doc_ids)
        while k < n:
            j = max(k + 1, int(np.searchsorted(starts, starts[k] + together, "right")) - 1)
            ids = self.read(int(starts[k]), int(starts[j]))
            for d in range(k, j):
                yield int(self.doc_ids[d]), int(starts[d]), ids[int(starts[d] - starts[k]) : int(starts[d + 1] - starts[k])]
            k = j


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int, partitions: int) -> DataFrame:
    """Writes docs (doc_id, text, ...) in ascending doc_id order; returns the files' rows
    (partition, number, uri, documents, tokens, bytes), stored below `folder`.

    Files are cut at FILE_TOKENS. Each attempt of a task writes files of its own, and only
    those of the attempt that Spark commits are listed. A null doc_id comes first; equal
    ids are ordered by text; a null text is empty and has the end id only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        end = int(end_id).to_bytes(4, "little")
        file, made = None, []
        for batch in batches:
            for some in slices(batch, "text"):
                ids = encoder.encode([t or "" for t in some.column("text").to_pylist()])
                for doc, x in zip(some.column("doc_id").to_pylist(), ids, strict=True):
                    if file is None:
                        file = TokenFile(f"{folder}/files/{part:06d}-{len(made):06d}-{attempt}.rpf")
                    file.add(doc, np.frombuffer(x + end, "<u4"))
                    if file.tokens >= FILE_TOKENS:
                        made.append(file.close())
                        file = None
        if file is not None:
            made.append(file.close())
        yield pa.RecordBatch.from_pylist([{"partition": part, "number": k, "uri": u, "documents": d, "tokens": t, "bytes": b} for k, (u, d, t, b) in enumerate(made)], pa.schema([("partition", pa.int64()), ("number", pa.int64()), ("uri", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange(partitions, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    return store(rows.mapInArrow(frugal(run), "partition long, number long, uri string, documents long, tokens long, bytes long"), folder, "files-written")


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of all documents; start: tokens in all documents before. ids: little-endian unsigned 32-bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for doc, start, ids in TokenReader(row["uri"]).documents():
                    held.append((None if doc == NO_ID else doc, row["before"] + start, ids.astype("<u4").tobytes()))
                    size += len(ids)
                    if size > 500_000:
                        yield _rows(held)
                        held, size = [], 0
                if held:
                    yield _rows(held)

    def _rows(held: list) -> pa.RecordBatch:
        d, s, i = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s, pa.int64()), pa.array(i, pa.binary())], ["doc_id", "start", "ids"])

    # Tokens before a file: those of the partitions before it (one small row each), and of its partition's files before it.
    total, before = 0, []
    for part, tokens in sorted(map(tuple, files.groupBy("partition").agg(F.sum("tokens")).collect())):
        before.append((part, total))
        total += tokens
    starts = F.broadcast(files.sparkSession.createDataFrame(before, "partition long, earlier long"))
    order = Window.partitionBy("partition").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("inside", F.coalesce(F.sum("tokens").over(order), F.lit(0))).join(starts, "partition").select("uri", (F.col("earlier") + F.col("inside")).alias("before"))
    return placed.repartition(read_tasks(files), "uri").mapInArrow(frugal(run), "doc_id long, start long, ids binary")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 1, partitions: int | None = None) -> DataFrame:
    """docs written to token files in the shared folder and read back: (doc_id, start, ids)."""
    spark: SparkSession = docs.sparkSession
    folder = workspace(spark, "tokens")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_token_files(write_token_files(docs, tokenizer, folder, end_id, n))
