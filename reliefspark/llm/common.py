"""Shared plumbing of the training-data operators: the shared folder, tables written on
the way, grouped Arrow streams and distributed connected components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .wordhash import mix

_made: list[tuple[SparkSession, str]] = []
_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor and the driver see: spark.checkpoint.dir; in local mode, where it is unset, one of our own (tests)."""
    global _own_folder
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _own_folder is None:
            _own_folder = tempfile.mkdtemp(prefix="reliefspark-")
        base = _own_folder
    return base if ":" in base.split("/")[0] else f"file://{base}"


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one; it goes when the driver's Python ends."""
    path = f"{shared_folder(spark).rstrip('/')}/reliefspark/{name}-{uuid.uuid4().hex[:12]}"
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _clean() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                delete(spark, path)
        except Exception:  # the session may be gone by now
            return


def store(df: DataFrame, at: str, name: str) -> DataFrame:
    """df written as Parquet below `at` and read again: cuts the lineage and survives lost executors."""
    path = f"{at}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, at: str, *names: str) -> None:
    """Tables of store() that nothing reads any more, and shuffles of finished queries, whose files stay until the driver collects garbage."""
    for name in names:
        delete(spark, f"{at}/{name}")
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Returns this process's freed memory to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, giving memory back when a task ends: a worker outlives its tasks, and the next one needs other sizes."""

    def with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return with_end


def stream_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys (non-null integers) of a sorted partition, one table a group."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        cols = [table[k].to_numpy() for k in keys]
        change = np.zeros(table.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        if last is not None and first != last:
            yield pa.concat_tables(held).combine_chunks()
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), table.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a and held:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(table.slice(a, b - a))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.concat_tables(held).combine_chunks()


class Forest:
    """Union-find over small integers; roots are the smallest members."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.up))], dtype=np.int64)


#: Bits of a sieve, at most (it is broadcast).
SIEVE_BITS = 1 << 27


def _sieve_parts(key: str, bits: int):
    """(chunk, bits) of the keys of a task, and of chunks of several tasks their union."""
    chunk = min(bits, 1 << 18)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits, bool)
        for batch in batches:
            seen[_place(batch.column(key), bits)] = True
        for c in range(bits // chunk):
            own = seen[c * chunk : (c + 1) * chunk]
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()), pa.array([np.packbits(own).tobytes()], pa.binary())], ["chunk", "bits"])

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, b in zip(batch.column("chunk").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                b = np.frombuffer(b, np.uint8)
                found[c] = found[c] | b if c in found else b
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([b.tobytes() for b in found.values()], pa.binary())], ["chunk", "bits"])

    return mark, union


def _place(keys: pa.Array, bits: int) -> np.ndarray:
    return (mix(keys.to_numpy(zero_copy_only=False).view(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def sieve(keys: DataFrame, key: str):
    """A broadcast bit table of the non-null long column `key`, built by the executors: SIEVE_BITS at most, whatever the number of keys."""
    n = keys.count()
    bits = min(SIEVE_BITS, max(1 << 16, 1 << (16 * n).bit_length()))
    mark, union = _sieve_parts(key, bits)
    table = np.zeros(bits // 8, np.uint8)
    step = min(bits, 1 << 18) // 8
    for c, b in keys.select(key).mapInArrow(frugal(mark), "chunk long, bits binary").repartition("chunk").mapInArrow(frugal(union), "chunk long, bits binary").collect():
        table[c * step : (c + 1) * step] = np.frombuffer(b, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(table)


def marked(df: DataFrame, key: str, table, name: str) -> DataFrame:
    """df with the boolean `name`: false only if the row's non-null long `key` is none of the sieve's; true for all its keys and a few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            p = _place(batch.column(key), 8 * len(bits))
            found = (bits[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(bool))], [*batch.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(frugal(run), f"{schema}, `{name}` boolean")


def join_rows(label: np.ndarray, i: int, others: np.ndarray) -> None:
    """Merges the components of i and of others; label: of each member, the smallest of its component."""
    found = np.unique(label[others])
    if len(found) > 1 or len(found) and found[0] != label[i]:
        found = np.append(found, label[i])
        label[np.isin(label, found)] = found.min()


#: Edges that one task joins by itself, at most (16 bytes each); rows of a small table's file, about.
LOCAL_EDGES, FILE_ROWS = 1_000_000, 500_000


def _joined_at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all ends of a task's edges (a, b): hooking to smaller labels and halving of paths."""
    parts = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if not parts:
        return
    p, q = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
    nodes, ends = np.unique(np.concatenate([p, q]), return_inverse=True)
    p, q = ends[: len(p)], ends[len(p) :]
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[p], label[q]), np.maximum(label[p], label[q])
        apart = low != high
        if not apart.any():
            break
        p, q = p[apart], q[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label != label[label]).any():
            label = label[label]
    for k in range(0, len(nodes), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[k : k + 100_000]), pa.array(nodes[label[k : k + 100_000]])], ["node", "component"])


def connected_components(edges: DataFrame, at: str, name: str) -> DataFrame:
    """(node, component) of every end of the edges (a, b); component: its smallest node.

    Up to LOCAL_EDGES distinct edges are joined by one task.  More go through alternating large-star and
    small-star rounds (Kiveris et al., 2014), each a written table, until a round changes nothing: O(log n)
    rounds, never more rows than edges.  Either way gives the same components.
    """

    def stars(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(low, "a")
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    def print_of(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003), F.sum(F.hash("a", "b").cast("long"))).first())

    current = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), at, f"{name}-0")
    seen, turn = print_of(current), 0
    if seen[0] <= LOCAL_EDGES:
        return store(current.coalesce(1).mapInArrow(frugal(_joined_at_once), "node long, component long"), at, f"{name}-joined")
    while True:
        turn += 1
        # A round has no more rows than the one before: few, full files.
        current = store(stars(stars(current, True), False).coalesce(1 + seen[0] // FILE_ROWS), at, f"{name}-{turn}")
        now = print_of(current)
        discard(edges.sparkSession, at, f"{name}-{turn - 1}")
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


#: Bytes of files that one task reads, about, where there are more files than cores.
READ_BYTES = 32 << 20


def read_tasks(files: DataFrame) -> int:
    """Tasks to read files (uri, bytes, ...) by: one a file up to the cluster's cores, then by bytes."""
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return max(1, min(n, max(4 * files.sparkSession.sparkContext.defaultParallelism, -(-size // READ_BYTES))))


def open_filesystem(uri: str) -> tuple:
    """(pyarrow file system, path) of a URI, for executors that read or write their own files."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)

