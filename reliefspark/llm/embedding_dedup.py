"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut in two halves, each with a codebook of its own; the pair of nearest
centroids is a vector's cell in the product grid.  A vector visits the cells in
multi-sequence order, nearest first by a lower bound of its distance to anything in the
cell, and stops where the bound exceeds the distance that the similarity allows: the
target recall of 1 is reached and the rest of the grid cannot hold a link.  Vectors met in
a cell are verified by cosine in double precision.

The bound: what is nearer to centroid c than to x's own centroid o lies at least
(|x-c|^2 - |x-o|^2) / (2 |c-o|) from x, and squared distances of the halves add up.

A label's grid grows with its number of vectors, so that a cell holds about CELL of them: a
vector is sent once for each cell it visits, and fewer, fuller cells cost less than many.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, discard, frugal, join_rows, store, stream_groups, workspace

#: Vectors of a length that its codebooks are fitted on, about.
SAMPLE = 8192
#: Vectors at home in a cell, about; vectors of one block of a fuller cell, visitors included; rows compared at a time.
CELL, BLOCK, ROWS = 4096, 16384, 256
#: Centroids of a half, at most: 2 to this power.
MOST_LEVEL = 8


def fit_codebook(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means, started from points far apart in a fixed order."""
    start = np.linspace(0, len(x) - 1, k).astype(int)
    c = x[start].copy()
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return np.unique(c, axis=0)


def bounds(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, squared lower bound of the distance to each centroid's region) of each row."""
    d2 = np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * x @ c.T, 0)
    own = d2.argmin(1)
    apart = np.sqrt(np.maximum(((c[own][:, None, :] - c[None]) ** 2).sum(2), 1e-30))
    low = np.maximum(d2 - d2[np.arange(len(x)), own][:, None], 0) / (2 * apart)
    low[np.arange(len(x)), own] = 0
    return own, low * low


def multi_sequence(b1: np.ndarray, b2: np.ndarray, most: float) -> Iterator[tuple[int, int]]:
    """Cells (i, j) in increasing b1[i] + b2[j], up to `most`."""
    o1, o2 = np.argsort(b1, kind="stable"), np.argsort(b2, kind="stable")
    s1, s2 = b1[o1].tolist(), b2[o2].tolist()
    heap = [(s1[0] + s2[0], 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > most:
            return
        yield int(o1[i]), int(o2[j])
        if j + 1 < len(s2):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(s1):
            heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))


def _normal(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def _matrix(column: pa.Array, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The lists of these rows, which are of one length."""
    start = np.concatenate([[0], np.cumsum(size)])[rows]
    return column.flatten().to_numpy(zero_copy_only=False)[start[:, None] + np.arange(size[rows[0]])]


def _visits(codebooks, allowed: float, carry: bool):
    """A row for each cell that a vector visits from its own cell upwards, its own among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = codebooks.value
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                vectors = part.column("embedding")
                size, level = part.column("dim").to_numpy(), part.column("level").to_numpy()
                kinds, of = np.unique(np.stack([size, level], 1), axis=0, return_inverse=True)
                for g, (dim, lev) in enumerate(kinds.tolist()):
                    own = np.flatnonzero(of.ravel() == g)
                    raw = _matrix(vectors, own, size)
                    if lev == 0 or dim not in books:
                        at, cell, home = np.arange(len(own)), np.zeros(len(own), np.int64), np.ones(len(own), bool)
                    else:
                        c1, c2 = books[dim][min(lev, len(books[dim])) - 1]
                        x = _normal(raw)
                        own1, b1 = bounds(x[:, : dim // 2], c1)
                        own2, b2 = bounds(x[:, dim // 2 :], c2)
                        mine = own1 * len(c2) + own2
                        # The other way round is met from the cell of the smaller number.
                        met = np.array([(r, k) for r in range(len(x)) for p, q in multi_sequence(b1[r], b2[r], allowed) if (k := p * len(c2) + q) >= mine[r]], np.int64)
                        at, cell = met.T
                        home = cell == mine[at]
                    rows = part.take(pa.array(own[at]))
                    cols, names = [rows.column("label"), rows.column("dim"), pa.array(cell)], ["label", "dim", "cell"]
                    if carry:
                        data, width = np.ascontiguousarray(raw[at]), raw.itemsize * int(dim)
                        vector = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.arange(0, width * len(at) + 1, width, dtype=np.int32)), pa.py_buffer(data)])
                        cols += [rows.column("rep"), rows.column("copies"), pa.array(home), vector]
                        names += ["rep", "copies", "home", "vector"]
                    yield pa.RecordBatch.from_arrays(cols, names)

    return run


def _compare(cosine: float, kind: str):
    """(node, root, links): of each vector with links in this task, the root of its component and its links' copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in stream_groups(batches, ["label", "dim", "cell", "left", "right"]):
            n = group.num_rows
            home = group["home"].to_numpy()
            if n < 2 or not home.any():
                continue
            # Those at home come first, each part by rep: a home vector meets the home ones behind it and all visitors.
            order = np.lexsort((group["rep"].to_numpy(), ~home))
            rep, copies, block = (group[c].to_numpy()[order] for c in ("rep", "copies", "block"))
            left, right = group["left"][0].as_py(), group["right"][0].as_py()
            x = _normal(np.frombuffer(b"".join(group["vector"].to_pylist()), kind).reshape(n, -1)[order])
            label, links = np.arange(n), np.zeros(n, np.int64)
            for a in range(0, int(home.sum()), ROWS):
                b = min(a + ROWS, int(home.sum()))
                ok = x[a:b] @ x[a:].T >= cosine
                ok &= np.arange(a, n)[None, :] > np.arange(a, b)[:, None]
                if left != right:
                    ok &= block[a:b][:, None] != block[a:][None, :]
                some = np.flatnonzero(ok.any(1))
                links[a:b] += ok @ copies[a:]
                links[a:] += copies[a:b] @ ok
                for i in some.tolist():
                    join_rows(label, a + i, a + np.flatnonzero(ok[i]))
            has = np.flatnonzero(links)
            if len(has):
                yield pa.RecordBatch.from_arrays([pa.array(rep[has]), pa.array(rep[label[has]]), pa.array(links[has])], ["node", "root", "links"])

    return run


def _codebooks(reps: DataFrame, groups: DataFrame) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    """Per length of vectors and level from 1, the two halves' centroids, fitted on about SAMPLE vectors of that length.

    Only lengths with a label of several cells have any; each length's books hold less than 2 ** (MOST_LEVEL + 1) vectors.
    """
    books = {}
    for dim, n, level in groups.groupBy("dim").agg(F.sum("vectors"), F.max("level")).filter("max(level) > 0 AND dim > 1").collect():
        # Drawn by a hash, so that no task sends more than its share; the limit is never reached but by ill luck.
        share = min(1 << 30, (SAMPLE << 30) // n)
        drawn = reps.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < share)).select("embedding").limit(2 * SAMPLE).collect()
        x = _normal(np.array([r[0] for r in drawn], np.float64).reshape(-1, dim)) if drawn else np.eye(2, dim)
        books[dim] = [(fit_codebook(x[:, : dim // 2], 1 << k), fit_codebook(x[:, dim // 2 :], 1 << k)) for k in range(1, level + 1)]
    return books


def embedding_components(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vectors (vec_id, embedding, label, ...).

    Rows with equal, non-null labels link at a cosine of at least `cosine`.  A null or empty
    vector, one of zeros, one with null or non-finite components and one with a null label
    links with nothing; vectors of unequal length never link.  Exact copies are one node
    with a count.  Repeated vec_ids keep their rows, a row of null vec_id is its own class.
    Other columns are ignored, an empty table gives no rows.
    """
    spark = vectors.sparkSession
    at = workspace(spark, "embeddings")
    # Single precision, where that is the table's, is sent as such; cosines are computed in double precision.
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{'float' if single else 'double'}>").alias("embedding"), F.col("label").cast("long").alias("label"))
    usable = F.coalesce(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.exists("embedding", lambda v: v != 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))), F.lit(False))
    key = [F.when(usable, F.col("label")).alias("label"), F.when(usable, F.md5(F.to_json(F.struct("embedding")).cast("binary"))).alias("copy")]
    keyed = rows.select("vec_id", *key)
    good = rows.filter(usable & F.col("vec_id").isNotNull()).select("vec_id", "embedding", *key)
    reps = store(good.groupBy("label", "copy").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")).withColumn("dim", F.size("embedding").cast("long")), at, "reps")
    level = F.least(F.lit(MOST_LEVEL), F.greatest(F.lit(0), F.round(F.log2(F.col("vectors") / CELL) / 2))).cast("long")
    groups = store(reps.groupBy("label", "dim").agg(F.count("*").alias("vectors")).withColumn("level", level), at, "groups")
    shared = spark.sparkContext.broadcast(_codebooks(reps, groups))
    allowed = 2 * (1 - cosine) + 1e-9

    placed = reps.join(groups.select("label", "dim", "level"), ["label", "dim"])
    cells = placed.select("label", "dim", "level", "embedding").mapInArrow(frugal(_visits(shared, allowed, False)), "label long, dim long, cell long").groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    cells = store(cells, at, "cells")
    visits = placed.mapInArrow(frugal(_visits(shared, allowed, True)), "label long, dim long, cell long, rep long, copies long, home boolean, vector binary")
    met = visits.join(cells, ["label", "dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.select("label", "dim", "cell", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "rep", "copies", "home", "vector")
    task = ["label", "dim", "cell", "left", "right"]
    found = store(met.repartition(*task).sortWithinPartitions(*task).mapInArrow(frugal(_compare(cosine, "<f4" if single else "<f8")), "node long, root long, links long"), at, "found")
    discard(spark, at, "cells", "groups")
    component = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), at, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = reps.select("label", "copy", "rep", "copies").join(links, F.col("rep") == F.col("node"), "left").drop("node").join(component, F.col("rep") == F.col("node"), "left")
    named = store(named.select("label", "copy", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), at, "named")
    out = keyed.join(named, ["label", "copy"], "left")
    component_id = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), F.when(F.col("vec_id").isNotNull(), component_id).alias("component_id"), (F.col("vec_id") == component_id).alias("kept"))
