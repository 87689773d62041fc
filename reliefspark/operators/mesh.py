"""Mesh topology over triangles (tid, i0, i1, i2): half-edges, adjacency, boundaries, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..lineage import cut, drop, numbered


def half_edges(triangles: DataFrame) -> DataFrame:
    """(eid, tid, src, dst): edge k of triangle t is eid 3t + k."""
    return triangles.selectExpr("stack(3, 3*tid, tid, i0, i1, 3*tid+1, tid, i1, i2, 3*tid+2, tid, i2, i0) AS (eid, tid, src, dst)")


def edge_lookup(edges: DataFrame) -> DataFrame:
    """(src, dst, eid): of equal half-edges the newest, that is the highest eid."""
    return edges.groupBy("src", "dst").agg(F.max("eid").alias("eid"))


def has_edge(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """The (src, dst) pairs that are half-edges."""
    return pairs.join(edges.select("src", "dst"), ["src", "dst"], "left_semi")


def next_edge(edges: DataFrame) -> DataFrame:
    """next_eid: the next older half-edge with the same ends."""
    return edges.withColumn("next_eid", F.lag("eid").over(Window.partitionBy("src", "dst").orderBy("eid")))


def adjacency(triangles: DataFrame) -> DataFrame:
    """(eid, tid, opposite): the newest reverse of each half-edge, null on a boundary."""
    e = half_edges(triangles)
    back = edge_lookup(e).select(F.col("src").alias("dst"), F.col("dst").alias("src"), F.col("eid").alias("opposite"))
    return e.join(back, ["src", "dst"], "left").select("eid", "tid", "opposite")


def boundary_edges(triangles: DataFrame) -> DataFrame:
    e = half_edges(triangles)
    back = e.select(F.col("src").alias("dst"), F.col("dst").alias("src"))
    return e.join(back, ["src", "dst"], "left_anti")


def boundary_vertices(triangles: DataFrame, both_ends: bool = False) -> DataFrame:
    """(vid) of vertices with an outgoing boundary half-edge; both_ends marks its end too."""
    e = boundary_edges(triangles)
    out = e.select(F.col("src").alias("vid"))
    return (out.union(e.select(F.col("dst").alias("vid"))) if both_ends else out).distinct()


#: Edges that a task joins at a time.
HELD_EDGES = 2_000_000


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node that each reaches) of the edges a - b: hooking to smaller labels and halving of paths."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    p, q = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while len(p):
        low, high = np.minimum(label[p], label[q]), np.maximum(label[p], label[q])
        apart = low != high
        if not apart.any():
            break
        p, q = p[apart], q[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label != label[label]).any():
            label = label[label]
    return nodes, nodes[label]


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of each node of a task's edges (a, b): the smallest node that it reaches by them."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            nodes, root = _roots(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
            for k in range(0, len(nodes), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[k : k + 100_000]), pa.array(root[k : k + 100_000])], ["node", "root"])
            held.clear()

    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        size += batch.num_rows
        if size >= HELD_EDGES:
            yield from flush()
            size = 0
    yield from flush()


def _stars(links: DataFrame) -> DataFrame:
    """(node, component) of the ends of links (a, b), a > b: rounds of large and small stars, each a written table."""
    now = cut(links.distinct())
    last = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == last:
            break
        last, old = state, now
        for large in (True, False):
            e = now.select("a", "b")
            if large:
                e = e.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = e.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            j = e.join(low, "a")
            stars = (j.filter("b > a") if large else j).select(F.col("b").alias("a"), F.col("m").alias("b"))
            if not large:
                stars = stars.union(low.select("a", F.col("m").alias("b")))
            now = cut(stars.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
            drop(old)
            old = now
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def label_components(links: DataFrame) -> DataFrame:
    """(node, component) of the ends of links (a, b): component is the smallest node reached.

    Links are dealt out by ranges of their first end, and each task joins its own at once. Only the local roots of
    nodes that several tasks met go through the star rounds, so that the rounds work on the seams between tasks.
    """
    n = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = links.filter("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).repartitionByRange(n, "a")
    forest = cut(ranged.mapInArrow(_local_forest, "node long, root long"))
    low = forest.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    seams = forest.join(low.filter("low < high").select("node", "low"), "node").filter("root > low").select(F.col("root").alias("a"), F.col("low").alias("b"))
    joined = _stars(seams).select(F.col("node").alias("low"), "component")
    return low.join(joined, "low", "left").select("node", F.coalesce("component", "low").alias("component"))


def components(triangles: DataFrame) -> DataFrame:
    """(tid, component): connected through shared edges, numbered by their lowest triangle.

    Adjacency is taken both ways, so that non-manifold edges give the same answer in any order.
    """
    adj = adjacency(triangles).filter("opposite is not null").select(F.col("tid").alias("a"), F.expr("opposite div 3").alias("b"))
    root = label_components(adj)
    named = triangles.select("tid").join(root, F.col("tid") == F.col("node"), "left").select("tid", F.coalesce("component", "tid").alias("root"))
    named = cut(named)
    return named.join(numbered(named.select("root").distinct(), "root", "component"), "root").select("tid", "component")


def component_sizes(parts: DataFrame) -> DataFrame:
    return parts.groupBy("component").agg(F.count("*").alias("size"))


def principal_component(triangles: DataFrame, parts: DataFrame) -> DataFrame:
    """The triangles of the largest component; of equals the lowest number."""
    best = component_sizes(parts).agg(F.max_by("component", F.struct("size", -F.col("component"))).alias("component"))
    return triangles.join(parts.join(F.broadcast(best), "component").select("tid"), "tid", "left_semi")  # one row


def adjacency_indices(triangles: DataFrame) -> DataFrame:
    """(tid, i0, o0, i1, o1, i2, o2): corners interleaved with the vertex across each edge, the corner itself on a boundary."""
    e = adjacency(triangles)
    corner = triangles.select(F.col("tid").alias("ot"), F.array("i0", "i1", "i2").alias("c"))
    across = e.join(corner, F.expr("opposite div 3") == F.col("ot"), "left").select("tid", (F.col("eid") % 3).alias("k"), F.expr("c[cast((opposite + 2) % 3 as int)]").alias("o"))
    wide = across.groupBy("tid").agg(*[F.max(F.when(F.col("k") == k, F.col("o"))).alias(f"o{k}") for k in range(3)])
    return triangles.join(wide, "tid").select("tid", "i0", F.coalesce("o0", "i0").alias("o0"), "i1", F.coalesce("o1", "i1").alias("o1"), "i2", F.coalesce("o2", "i2").alias("o2"))


def shadow_indices(vertices: DataFrame, triangles: DataFrame, *attributes: str) -> DataFrame:
    """Triangles over the first vertices of equal leading attributes (x, y, z by default)."""
    from . import remap

    return remap.apply(triangles, remap.dedup(vertices, *attributes))
