"""Nearest neighbours in grid blocks with an exactness certificate.

Points fall into cubic blocks, and into those whose margin they lie in; a query meets the points of
its own block.  It is settled when it has k neighbours and the k-th is strictly nearer than the edge
of the block's margin, so that nothing outside can tie with it.  The others go on with blocks twice
as wide, until a margin covers the data.  Ties go to the smaller neighbour id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..lineage import cut

AXES = ("x", "y", "z")

#: Margins to a block's width, queries that look together, rows that one block may hold; beyond that, rounds are joins on cells.
BLOCK, LEAF, MOST_ROWS = 4, 64, 4_000_000


def distance(metric: str, a: list[Column], b: list[Column]) -> Column:
    """Comparable distance: `l2` squared, `l1` the sum of differences."""
    if metric == "l2":
        return sum(((p - q) * (p - q) for p, q in zip(a, b, strict=True)), F.lit(0.0))
    if metric == "l1":
        return sum((F.abs(p - q) for p, q in zip(a, b, strict=True)), F.lit(0.0))
    raise ValueError(metric)


#: A whole turn.
TURN = 6.283185307179586


def within_turn(queries: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """(pid, nbr, d): angles (pid, angle in -pi to pi) less than `radius` apart, the short way round.

    Cells are equal parts of the turn, at least a radius wide and numbered round, so that the first and last are neighbours.
    """
    if radius <= 0:
        raise ValueError("the radius must be positive")
    parts = max(1, int(TURN / radius))
    cell = F.least(F.lit(parts - 1), F.floor((F.col("angle") + TURN / 2) / TURN * parts)).cast("long")
    steps = sorted({k % parts for k in (-1, 0, 1)})
    q = queries.select("pid", "angle", F.explode(F.array(*[F.pmod(cell + k, F.lit(parts)) for k in steps])).alias("cell"))
    p = points.select(F.col("pid").alias("nbr"), F.col("angle").alias("other"), cell.alias("cell"))
    apart = F.abs(F.col("angle") - F.col("other"))
    return q.join(p, "cell").withColumn("d", F.least(apart, F.lit(TURN) - apart)).filter(F.col("d") < radius).select("pid", "nbr", "d")


def within_rotation(queries: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """(pid, nbr, d): quaternions (pid, x, y, z, w) whose squared distance d is below the squared radius: cells in x, y, z, then all four parts."""
    q = _around(_cells(queries.select("pid", *AXES, "w"), radius, ""))
    p = _cells(points.select(F.col("pid").alias("nbr"), *[F.col(a).alias(f"n{a}") for a in (*AXES, "w")]), radius, "n")
    d = distance("l2", [F.col(a) for a in (*AXES, "w")], [F.col(f"n{a}") for a in (*AXES, "w")])
    return q.join(p, ["cx", "cy", "cz"]).withColumn("d", d).filter(F.col("d") < radius * radius).select("pid", "nbr", "d")


def changed(points: DataFrame, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """The points searched after adding some and removing others (pid): searches build their cells anew, so there is no tree to mend."""
    out = points if removed is None else points.join(removed.select("pid"), "pid", "left_anti")
    return out if added is None else out.unionByName(added.select(*out.columns))


def save_cells(points: DataFrame, radius: float, folder: str) -> None:
    """Writes points (pid, x, y, z) with their cells, dealt out by cell: an index for searches within `radius`."""
    cells = _cells(points.select("pid", *AXES), radius, "").withColumn("radius", F.lit(float(radius)))
    cells.repartition("cx", "cy", "cz").sortWithinPartitions("cx", "cy", "cz").write.parquet(folder)


def within_saved(queries: DataFrame, folder: str, radius: float) -> DataFrame:
    """within() against an index of save_cells() of the same radius."""
    p = queries.sparkSession.read.parquet(folder).filter(F.col("radius") == radius).select("cx", "cy", "cz", F.col("pid").alias("nbr"), *[F.col(a).alias(f"n{a}") for a in AXES])
    q = _around(_cells(queries.select("pid", *AXES), radius, ""))
    d = distance("l2", [F.col(a) for a in AXES], [F.col(f"n{a}") for a in AXES])
    return q.join(p, ["cx", "cy", "cz"]).withColumn("d", d).filter(F.col("d") < radius * radius).select("pid", "nbr", "d")


def _cells(df: DataFrame, h: float, prefix: str) -> DataFrame:
    return df.withColumns({f"c{a}": F.floor(F.col(f"{prefix}{a}") / F.lit(h)) for a in AXES})


def _around(df: DataFrame) -> DataFrame:
    steps = F.array(*[F.struct(*[F.lit(v).alias(f"d{a}") for a, v in zip(AXES, (i, j, k), strict=True)]) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    return df.withColumn("d", F.explode(steps)).select(*[c for c in df.columns if c not in ("cx", "cy", "cz")], *[(F.col(f"c{a}") + F.col(f"d.d{a}")).alias(f"c{a}") for a in AXES])


def cell_width(points: DataFrame, k: int, key: str | None = None) -> tuple[float, float]:
    """(width at which a cell holds about k points of a surface, extent): a few scalars come to the driver. key: of its value with the most points."""
    of = points.groupBy(*[key] if key else []).agg(F.count("*").alias("n"), *[f(a).alias(f"{n}{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))])
    r = of.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), *[f(f"{n}{a}").alias(f"{n}{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if not r["n"]:
        return 1.0, 0.0
    sides = sorted((r[f"hi{a}"] - r[f"lo{a}"] for a in AXES), reverse=True)
    extent = max(sides[0], 1e-9)
    return max((extent * max(sides[1], extent * 1e-3) * k / r["n"]) ** 0.5, extent * 1e-6), extent


def _leaves(at: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in groups of at most LEAF near each other, halved at the middle of their longest side."""
    held = [rows]
    while held:
        r = held.pop()
        if len(r) <= LEAF:
            yield r
            continue
        axis = int(np.argmax(np.ptp(at[r], axis=0)))
        r = r[np.argpartition(at[r, axis], len(r) // 2)]
        held += [r[: len(r) // 2], r[len(r) // 2 :]]


def nearest(at: np.ndarray, to: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of `at`, id, squared distance, rank from 1) of the k nearest of `to` (ids) to each row of `at`; equal distances by id.

    A leaf's queries meet the points within r of its box; those with k of them nearer than r are settled, and r doubles
    for the others until all points are met.
    """
    by_x = np.argsort(to[:, 0], kind="stable")
    ids = ids[by_x]
    x, y, z = (np.ascontiguousarray(to[by_x, c]) for c in range(3))
    out = []
    for rows in _leaves(at, np.arange(len(at))) if len(to) else ():
        r = max(float(np.ptp(at[rows], axis=0).max()) / 2, 1e-12)
        while len(rows):
            q = at[rows]
            low, high = q.min(0) - r, q.max(0) + r
            a, b = np.searchsorted(x, [low[0], high[0]])
            inside = np.flatnonzero((y[a:b] >= low[1]) & (y[a:b] <= high[1]) & (z[a:b] >= low[2]) & (z[a:b] <= high[2])) + a
            every = len(inside) == len(x)
            r, reach = 2 * r, (r * (1 - 1e-9)) ** 2
            if not every and len(inside) < k:
                continue
            near, names, n = (x[inside], y[inside], z[inside]), ids[inside], min(k, len(inside))
            most, left = max(1, 2_000_000 // len(inside)), []
            for s in range(0, len(q), most):
                some = rows[s : s + most]
                d = [q[s : s + most, None, c] - near[c] for c in range(3)]
                d2 = d[0] * d[0] + d[1] * d[1] + d[2] * d[2]
                last = np.partition(d2, n - 1, axis=1)[:, n - 1]
                if not every:
                    left.append(some[last >= reach])
                    last[last >= reach] = -1.0
                i, j = np.nonzero(d2 <= last[:, None])
                nbr, d2 = names[j], d2[i, j]
                o = np.lexsort((nbr, d2, i))
                i, nbr, d2 = i[o], nbr[o], d2[o]
                rank = np.arange(len(i)) - np.searchsorted(i, i) + 1
                kept = rank <= k
                out.append((some[i[kept]], nbr[kept], d2[kept], rank[kept]))
            rows = np.concatenate(left) if left else rows[:0]
    if not out:
        return np.zeros(0, int), ids[:0], np.zeros(0), np.zeros(0, int)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _near_in_blocks(left: DataFrame, p: DataFrame, h: float, k: int, own: list[str], final: bool, all_left: bool) -> DataFrame | None:
    """(pid, nbr, d2, rank) of the queries that blocks with margin h settle (all, if final); None if a block would hold too many points."""
    w, cube = BLOCK * h, ["bx", "by", "bz"]
    q = left.dropna(subset=list(AXES)).withColumns({f"b{a}": F.floor(F.col(a) / F.lit(w)) for a in AXES})
    p = p.dropna(subset=[f"n{a}" for a in AXES])
    for a in AXES:
        p = p.withColumn(f"b{a}", F.explode(F.sequence(F.floor((F.col(f"n{a}") - F.lit(h)) / F.lit(w)), F.floor((F.col(f"n{a}") + F.lit(h)) / F.lit(w)))))
    if not all_left:
        p = p.join(q.select(*own, *cube).distinct(), [*own, *cube], "left_semi")
    most = max((d.groupBy(*own, *cube).count().agg(F.max("count")).first()[0] or 0) for d in (q, p))
    if most > MOST_ROWS:
        return None

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        at = np.stack([one[a].to_numpy() for a in AXES], 1) if one.num_rows else np.zeros((0, 3))
        to = np.stack([other[f"n{a}"].to_numpy() for a in AXES], 1) if other.num_rows and one.num_rows else np.zeros((0, 3))
        row, nbr, d2, rank = nearest(at, to, other["nbr"].to_numpy()[: len(to)], k)
        if not final and len(row):
            block = np.array([one[c][0].as_py() for c in cube])
            edge = np.minimum(at - (block * w - h), (block + 1) * w + h - at).min(1) * (1 - 1e-9)
            full = np.zeros(len(at), bool)
            full[row[(rank == k) & (d2 < edge[row] ** 2)]] = True
            kept = full[row]
            row, nbr, d2, rank = row[kept], nbr[kept], d2[kept], rank[kept]
        return pa.table({"pid": one["pid"].to_numpy()[row], "nbr": nbr, "d2": d2, "rank": rank.astype(np.int32)})

    kinds = f"pid {left.schema['pid'].dataType.simpleString()}, nbr {p.schema['nbr'].dataType.simpleString()}, d2 double, rank int"
    return q.select("pid", *AXES, *own, *cube).groupBy(*own, *cube).cogroup(p.groupBy(*own, *cube)).applyInArrow(run, kinds)


def knn(queries: DataFrame, points: DataFrame, k: int = 15, width: float | None = None, key: str | None = None) -> DataFrame:
    """(pid, nbr, d2, rank) of each query (pid, x, y, z) among points (pid, x, y, z), itself included if there.

    key: a column of both, such as a tile, within which neighbours are sought; pids are unique over all keys.
    Fewer than k points give fewer rows. Each round deals queries and points out by blocks; where a block would hold
    too many, it is one equi-join on cells and one window. Only unsettled queries go on, from a written table.
    """
    auto, extent = cell_width(points, k, key)
    h = width or auto
    own = [key] if key else []
    p = points.select(*own, F.col("pid").alias("nbr"), *[F.col(a).alias(f"n{a}") for a in AXES])
    left = queries.select(*own, "pid", *AXES)
    out: DataFrame | None = None
    while True:
        final = h > extent
        done = _near_in_blocks(left, p, h, k, own, final, out is None)
        done = _near_in_cells(left, p, h, k, own, final) if done is None else done
        done = cut(done)
        out = done if out is None else out.unionByName(done)
        if final:
            return out
        left = cut(left.join(done.select("pid").distinct(), "pid", "left_anti"))
        if left.isEmpty():
            return out
        h *= 2


def _near_in_cells(left: DataFrame, p: DataFrame, h: float, k: int, own: list[str], final: bool) -> DataFrame:
    """As _near_in_blocks(), with the points of the 27 cells around a query's: no task holds a cell's points."""
    q = _around(_cells(left, h, ""))
    j = q.join(_cells(p, h, "n"), [*own, "cx", "cy", "cz"]).withColumn("d2", distance("l2", [F.col(a) for a in AXES], [F.col(f"n{a}") for a in AXES]))
    w = Window.partitionBy("pid").orderBy("d2", "nbr")
    top = j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    edge = F.least(*[F.least(F.col(a) - (F.floor(F.col(a) / F.lit(h)) - 1) * F.lit(h), (F.floor(F.col(a) / F.lit(h)) + 2) * F.lit(h) - F.col(a)) for a in AXES])
    last = F.max(F.when(F.col("rank") == k, F.col("d2"))).over(Window.partitionBy("pid"))
    top = top.withColumn("settled", F.lit(True) if final else F.coalesce(last < edge * edge, F.lit(False)))
    return top.filter("settled").select("pid", "nbr", "d2", "rank")


def within(queries: DataFrame, points: DataFrame, radius: float, metric: str = "l2") -> DataFrame:
    """(pid, nbr, d) of all points nearer than the radius; d is the metric's distance, squared for l2."""
    q = _around(_cells(queries.select("pid", *AXES), radius, ""))
    p = _cells(points.select(F.col("pid").alias("nbr"), *[F.col(a).alias(f"n{a}") for a in AXES]), radius, "n")
    d = distance(metric, [F.col(a) for a in AXES], [F.col(f"n{a}") for a in AXES])
    limit = radius * radius if metric == "l2" else radius
    return q.join(p, ["cx", "cy", "cz"]).withColumn("d", d).filter(F.col("d") < limit).select("pid", "nbr", "d")


def stitch(mesh0: DataFrame, mesh1: DataFrame, edge0: DataFrame, edge1: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices (vid, x, y, z) of two meshes moved together along their common side.

    edge0, edge1: (vid) of the candidates. Each one of mesh 1 takes y and z of its nearest in
    mesh 0; one of mesh 0 that was nobody's nearest goes where its nearest of mesh 1 went.
    """

    def as_points(v: DataFrame, e: DataFrame) -> DataFrame:
        return v.join(e, "vid", "left_semi").select(F.col("vid").alias("pid"), *AXES)

    p0, p1 = as_points(mesh0, edge0), as_points(mesh1, edge1)
    to0 = knn(p1, p0, 1).select(F.col("pid").alias("v1"), F.col("nbr").alias("v0"))
    free = p0.join(to0.select(F.col("v0").alias("pid")), "pid", "left_anti")
    via = knn(free, p1, 1).select(F.col("pid").alias("vid"), F.col("nbr").alias("v1")).join(to0, "v1").select("vid", "v0")
    at = mesh0.select(F.col("vid").alias("v0"), *[F.col(a).alias(f"t{a}") for a in AXES])
    moved = via.join(at, "v0")
    out0 = mesh0.join(moved, "vid", "left").select("vid", *[F.coalesce(f"t{a}", a).alias(a) for a in AXES])
    out1 = mesh1.join(to0.withColumnRenamed("v1", "vid").join(at, "v0"), "vid", "left").select("vid", "x", *[F.coalesce(f"t{a}", a).alias(a) for a in "yz"])
    return out0, out1
