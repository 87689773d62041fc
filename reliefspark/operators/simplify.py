"""Grid simplification in plain DataFrame operators, and quadric collapse per block in Arrow groups."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import clean, remap


def extent(vertices: DataFrame) -> DataFrame:
    """scale: the largest side of the bounding box."""
    return vertices.agg(F.greatest(*[F.max(c) - F.min(c) for c in "xyz"]).alias("scale"))


def grid_cells(vertices: DataFrame, n: int) -> DataFrame:
    """(vid, x, y, z, gx, gy, gz): cell numbers on an n-wide grid over the box scaled by its largest side."""
    box = vertices.agg(*[f(c).alias(f"{k}{c}") for c in "xyz" for k, f in (("lo", F.min), ("hi", F.max))])
    j = vertices.join(F.broadcast(box))  # one row
    side = F.greatest(*[F.col(f"hi{c}") - F.col(f"lo{c}") for c in "xyz"])
    s = F.when(side > 0, F.lit(1.0) / side).otherwise(F.lit(0.0))
    return j.select("vid", "x", "y", "z", *[F.floor((F.col(c) - F.col(f"lo{c}")) * s * (n - 1) + F.lit(0.5)).cast("int").alias(f"g{c}") for c in "xyz"])


def voxel_points(vertices: DataFrame, n: int) -> DataFrame:
    """(vid): per cell the point with the least mean squared distance to the cell's points, the lowest id of equals.

    The sum of squared distances to p is a constant plus count * |p - mean|^2, so the nearest to the mean wins.
    """
    g = grid_cells(vertices, n)
    mean = g.groupBy("gx", "gy", "gz").agg(*[F.avg(c).alias(f"m{c}") for c in "xyz"])
    d = sum(((F.col(c) - F.col(f"m{c}")) * (F.col(c) - F.col(f"m{c}")) for c in "xyz"), F.lit(0.0))
    cell = ["gx", "gy", "gz"]
    off = g.join(mean, cell).select(*cell, "vid", F.round(d, 9).alias("off"))
    least = off.groupBy(*cell).agg(F.min("off").alias("least"))
    return off.join(least, cell).filter("off = least").groupBy(*cell).agg(F.min("vid").alias("vid")).select("vid")


def snap_to_grid(vertices: DataFrame, triangles: DataFrame, n: int) -> DataFrame:
    """(i0, i1, i2): triangles between cells, each cell stood for by its lowest vertex; degenerate and equal ones once."""
    g = grid_cells(vertices, n)
    low = g.groupBy("gx", "gy", "gz").agg(F.min("vid").alias("remap"))
    t = clean.skip_degenerate(remap.apply(triangles, g.join(low, ["gx", "gy", "gz"]).select("vid", "remap")))
    # The rotation that puts the smallest index first keeps the orientation.
    lead = F.least("i0", "i1", "i2")
    r = F.when(F.col("i0") == lead, F.array("i0", "i1", "i2")).when(F.col("i1") == lead, F.array("i1", "i2", "i0")).otherwise(F.array("i2", "i0", "i1"))
    return t.select(r.alias("r")).select(*[F.col("r")[k].alias(f"i{k}") for k in range(3)]).distinct()


def fit_grid(vertices: DataFrame, target: int, most: int = 1024) -> int:
    """The widest grid with at most `target` occupied cells: bisection over counts, one number a round."""
    low, high = 1, most + 1
    while high - low > 1:
        mid = (low + high) // 2
        if grid_cells(vertices, mid).select("gx", "gy", "gz").distinct().count() <= target:
            low = mid
        else:
            high = mid
    return low


def collapse(pos: np.ndarray, tri: np.ndarray, target: int, most_error: float) -> tuple[np.ndarray, np.ndarray]:
    """(triangles, remap) by half-edge collapses in order of quadric error; border vertices stay where they are."""
    n = len(pos)
    q = np.zeros((n, 4, 4))
    a, b, c = pos[tri[:, 0]], pos[tri[:, 1]], pos[tri[:, 2]]
    normal = np.cross(b - a, c - a)
    area = np.linalg.norm(normal, axis=1)
    unit = normal / np.maximum(area, 1e-300)[:, None]
    plane = np.concatenate([unit, -(unit * a).sum(1)[:, None]], 1)
    k = plane[:, :, None] * plane[:, None, :] * area[:, None, None]
    for col in range(3):
        np.add.at(q, tri[:, col], k)
    weight = np.zeros(n)
    for col in range(3):
        np.add.at(weight, tri[:, col], area)
    edges = {}
    for t in tri.tolist():
        for i in range(3):
            e = (t[i], t[(i + 1) % 3])
            edges[e] = edges.get(e, 0) + 1
    locked = np.zeros(n, bool)
    for (i, j), m in edges.items():
        if m > 1 or edges.get((j, i), 0) != 1:
            locked[[i, j]] = True
    of: dict[int, set[int]] = {}
    for f, t in enumerate(tri.tolist()):
        for i in t:
            of.setdefault(i, set()).add(f)
    faces, remap_, stamp = [list(t) for t in tri.tolist()], np.arange(n), np.zeros(n, int)
    live = len(faces)

    def cost(i: int, j: int) -> float:
        p = np.append(pos[j], 1.0)
        return float(p @ (q[i] + q[j]) @ p) / max(weight[i] + weight[j], 1e-300) + 1e-4 * float(((pos[i] - pos[j]) ** 2).sum())

    heap = [(cost(i, j), i, j, 0, 0) for i, j in edges if not locked[i]]
    heapq.heapify(heap)
    while heap and live > target:
        e, i, j, si, sj = heapq.heappop(heap)
        if e > most_error * most_error:
            break
        if remap_[i] != i or remap_[j] != j or stamp[i] != si or stamp[j] != sj:
            continue
        common = of[i] & of[j]
        ring_i = {x for f in of[i] for x in faces[f]} - {i, j}
        ring_j = {x for f in of[j] for x in faces[f]} - {i, j}
        if len(common) != 2 or len(ring_i & ring_j) != 2:
            continue
        ok = True
        for f in of[i] - common:
            old = pos[faces[f]]
            new = np.array([pos[j] if x == i else pos[x] for x in faces[f]])
            if np.cross(old[1] - old[0], old[2] - old[0]) @ np.cross(new[1] - new[0], new[2] - new[0]) <= 0:
                ok = False
                break
        if not ok:
            continue
        for f in common:
            for x in faces[f]:
                if x != i:
                    of[x].discard(f)
            faces[f] = None
            live -= 1
        for f in of.pop(i) - common:
            faces[f] = [j if x == i else x for x in faces[f]]
            of[j].add(f)
        q[j] += q[i]
        weight[j] += weight[i]
        remap_[i] = j
        stamp[j] += 1
        for x in {x for f in of[j] for x in faces[f]} - {j}:
            for s, t in ((x, j), (j, x)):
                if not locked[s]:
                    heapq.heappush(heap, (cost(s, t), s, t, int(stamp[s]), int(stamp[t])))
    for i in range(n):
        j = i
        while remap_[j] != j:
            j = remap_[j]
        remap_[i] = j
    return np.array([f for f in faces if f is not None], np.int64).reshape(-1, 3), remap_


#: Triangles that one collapse works on, at most.
MOST_TRIANGLES = 200_000


def strips(pos: np.ndarray, tri: np.ndarray) -> list[np.ndarray]:
    """The triangles in parts of at most MOST_TRIANGLES, cut by their centroids along the longest side."""
    n = -(-len(tri) // MOST_TRIANGLES)
    if n <= 1:
        return [tri]
    mid = pos[tri].mean(1)
    side = int(np.argmax(mid.max(0) - mid.min(0)))
    return np.array_split(tri[np.argsort(mid[:, side], kind="stable")], n)


def collapse_blocks(vertices: DataFrame, triangles: DataFrame, keys: list[str], ratio: float = 0.25, most_error: float = 1e30, with_remap: bool = False, both: bool = False) -> DataFrame:
    """(keys..., i0, i1, i2): each block's triangles (keys, tid, i0, i1, i2) simplified on their own, block borders kept.

    with_remap: (keys..., vid, remap) instead, the vertex that each of a block's vertices became; both: rows of either
    kind, the other's columns null.
    A block must fit one task; blocks are grid cells, so their size is the cell's, not the data's. A block of more
    than MOST_TRIANGLES is cut into strips along its longest side first, whose borders stay too.
    """
    c = triangles.select(*keys, "tid", F.posexplode(F.array("i0", "i1", "i2")).alias("k", "vid"))
    rows = c.join(vertices.select("vid", "x", "y", "z"), "vid")
    types = dict(triangles.dtypes)
    names = ["i0", "i1", "i2", "vid", "remap"] if both else ["vid", "remap"] if with_remap else ["i0", "i1", "i2"]
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + "".join(f", {n} long" for n in names)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tid", "k"], kind="stable")
        ids, first, at = np.unique(pdf["vid"].to_numpy(), return_index=True, return_inverse=True)
        pos = pdf[["x", "y", "z"]].to_numpy()[first]
        tri = at.reshape(-1, 3)
        parts, to = [], np.arange(len(ids))
        for own in strips(pos, tri):
            used, local = np.unique(own, return_inverse=True)
            out, remap_ = collapse(pos[used], local.reshape(-1, 3), max(1, int(len(own) * ratio)), most_error)
            parts.append(used[out])
            moved = remap_ != np.arange(len(used))
            to[used[moved]] = used[remap_[moved]]
        moves, faces = pd.DataFrame({"vid": ids, "remap": ids[to]}), pd.DataFrame(ids[np.concatenate(parts)], columns=["i0", "i1", "i2"])
        res = pd.concat([faces, moves]).astype("Int64")[names] if both else moves if with_remap else faces
        for k, v in zip(reversed(keys), reversed(key), strict=True):
            res.insert(0, k, v)
        return res

    return rows.groupBy(*keys).applyInPandas(run, schema)


def clusterize(vertices: DataFrame, radius: float, probes: int = 10, key: str = "mesh_id") -> DataFrame:
    """(key, vid, remap): by rising vid, a vertex that is in no cluster yet founds one and takes its `probes` nearest within the radius.

    A later founder takes vertices over from an earlier one, which is why a mesh is walked in one task; its neighbours
    come from the distributed search. Vertices: key, vid, x, y, z, vids unique over all meshes.
    """
    from . import knn

    p = vertices.select(key, F.col("vid").alias("pid"), "x", "y", "z")
    near = knn.knn(p, p, probes, key=key).filter(F.col("d2") <= radius * radius)
    rows = near.join(p.select(key, "pid"), "pid").select(key, "pid", "nbr", "rank")
    kind = dict(vertices.dtypes)[key]

    def run(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["pid", "rank"], kind="stable")
        ids, first = np.unique(pdf["pid"].to_numpy(), return_index=True)
        nbr = pdf["nbr"].to_numpy()
        to: dict[int, int] = {}
        for i, group in zip(ids.tolist(), np.split(nbr, first[1:]), strict=True):
            if i not in to:
                to[i] = i
                to.update(dict.fromkeys(group.tolist(), i))
        return pd.DataFrame({key: k[0], "vid": ids, "remap": [to[i] for i in ids.tolist()]})

    return rows.groupBy(key).applyInPandas(run, f"{key} {kind}, vid long, remap long")
