"""Triangle and vertex orders, strips, clusters and codecs of single meshes.

These work on one mesh (a tile or a grid cell) in numpy and run per mesh through
per_mesh(); a mesh is bounded by its tile, whatever the data's size.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 16


def cache_order(tri: np.ndarray, cache: int = CACHE) -> np.ndarray:
    """A permutation of the triangles that reuses recent vertices: greedily the triangle with the best corner scores.

    A corner scores by how recently it was used and by how few triangles still need it.
    """
    n = len(tri)
    of: dict[int, list[int]] = {}
    for f, t in enumerate(tri.tolist()):
        for v in t:
            of.setdefault(v, []).append(f)
    left = {v: len(f) for v, f in of.items()}
    done, order, recent, next_ = np.zeros(n, bool), [], [], 0

    def score(v: int) -> float:
        if not left[v]:
            return 0.0
        p = recent.index(v) if v in recent else -1
        return (0.75 if 0 <= p < 3 else (1 - (p - 3) / (cache - 3)) ** 1.5 if p >= 3 else 0.0) + 2.0 / left[v] ** 0.5

    while len(order) < n:
        near = {f for v in recent for f in of[v] if not done[f]}
        if near:
            best = max(near, key=lambda f: (sum(score(v) for v in tri[f].tolist()), -f))
        else:
            while done[next_]:
                next_ += 1
            best = next_
        done[best] = True
        order.append(best)
        for v in tri[best].tolist():
            left[v] -= 1
            if v in recent:
                recent.remove(v)
            recent.insert(0, v)
        del recent[cache:]
    return np.array(order, np.int64)


def fetch_order(tri: np.ndarray) -> np.ndarray:
    """Vertices by first use: old id of each new one; unused ones are gone."""
    u, first = np.unique(tri.ravel(), return_index=True)
    return u[np.argsort(first, kind="stable")]


def optimize(tri: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(triangles in cache order over vertices renumbered by first use, each triangle's former place, each vertex's former id)."""
    place = cache_order(tri)
    old = fetch_order(tri[place])
    new = np.empty(int(old.max()) + 1 if len(old) else 0, np.int64)
    new[old] = np.arange(len(old))
    return new[tri[place]], place, old


def cache_misses(tri: np.ndarray, cache: int = CACHE) -> dict[str, float]:
    """Misses of a first-in-first-out vertex cache: a triangle (acmr) and a vertex (atvr)."""
    queue, miss = [], 0
    for v in tri.ravel().tolist():
        if v not in queue:
            miss += 1
            queue.append(v)
            del queue[:-cache]
    return {"acmr": miss / max(1, len(tri)), "atvr": miss / max(1, len(np.unique(tri)))}


def overfetch(tri: np.ndarray, vertex_bytes: int = 12, line: int = 64, lines: int = 128) -> float:
    """Bytes fetched in cache lines over the bytes of all used vertices."""
    queue, fetched = [], 0
    for v in tri.ravel().tolist():
        for k in range(v * vertex_bytes // line, (v * vertex_bytes + vertex_bytes - 1) // line + 1):
            if k not in queue:
                fetched += line
                queue.append(k)
                del queue[:-lines]
    return fetched / max(1, len(np.unique(tri)) * vertex_bytes)


def stripify(tri: np.ndarray, restart: int = -1) -> list[int]:
    """Triangle strips parted by the restart index; orientation alternates within a strip."""
    by_edge: dict[tuple[int, int], list[int]] = {}
    for f, (a, b, c) in enumerate(tri.tolist()):
        for e in ((a, b), (b, c), (c, a)):
            by_edge.setdefault(e, []).append(f)
    done, out = np.zeros(len(tri), bool), []
    for f in range(len(tri)):
        if done[f]:
            continue
        strip = tri[f].tolist()
        done[f] = True
        while True:
            # The next triangle of an even place runs its shared edge as written, of an odd one reversed.
            edge = (strip[-1], strip[-2]) if len(strip) % 2 else (strip[-2], strip[-1])
            g = next((g for g in by_edge.get(edge, ()) if not done[g]), None)
            if g is None:
                break
            done[g] = True
            strip.append(next(v for v in tri[g].tolist() if v not in edge))
        out += ([restart] if out else []) + strip
    return out


def unstripify(strip: list[int], restart: int = -1) -> np.ndarray:
    tri, run = [], []
    for v in [*strip, restart]:
        if v == restart:
            for k in range(len(run) - 2):
                a, b, c = run[k : k + 3]
                tri.append((a, b, c) if k % 2 == 0 else (b, a, c))
            run = []
        else:
            run.append(v)
    return np.array([t for t in tri if len(set(t)) == 3], np.int64).reshape(-1, 3)


def meshlets(tri: np.ndarray, most_vertices: int = 64, most_triangles: int = 124) -> np.ndarray:
    """The cluster number of each triangle, taken in order while both limits hold."""
    out, now, used, n = np.zeros(len(tri), np.int64), 0, set(), 0
    for f, t in enumerate(tri.tolist()):
        more = used | set(t)
        if n and (len(more) > most_vertices or n >= most_triangles):
            now, more, n = now + 1, set(t), 0
        used, n = more, n + 1
        out[f] = now
    return out


def cluster_bounds(pos: np.ndarray, tri: np.ndarray) -> dict[str, float]:
    """Bounding sphere about the box centre and the normal cone's axis and least cosine."""
    p = pos[np.unique(tri)]
    centre = (p.min(0) + p.max(0)) / 2
    n = np.cross(pos[tri[:, 1]] - pos[tri[:, 0]], pos[tri[:, 2]] - pos[tri[:, 0]])
    n = n / np.maximum(np.linalg.norm(n, axis=1), 1e-300)[:, None]
    axis = n.sum(0) / max(np.linalg.norm(n.sum(0)), 1e-300)
    return dict(zip(("cx", "cy", "cz"), centre.tolist(), strict=True)) | {"radius": float(np.linalg.norm(p - centre, axis=1).max())} | dict(zip(("ax", "ay", "az"), axis.tolist(), strict=True)) | {"cosine": float((n @ axis).min())}


def _zigzag(a: np.ndarray) -> np.ndarray:
    return (a << 1) ^ (a >> 63)


def encode_indices(tri: np.ndarray) -> bytes:
    """Triangles as encode_sequence() of their corners."""
    return encode_sequence(tri.ravel())


def decode_indices(data: bytes) -> np.ndarray:
    return decode_sequence(data).reshape(-1, 3)


def encode_sequence(values: np.ndarray) -> bytes:
    """Differences of successive numbers as zigzag varints, deflated, behind their count."""
    z = _zigzag(np.diff(values, prepend=0)).astype(np.uint64)
    out = bytearray()
    for v in z.tolist():
        while v >= 128:
            out.append(v & 127 | 128)
            v >>= 7
        out.append(v)
    return struct.pack("<Q", len(values)) + zlib.compress(bytes(out), 6)


def decode_sequence(data: bytes) -> np.ndarray:
    n = struct.unpack_from("<Q", data)[0]
    values, v, shift = [], 0, 0
    for b in zlib.decompress(data[8:]):
        v |= (b & 127) << shift
        shift += 7
        if b < 128:
            values.append((v >> 1) ^ -(v & 1))
            v, shift = 0, 0
    if len(values) != n:
        raise ValueError("the data are cut short")
    return np.cumsum(np.array(values, np.int64))


def encode_vertices(columns: np.ndarray) -> bytes:
    """Float32 columns: bit patterns' differences down each column, split in byte planes, deflated."""
    a = np.ascontiguousarray(columns, "<f4")
    bits = a.view("<u4").astype(np.int64)
    delta = np.diff(bits, axis=0, prepend=0) & 0xFFFFFFFF
    planes = delta.astype("<u4").T.copy().view(np.uint8).reshape(a.shape[1], a.shape[0], 4).transpose(0, 2, 1)
    return struct.pack("<QI", *a.shape) + zlib.compress(planes.tobytes(), 6)


def decode_vertices(data: bytes) -> np.ndarray:
    n, m = struct.unpack_from("<QI", data)
    planes = np.frombuffer(zlib.decompress(data[12:]), np.uint8).reshape(m, 4, n).transpose(0, 2, 1)
    delta = np.ascontiguousarray(planes).view("<u4").reshape(m, n).T.astype(np.int64)
    return (np.cumsum(delta, axis=0) & 0xFFFFFFFF).astype("<u4").view("<f4")


def per_mesh(triangles: DataFrame, f: Callable[[np.ndarray], pd.DataFrame], schema: str, key: str = "mesh_id") -> DataFrame:
    """f applied to each mesh's triangles in tid order; its rows get the mesh's key."""

    def run(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = f(pdf.sort_values("tid", kind="stable")[["i0", "i1", "i2"]].to_numpy(np.int64))
        out.insert(0, key, k[0])
        return out

    return triangles.select(key, "tid", "i0", "i1", "i2").groupBy(key).applyInPandas(run, f"{key} long, {schema}")


def with_positions(triangles: DataFrame, vertices: DataFrame, f: Callable[[np.ndarray, np.ndarray], pd.DataFrame], schema: str, key: str = "mesh_id") -> DataFrame:
    """f applied to each mesh's positions and triangles (numbered by vid, in tid order); its rows get the mesh's key."""
    corners = triangles.select(key, "tid", F.posexplode(F.array("i0", "i1", "i2")).alias("k", "vid")).join(vertices.select("vid", "x", "y", "z"), "vid")

    def run(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tid", "k"], kind="stable")
        _, first, at = np.unique(pdf["vid"].to_numpy(), return_index=True, return_inverse=True)
        out = f(pdf[["x", "y", "z"]].to_numpy(float)[first], at.reshape(-1, 3))
        out.insert(0, key, k[0])
        return out

    return corners.groupBy(key).applyInPandas(run, f"{key} long, {schema}")


def overdraw(pos: np.ndarray, tri: np.ndarray, size: int = 64) -> float:
    """Pixels shaded over pixels covered, seen along the three axes from both sides with a depth test and back faces left out."""
    low, span = pos.min(0), max(float((pos.max(0) - pos.min(0)).max()), 1e-300)
    p = (pos - low) / span * (size - 1)
    shaded = covered = 0
    for axis in range(3):
        u, v = (axis + 1) % 3, (axis + 2) % 3
        for sign in (1, -1):
            depth = np.full((size, size), -np.inf)
            for t in tri:
                a, b, c = p[t]
                area = (b[u] - a[u]) * (c[v] - a[v]) - (b[v] - a[v]) * (c[u] - a[u])
                if area * sign <= 0:
                    continue
                us, vs = p[t][:, u], p[t][:, v]
                x = np.arange(int(np.ceil(us.min() - 0.5)), int(np.floor(us.max() - 0.5)) + 1) + 0.5
                y = np.arange(int(np.ceil(vs.min() - 0.5)), int(np.floor(vs.max() - 0.5)) + 1) + 0.5
                if not len(x) or not len(y):
                    continue
                gx, gy = np.meshgrid(x, y, indexing="ij")
                w1 = ((gx - a[u]) * (c[v] - a[v]) - (gy - a[v]) * (c[u] - a[u])) / area
                w2 = ((b[u] - a[u]) * (gy - a[v]) - (b[v] - a[v]) * (gx - a[u])) / area
                z = sign * (a[axis] + w1 * (b[axis] - a[axis]) + w2 * (c[axis] - a[axis]))
                ix, iy = gx.astype(int), gy.astype(int)
                win = (w1 >= 0) & (w2 >= 0) & (w1 + w2 <= 1) & (z > depth[ix, iy])
                shaded += int(win.sum())
                depth[ix[win], iy[win]] = z[win]
            covered += int(np.isfinite(depth).sum())
    return shaded / max(1, covered)


def optimized(triangles: DataFrame, key: str = "mesh_id") -> DataFrame:
    """(key, tid, i0, i1, i2): the same triangles in cache order."""

    def f(t: np.ndarray) -> pd.DataFrame:
        t = t[cache_order(t)]
        return pd.DataFrame({"tid": np.arange(len(t)), "i0": t[:, 0], "i1": t[:, 1], "i2": t[:, 2]})

    return per_mesh(triangles, f, "tid long, i0 long, i1 long, i2 long", key)


def encoded(triangles: DataFrame, key: str = "mesh_id") -> DataFrame:
    """(key, triangles, data): each mesh's index buffer as bytes."""
    return per_mesh(triangles, lambda t: pd.DataFrame({"triangles": [len(t)], "data": [encode_indices(t)]}), "triangles long, data binary", key)


def analyzed(triangles: DataFrame, key: str = "mesh_id") -> DataFrame:
    return per_mesh(triangles, lambda t: pd.DataFrame([cache_misses(t) | {"overfetch": overfetch(t)}]), "acmr double, atvr double, overfetch double", key)


def overdraw_order(pos: np.ndarray, tri: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """A permutation that draws outward-facing clusters first; the order within a cluster stays."""
    n = np.cross(pos[tri[:, 1]] - pos[tri[:, 0]], pos[tri[:, 2]] - pos[tri[:, 0]])
    area = np.linalg.norm(n, axis=1)
    mid = pos[tri].mean(1)
    k = int(cluster.max()) + 1 if len(cluster) else 0
    weight = np.maximum(np.bincount(cluster, weights=area, minlength=k), 1e-300)
    centre = np.stack([np.bincount(cluster, weights=area * mid[:, c], minlength=k) for c in range(3)], 1) / weight[:, None]
    facing = np.stack([np.bincount(cluster, weights=n[:, c], minlength=k) for c in range(3)], 1) / weight[:, None]
    whole = (mid * area[:, None]).sum(0) / max(area.sum(), 1e-300)
    return np.argsort(-((centre - whole) * facing).sum(1)[cluster], kind="stable")
