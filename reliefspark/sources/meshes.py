"""Mesh files: PLY, OBJ and INRIA .mesh, read and written one mesh a file.

Files are read whole by one task each (a mesh is a tile's), through Spark's binary reader,
so that any store Spark reads will do.  Every format gives the same two row kinds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lineage import cut
from . import files

#: PLY type names and their numpy codes.
PLY_TYPES = {"char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "i2", "int16": "i2", "ushort": "u2", "uint16": "u2", "int": "i4", "int32": "i4", "uint": "u4", "uint32": "u4", "float": "f4", "float32": "f4", "double": "f8", "float64": "f8"}
#: Property names of the attributes, by alias.
PLY_NAMES = {"x": "x", "y": "y", "z": "z", "nx": "nx", "ny": "ny", "nz": "nz", "u": "u", "v": "v", "s": "u", "t": "v", "texture_u": "u", "texture_v": "v", "texture_s": "u", "texture_t": "v", "r": "r", "g": "g", "b": "b", "red": "r", "green": "g", "blue": "b"}
ATTRIBUTES = ("x", "y", "z", "nx", "ny", "nz", "u", "v", "r", "g", "b")

Mesh = tuple[dict[str, np.ndarray], np.ndarray]


def triangulate(polygon: list[int], pos: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Triangles of a polygon by clipping ears where positions are given, else a fan; fewer than three corners give nothing.

    An ear is a convex corner whose triangle holds no other corner, in the plane of the polygon's area vector;
    where rounding leaves none, the corner of the largest turn is clipped.
    """
    n = len(polygon)
    if n <= 3 or pos is None:
        return [(polygon[0], polygon[k], polygon[k + 1]) for k in range(1, n - 1)]
    p = pos[polygon]
    area = np.cross(p - p[0], np.roll(p, -1, 0) - p[0]).sum(0)
    drop = int(np.abs(area).argmax())
    flat = np.delete(p, drop, 1) * (1 if (area[drop] > 0) ^ (drop == 1) else np.array([-1, 1]))

    def turn(a: int, b: int, c: int) -> float:
        (ax, ay), (bx, by), (cx, cy) = flat[a], flat[b], flat[c]
        return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)

    left, out = list(range(n)), []
    while len(left) > 3:
        best = None
        for k in (*range(1, len(left)), 0):  # convex polygons become fans around their first corner
            a, b, c = left[k - 1], left[k], left[(k + 1) % len(left)]
            t = turn(a, b, c)
            clear = t > 0 and not any(min(turn(a, b, d), turn(b, c, d), turn(c, a, d)) >= 0 for d in left if d not in (a, b, c))
            if best is None or (clear, t) > best[0]:
                best = (clear, t), k
            if clear:
                break
        k = best[1]
        out.append((left[k - 1], left[k], left[(k + 1) % len(left)]))
        del left[k]
    return [tuple(polygon[i] for i in t) for t in [*out, tuple(left)]]


def parse_ply(data: bytes, positions_only: bool = False) -> Mesh:
    end = data.index(b"end_header") + len(b"end_header")
    end = data.index(b"\n", end) + 1
    kind, elements = "", []
    for line in data[:end].decode("latin-1").split("\n"):
        w = line.split()
        if w[:1] == ["format"]:
            kind = w[1]
        elif w[:1] == ["element"]:
            elements.append((w[1], int(w[2]), []))
        elif w[:1] == ["property"]:
            elements[-1][2].append(w[1:])
    order = ">" if kind == "binary_big_endian" else "<"
    words = iter(data[end:].split()) if kind == "ascii" else None
    at, attrs, tri = end, {}, []
    for name, n, props in elements:
        lists = [p for p in props if p[0] == "list"]
        if words is None and not lists:
            dt = np.dtype([(p[1], order + PLY_TYPES[p[0]]) for p in props])
            a = np.frombuffer(data, dt, n, at)
            at += n * dt.itemsize
            table = {p[1]: a[p[1]] for p in props}
        else:
            rows = []
            for _ in range(n):
                row = []
                for p in props:
                    if words is not None:
                        row.append([int(next(words)) for _ in range(int(next(words)))] if p[0] == "list" else float(next(words)))
                    elif p[0] == "list":
                        count = np.dtype(order + PLY_TYPES[p[1]])
                        m = int(np.frombuffer(data, count, 1, at)[0])
                        item = np.dtype(order + PLY_TYPES[p[2]])
                        row.append(np.frombuffer(data, item, m, at + count.itemsize).tolist())
                        at += count.itemsize + m * item.itemsize
                    else:
                        item = np.dtype(order + PLY_TYPES[p[0]])
                        row.append(float(np.frombuffer(data, item, 1, at)[0]))
                        at += item.itemsize
                rows.append(row)
            table = {p[-1]: [r[k] for r in rows] for k, p in enumerate(props)}
        if name == "vertex":
            attrs = {PLY_NAMES[k]: np.asarray(v, float) for k, v in table.items() if k in PLY_NAMES}
        elif name == "face":
            key = next((k for k in ("vertex_indices", "vertex_index") if k in table), None)
            pos = np.stack([attrs[c] for c in "xyz"], 1) if all(c in attrs for c in "xyz") else None
            tri = [t for polygon in table[key] for t in triangulate(polygon, pos)] if key else []
    keep = ("x", "y", "z") if positions_only else ATTRIBUTES
    return {k: v for k, v in attrs.items() if k in keep}, np.array(tri, np.int64).reshape(-1, 3)


def format_ply(attrs: dict[str, np.ndarray], tri: np.ndarray) -> bytes:
    names = [k for k in ATTRIBUTES if k in attrs]
    label = {"r": "red", "g": "green", "b": "blue"}
    dt = np.dtype([(k, "u1" if k in "rgb" else "<f4") for k in names])
    v = np.zeros(len(attrs["x"]), dt)
    for k in names:
        v[k] = attrs[k]
    f = np.zeros(len(tri), np.dtype([("n", "u1"), ("i", "<u4", 3)]))
    f["n"], f["i"] = 3, tri
    head = ["ply", "format binary_little_endian 1.0", f"element vertex {len(v)}", *[f"property {'uchar' if k in 'rgb' else 'float'} {label.get(k, k)}" for k in names], f"element face {len(f)}", "property list uchar uint vertex_indices", "end_header", ""]
    return "\n".join(head).encode() + v.tobytes() + f.tobytes()


def parse_obj(data: bytes) -> Mesh:
    """v, vt, vn and f statements; equal (position, texture, normal) corners are one vertex; polygons are cut by ears."""
    pos, tex, nml, seen, tri = [], [], [], {}, []
    for line in data.decode("utf-8", "replace").splitlines():
        w = line.split()
        if not w:
            continue
        if w[0] == "v":
            pos.append(tuple(map(float, w[1:4])))
        elif w[0] == "vt":
            tex.append(tuple(map(float, w[1:3])))
        elif w[0] == "vn":
            nml.append(tuple(map(float, w[1:4])))
        elif w[0] == "f":
            polygon, corner = [], []
            for c in w[1:]:
                parts = [int(x) if x else 0 for x in c.split("/")] + [0, 0]
                take = [(t[k - 1] if k > 0 else t[k]) if k else None for t, k in zip((pos, tex, nml), parts, strict=False)]
                polygon.append(seen.setdefault(tuple(take), len(seen)))
                corner.append(take[0])
            local = triangulate(list(range(len(polygon))), np.array(corner, float) if len(polygon) > 3 else None)
            tri += [tuple(polygon[k] for k in t) for t in local]
    rows = list(seen) or [(p, None, None) for p in pos]
    attrs = {c: np.array([r[0][k] for r in rows], float) for k, c in enumerate("xyz")}
    if rows and all(r[2] is not None for r in rows):
        attrs |= {c: np.array([r[2][k] for r in rows], float) for k, c in enumerate(("nx", "ny", "nz"))}
    if rows and all(r[1] is not None for r in rows):
        attrs |= {c: np.array([r[1][k] for r in rows], float) for k, c in enumerate("uv")}
    return attrs, np.array(tri, np.int64).reshape(-1, 3)


def obj_parts(data: bytes) -> list[tuple[str | None, str | None]]:
    """(group, material) of each triangle of an OBJ file, in the order of parse_obj()."""
    group = material = None
    out = []
    for line in data.decode("utf-8", "replace").splitlines():
        w = line.split()
        if w[:1] == ["g"]:
            group = " ".join(w[1:]) or None
        elif w[:1] == ["usemtl"]:
            material = " ".join(w[1:]) or None
        elif w[:1] == ["f"]:
            out += [(group, material)] * max(0, len(w) - 3)
    return out


#: Statements of material files: colours, single numbers, textures.
COLOURS, NUMBERS, TEXTURES = ("Ka", "Kd", "Ks", "Ke", "Tf"), ("Ns", "Ni", "d", "illum"), ("map_Ka", "map_Kd", "map_Ks", "map_Ke", "map_Ns", "map_d", "map_bump")


def parse_materials(data: bytes) -> list[dict]:
    """One dict a `newmtl`: its name, colours as three numbers, numbers and texture names; Tr counts as 1 - d."""
    out: list[dict] = []
    for line in data.decode("utf-8", "replace").splitlines():
        w = line.split("#")[0].split()
        if not w:
            continue
        if w[0] == "newmtl":
            out.append({"name": " ".join(w[1:])})
        elif out and w[0] in COLOURS:
            rgb = [float(x) for x in w[1:4]]
            out[-1][w[0]] = rgb * 3 if len(rgb) == 1 else rgb
        elif out and w[0] in NUMBERS:
            out[-1][w[0]] = float(w[1])
        elif out and w[0] == "Tr":
            out[-1]["d"] = 1 - float(w[1])
        elif out and w[0] in TEXTURES:
            out[-1][w[0]] = w[-1]
    return out


def read_obj_parts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, tid, group, material) of the triangles of OBJ files."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.obj").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, c in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                parts = obj_parts(c)
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(parts), pa.string()), pa.array(np.arange(len(parts))), *(pa.array([x[k] for x in parts], pa.string()) for k in (0, 1))], ["path", "tid", "group", "material"])

    return raw.mapInArrow(run, "path string, tid long, group string, material string")


def read_materials(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, name, colours map of three numbers, numbers map, textures map) of the materials of .mtl files."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.mtl").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("path", pa.string()), ("name", pa.string()), ("colours", pa.map_(pa.string(), pa.list_(pa.float64()))), ("numbers", pa.map_(pa.string(), pa.float64())), ("textures", pa.map_(pa.string(), pa.string()))])
        for b in batches:
            for p, c in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                rows = [{"path": p, "name": m["name"]} | {n: [(k, m[k]) for k in keys if k in m] for n, keys in (("colours", COLOURS), ("numbers", NUMBERS), ("textures", TEXTURES))} for m in parse_materials(c)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    return raw.mapInArrow(run, "path string, name string, colours map<string,array<double>>, numbers map<string,double>, textures map<string,string>")


def format_obj(attrs: dict[str, np.ndarray], tri: np.ndarray) -> bytes:
    out = [f"v {x:f} {y:f} {z:f}" for x, y, z in zip(attrs["x"], attrs["y"], attrs["z"], strict=True)]
    normals = "nx" in attrs
    if normals:
        out += [f"vn {x:f} {y:f} {z:f}" for x, y, z in zip(attrs["nx"], attrs["ny"], attrs["nz"], strict=True)]
    corner = "{0}//{0}" if normals else "{0}"
    out += ["f " + " ".join(corner.format(i + 1) for i in t) for t in tri.tolist()]
    return ("\n".join(out) + "\n").encode()


def parse_inria(data: bytes) -> Mesh:
    """Vertices and Triangles sections (1-based); other sections are skipped by their counts."""
    lines = iter([x.split() for x in data.decode("latin-1").splitlines() if x.strip()])
    v, tri = np.zeros((0, 3)), np.zeros((0, 3), np.int64)
    for w in lines:
        if w[0] == "End":
            break
        if w[0] in ("MeshVersionFormatted", "Dimension"):
            if len(w) == 1:
                next(lines)
            continue
        n = int(w[1] if len(w) > 1 else next(lines)[0])
        body = [next(lines) for _ in range(n)]
        if w[0] == "Vertices":
            v = np.array([r[:3] for r in body], float).reshape(-1, 3)
        elif w[0] == "Triangles":
            tri = np.array([r[:3] for r in body], np.int64).reshape(-1, 3) - 1
    return {c: v[:, k] for k, c in enumerate("xyz")}, tri


def format_inria(attrs: dict[str, np.ndarray], tri: np.ndarray) -> bytes:
    n = len(attrs["x"])
    out = ["MeshVersionFormatted 2", "Dimension 3", "Vertices", str(n), *[f"{x:.12g} {y:.12g} {z:.12g} 0" for x, y, z in zip(attrs["x"], attrs["y"], attrs["z"], strict=True)]]
    if "nx" in attrs:
        out += ["Normals", str(n), *[f"{x:.12g} {y:.12g} {z:.12g}" for x, y, z in zip(attrs["nx"], attrs["ny"], attrs["nz"], strict=True)]]
    out += ["Triangles", str(len(tri)), *[" ".join(str(i + 1) for i in t) + " 0" for t in tri.tolist()], "End", ""]
    return "\n".join(out).encode()


FORMATS: dict[str, tuple[Callable[[bytes], Mesh], Callable[..., bytes]]] = {"ply": (parse_ply, format_ply), "obj": (parse_obj, format_obj), "mesh": (parse_inria, format_inria)}


def read(spark: SparkSession, path: str | list[str], kind: str) -> tuple[DataFrame, DataFrame]:
    """(vertices (path, vid, attributes), triangles (path, tid, i0, i1, i2)) of all files of a kind in a folder, or of the files listed.

    Each file is parsed once, into one written table of both row kinds.
    """
    parse = FORMATS[kind][0]
    raw = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{kind}").load(path).select("path", "content")
    names = ["path", "vid", *ATTRIBUTES, "tid", "i0", "i1", "i2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, c in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                attrs, t = parse(c)
                n, m = len(attrs.get("x", ())), len(t)
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([p] * n, pa.string()), pa.array(np.arange(n)), *(pa.array(np.asarray(attrs[a], float)) if a in attrs else pa.nulls(n, pa.float64()) for a in ATTRIBUTES), none, none, none, none], names)
                yield pa.RecordBatch.from_arrays([pa.array([p] * m, pa.string()), pa.nulls(m, pa.int64()), *(pa.nulls(m, pa.float64()) for _ in ATTRIBUTES), pa.array(np.arange(m)), *(pa.array(np.ascontiguousarray(t[:, k])) for k in range(3))], names)

    rows = cut(raw.mapInArrow(run, "path string, vid long, " + ", ".join(f"{a} double" for a in ATTRIBUTES) + ", tid long, i0 long, i1 long, i2 long"))
    return rows.filter("vid IS NOT NULL").select("path", "vid", *ATTRIBUTES), rows.filter("tid IS NOT NULL").select("path", "tid", "i0", "i1", "i2")


def write(vertices: DataFrame, triangles: DataFrame, folder: str, kind: str) -> DataFrame:
    """One file a mesh_id and task attempt; rows (mesh_id, uri) of the committed ones, to be read as listed. Vertices (mesh_id, vid, x, y, z[, nx, ny, nz]) are numbered by vid."""
    form = FORMATS[kind][1]
    attrs = [c for c in ATTRIBUTES if c in vertices.columns]

    def run(key: tuple, v: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        v = v.sort_values("vid", kind="stable")
        t = t.sort_values("tid", kind="stable")
        at = np.searchsorted(v["vid"].to_numpy(), t[["i0", "i1", "i2"]].to_numpy())
        uri = f"{folder}/mesh-{key[0]}-{TaskContext.get().taskAttemptId()}.{kind}"
        files.write(uri, form({c: v[c].to_numpy() for c in attrs}, at.reshape(-1, 3)))
        return pd.DataFrame({"mesh_id": [key[0]], "uri": [uri]})

    v = vertices.select(F.col("mesh_id").cast("long").alias("mesh_id"), "vid", *attrs)
    t = triangles.select(F.col("mesh_id").cast("long").alias("mesh_id"), "tid", "i0", "i1", "i2")
    return v.groupBy("mesh_id").cogroup(t.groupBy("mesh_id")).applyInPandas(run, "mesh_id long, uri string")
