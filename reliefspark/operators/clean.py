"""Mesh cleaning: degenerate triangles, compaction, recutting, boundary snapping, bounds and normals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import mesh, remap


def skip_degenerate(triangles: DataFrame) -> DataFrame:
    return triangles.filter("i0 <> i1 AND i1 <> i2 AND i2 <> i0")


def drop_degenerate_positions(vertices: DataFrame, triangles: DataFrame) -> DataFrame:
    """Triangles with three different positions; indices keep their ids."""
    apart = skip_degenerate(remap.apply(triangles, remap.dedup(vertices)))
    return triangles.join(apart.select("tid"), "tid", "left_semi")


def compact(vertices: DataFrame, triangles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positions once each in order of first use, unreferenced and degenerate parts dropped."""
    v, t = remap.join_referenced(vertices, triangles)
    return v, skip_degenerate(t)


def with_corners(vertices: DataFrame, triangles: DataFrame) -> DataFrame:
    """(tid, p0, p1, p2): each triangle's positions as structs; one join over unpivoted corners."""
    c = triangles.select("tid", F.posexplode(F.array("i0", "i1", "i2")).alias("k", "vid"))
    j = c.join(vertices.select("vid", "x", "y", "z"), "vid")
    # Plain numbers are aggregated by hash; a struct's maximum would sort all corners.
    flat = j.groupBy("tid").agg(*[F.max(F.when(F.col("k") == k, F.col(a))).alias(f"{a}{k}") for k in range(3) for a in "xyz"])
    return flat.select("tid", *[F.struct(*[F.col(f"{a}{k}").alias(a) for a in "xyz"]).alias(f"p{k}") for k in range(3)])


def recut(vertices: DataFrame, triangles: DataFrame, shift_x: float, shift_y: float) -> DataFrame:
    """Triangles whose barycentre lies in [shift, 1 - shift] in x and y."""
    c = with_corners(vertices, triangles)
    inside = None
    for axis, s in (("x", shift_x), ("y", shift_y)):
        b = (F.col(f"p0.{axis}") + F.col(f"p1.{axis}") + F.col(f"p2.{axis}")) / F.lit(3.0)
        inside = b.between(s, 1 - s) if inside is None else inside & b.between(s, 1 - s)
    return triangles.join(c.filter(inside).select("tid"), "tid", "left_semi")


def snap_boundary(vertices: DataFrame, triangles: DataFrame, tolerance: float | None = 0.01) -> DataFrame:
    """Vertices, boundary ones with the coordinate nearer to a whole number moved there (x of equals).

    tolerance: beyond it a boundary vertex is interior to the tile and stays; None moves all.
    """
    b = mesh.boundary_vertices(triangles, both_ends=True).withColumn("edge", F.lit(True))
    ex, ey = F.abs(F.col("x") - F.round("x")), F.abs(F.col("y") - F.round("y"))
    near = F.coalesce(F.col("edge"), F.lit(False))
    if tolerance is not None:
        near = near & (F.least(ex, ey) <= tolerance)
    j = vertices.join(b, "vid", "left")
    return j.select("vid", F.when(near & (ex <= ey), F.round("x")).otherwise(F.col("x")).alias("x"), F.when(near & (ey < ex), F.round("y")).otherwise(F.col("y")).alias("y"), "z")


def bounds(vertices: DataFrame, *keys: str) -> DataFrame:
    return vertices.groupBy(*keys).agg(*[f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))])


def vertex_normals(vertices: DataFrame, triangles: DataFrame) -> DataFrame:
    """(vid, nx, ny, nz): area-weighted sum over all triangles at the vertex's position, normalised."""
    t = with_corners(vertices, triangles)
    a = {c: F.col(f"p1.{c}") - F.col(f"p0.{c}") for c in "xyz"}
    b = {c: F.col(f"p2.{c}") - F.col(f"p0.{c}") for c in "xyz"}
    cross = {"sx": a["y"] * b["z"] - a["z"] * b["y"], "sy": a["z"] * b["x"] - a["x"] * b["z"], "sz": a["x"] * b["y"] - a["y"] * b["x"]}
    t = t.select(F.explode(F.array("p0", "p1", "p2")).alias("p"), *[e.alias(n) for n, e in cross.items()])
    s = t.groupBy("p").agg(*[F.sum(c).alias(c) for c in cross])
    n = F.sqrt(F.col("sx") * F.col("sx") + F.col("sy") * F.col("sy") + F.col("sz") * F.col("sz"))
    s = s.select(F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("p.z").alias("z"), *[F.when(n == 0, F.col(c)).otherwise(F.col(c) / n).alias(f"n{c[1]}") for c in cross])
    return vertices.select("vid", "x", "y", "z").join(s, ["x", "y", "z"]).select("vid", "nx", "ny", "nz")
