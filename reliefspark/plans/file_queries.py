"""Round trips through the point and mesh file formats, in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as A
from ..lineage import fresh_folder
from ..sources import las, meshes
from .registry import query


def _folder(spark, name: str) -> str:
    return fresh_folder(spark, name)


@query("las_roundtrip", f"WITH {A.PTS} SELECT x, y, z, classification, scan_angle, source_id, gps_time FROM pts")
def las_roundtrip(spark, d):
    at = _folder(spark, "las")
    made = [r["uri"] for r in las.write(A.pts(spark, d).repartition(4, "pid"), at).collect()]  # one row a file
    return las.read(spark, made, records=20_000).select("x", "y", "z", "classification", "scan_angle", "source_id", "gps_time")


@query("las_headers", f"WITH {A.PTS} SELECT CAST(count(*) AS BIGINT) AS points, min(x) * CAST(0.01 AS DOUBLE) AS min_x, max(y) * CAST(0.01 AS DOUBLE) AS max_y FROM pts")
def las_headers(spark, d):
    at = _folder(spark, "las")
    uris = [r["uri"] for r in las.write(A.pts(spark, d).repartition(3, "pid"), at).collect()]
    return las.headers(spark, uris).agg(F.sum("count").alias("points"), F.min("min_x").alias("min_x"), F.max("max_y").alias("max_y"))


_M = f"WITH {A.VTX}, {A.TRI}, mt AS (SELECT i0 // 2000 AS mesh_id, * FROM tri), used AS (SELECT DISTINCT mesh_id, unnest([i0, i1, i2]) AS vid FROM mt)"


def _parts(spark, d):
    t = A.triangles(spark, d).withColumn("mesh_id", F.expr("i0 div 2000"))
    used = t.select("mesh_id", F.explode(F.array("i0", "i1", "i2")).alias("vid")).distinct()
    return used.join(A.vertices(spark, d), "vid").select("mesh_id", "vid", "x", "y", (F.round(F.col("z") / 64) / 64).alias("z")), t


def _trip(spark, d, kind):
    """Area-free summary: each triangle by its corner positions, which survive renumbering."""
    at = _folder(spark, kind)
    v, t = _parts(spark, d)
    rv, rt = meshes.read(spark, [r["uri"] for r in meshes.write(v, t, at, kind).collect()], kind)  # one row a mesh
    c = rt.select("path", "tid", F.posexplode(F.array("i0", "i1", "i2")).alias("k", "vid")).join(rv.select("path", "vid", "x", "y", "z"), ["path", "vid"])
    one = c.groupBy("path", "tid").agg(*[F.max(F.when(F.col("k") == k, F.col(a))).alias(f"{a}{k}") for k in range(3) for a in "xyz"])
    return one.drop("path", "tid")


_TRIP = f"{_M}, rv AS (SELECT vid, x, y, round(z / 64) / 64 AS z FROM vtx) SELECT a.x AS x0, a.y AS y0, a.z AS z0, b.x AS x1, b.y AS y1, b.z AS z1, c.x AS x2, c.y AS y2, c.z AS z2 FROM tri JOIN rv a ON i0 = a.vid JOIN rv b ON i1 = b.vid JOIN rv c ON i2 = c.vid"


@query("ply_roundtrip", _TRIP)
def ply_roundtrip(spark, d):
    return _trip(spark, d, "ply")


@query("obj_roundtrip", _TRIP)
def obj_roundtrip(spark, d):
    return _trip(spark, d, "obj")


@query("inria_roundtrip", _TRIP)
def inria_roundtrip(spark, d):
    return _trip(spark, d, "mesh")


_CELLS = f"{A.PTS}, lv AS (SELECT unnest([0, 1, 2, 3, 4]) AS level), c AS (SELECT DISTINCT level, CAST(floor((x + 10000) * power(2, level) / 131072) AS BIGINT) AS x, CAST(floor((y + 10000) * power(2, level) / 131072) AS BIGINT) AS y, CAST(floor(z * power(2, level) / 131072) AS BIGINT) AS z FROM pts, lv)"


@query("copc_prune", f"WITH {_CELLS}, b AS (SELECT *, 131072 / power(2, level) AS w FROM c) SELECT level, x, y, z FROM b WHERE x * w - 10000 <= 40000 AND (x + 1) * w - 10000 >= 20000 AND y * w - 10000 <= 30000 AND (y + 1) * w - 10000 >= 5000 AND z * w <= 20000 AND (z + 1) * w >= 0")
def copc_prune(spark, d):
    p = A.pts(spark, d).withColumn("level", F.explode(F.array(*map(F.lit, range(5)))))
    f = F.pow(F.lit(2.0), F.col("level")) / 131072
    cells = p.select("level", F.floor((F.col("x") + 10000) * f).alias("x"), F.floor((F.col("y") + 10000) * f).alias("y"), F.floor(F.col("z") * f).alias("z")).distinct()
    return las.cells_inside(cells, (55536.0, 55536.0, 65536.0), 65536.0, (20000.0, 5000.0, 0.0, 40000.0, 30000.0, 20000.0))
