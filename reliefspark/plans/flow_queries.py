"""Whole work flows and per-mesh orders, codecs and clusters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .. import adapters as A
from ..operators import grid, order, surface
from . import pipelines
from .cloud_queries import _D2, _EIG, _TURNS
from .point_queries import _LINES
from .registry import query


def _meshes(spark, d):
    return A.triangles(spark, d).withColumn("mesh_id", F.expr("i0 div 500"))


_MT = f"WITH {A.TRI}, mt AS (SELECT i0 // 500 AS mesh_id, * FROM tri)"


@query("cache_order", f"{_MT} SELECT mesh_id, i0, i1, i2 FROM mt")
def cache_order(spark, d):
    return order.optimized(_meshes(spark, d)).drop("tid")


@query("fetch_order", f"{_MT}, c AS (SELECT mesh_id, 3 * tid AS p, i0 AS old FROM mt UNION ALL SELECT mesh_id, 3 * tid + 1, i1 FROM mt UNION ALL SELECT mesh_id, 3 * tid + 2, i2 FROM mt) SELECT mesh_id, old, row_number() OVER (PARTITION BY mesh_id ORDER BY min(p)) - 1 AS new FROM c GROUP BY 1, 2")
def fetch_order(spark, d):
    return order.per_mesh(_meshes(spark, d), lambda t: pd.DataFrame({"old": (o := order.fetch_order(t)), "new": np.arange(len(o))}), "old long, new long")


@query("strip_round_trip", f"{_MT} SELECT mesh_id, count(*) AS triangles, sum(i0 + i1 + i2)::BIGINT AS total FROM mt GROUP BY 1")
def strip_round_trip(spark, d):
    def f(t: np.ndarray) -> pd.DataFrame:
        back = order.unstripify(order.stripify(t))
        return pd.DataFrame({"triangles": [len(back)], "total": [int(back.sum())]})

    return order.per_mesh(_meshes(spark, d), f, "triangles long, total long")


@query("index_codec", f"{_MT} SELECT mesh_id, i0, i1, i2 FROM mt")
def index_codec(spark, d):
    def f(t: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(order.decode_indices(order.encode_indices(t)), columns=["i0", "i1", "i2"])

    return order.per_mesh(_meshes(spark, d), f, "i0 long, i1 long, i2 long")


@query("encoded_sizes")
def encoded_sizes(spark, d):
    return order.encoded(_meshes(spark, d)).agg(F.sum("triangles").alias("triangles"), (F.sum(F.length("data")) / F.sum("triangles")).alias("bytes_per_triangle"))


def _fifo(name: str, source: str, most: int) -> str:
    """SQL: `name` (mesh_id, k, q, miss) walks `source` (mesh_id, k, v) through a queue of the `most` newest numbers."""
    return f"{name}(mesh_id, k, q, miss) AS (SELECT mesh_id, k, [v], 1 FROM {source} WHERE k = 1 UNION ALL SELECT r.mesh_id, s.k, CASE WHEN list_contains(r.q, s.v) THEN r.q ELSE list_append(r.q, s.v)[-{most}:] END, r.miss + CASE WHEN list_contains(r.q, s.v) THEN 0 ELSE 1 END FROM {name} r JOIN {source} s ON s.mesh_id = r.mesh_id AND s.k = r.k + 1)"


_WALK = f"WITH RECURSIVE {A.TRI}, mt AS (SELECT i0 // 500 AS mesh_id, * FROM tri), c AS (SELECT mesh_id, 3 * tid AS p, i0 AS v FROM mt UNION ALL SELECT mesh_id, 3 * tid + 1, i1 FROM mt UNION ALL SELECT mesh_id, 3 * tid + 2, i2 FROM mt), s AS MATERIALIZED (SELECT mesh_id, v, row_number() OVER (PARTITION BY mesh_id ORDER BY p) AS k FROM c), l AS (SELECT mesh_id, p, unnest(range(v * 12 // 64, (v * 12 + 11) // 64 + 1)) AS v FROM c), t AS MATERIALIZED (SELECT mesh_id, v, row_number() OVER (PARTITION BY mesh_id ORDER BY p, v) AS k FROM l)"


@query("cache_analysis", f"{_WALK}, {_fifo('fv', 's', 16)}, {_fifo('fl', 't', 128)}, a AS (SELECT mesh_id, max(miss) AS miss FROM fv GROUP BY 1), b AS (SELECT mesh_id, max(miss) AS lines FROM fl GROUP BY 1), n AS (SELECT mesh_id, count(*) // 3 AS triangles, count(DISTINCT v) AS vertices FROM c GROUP BY 1) SELECT mesh_id, miss / triangles AS acmr, miss / vertices AS atvr, 64 * lines / (12 * vertices) AS overfetch FROM a JOIN b USING (mesh_id) JOIN n USING (mesh_id)")
def cache_analysis(spark, d):
    return order.analyzed(_meshes(spark, d))


@query("meshlets", f"WITH RECURSIVE {A.TRI}, mt AS (SELECT i0 // 500 AS mesh_id, * FROM tri), o AS MATERIALIZED (SELECT mesh_id, i0, [i0, i1, i2] AS t, row_number() OVER (PARTITION BY mesh_id ORDER BY tid) AS k FROM mt), r(mesh_id, k, meshlet, used, n, i0) AS (SELECT mesh_id, k, 0, t, 1, i0 FROM o WHERE k = 1 UNION ALL SELECT mesh_id, k, CASE WHEN len(more) > 64 OR n >= 124 THEN meshlet + 1 ELSE meshlet END, CASE WHEN len(more) > 64 OR n >= 124 THEN t ELSE more END, CASE WHEN len(more) > 64 OR n >= 124 THEN 1 ELSE n + 1 END, i0 FROM (SELECT o.mesh_id, o.k, r.meshlet, r.n, o.t, o.i0, list_distinct(list_concat(r.used, o.t)) AS more FROM r JOIN o ON o.mesh_id = r.mesh_id AND o.k = r.k + 1)) SELECT mesh_id, CAST(meshlet AS BIGINT) AS meshlet, i0 FROM r")
def meshlets(spark, d):
    return order.per_mesh(_meshes(spark, d), lambda t: pd.DataFrame({"meshlet": order.meshlets(t), "i0": t[:, 0]}), "meshlet long, i0 long")


_CB = f"WITH {A.VTX}, {A.TRI}, zv AS (SELECT vid, x, y, round(z / 4096) AS z FROM vtx), mt AS (SELECT i0 // 500 AS mesh_id, * FROM tri), u AS (SELECT DISTINCT mesh_id, unnest([i0, i1, i2]) AS vid FROM mt), b AS (SELECT mesh_id, (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy, (min(z) + max(z)) / 2 AS cz FROM u JOIN zv USING (vid) GROUP BY 1), rd AS (SELECT mesh_id, sqrt(max((x - cx) ** 2 + (y - cy) ** 2 + (z - cz) ** 2)) AS radius FROM u JOIN zv USING (vid) JOIN b USING (mesh_id) GROUP BY 1), e AS (SELECT mesh_id, b.x - a.x AS ax, b.y - a.y AS ay, b.z - a.z AS az, c.x - a.x AS bx, c.y - a.y AS by_, c.z - a.z AS bz FROM mt JOIN zv a ON i0 = a.vid JOIN zv b ON i1 = b.vid JOIN zv c ON i2 = c.vid), n AS (SELECT mesh_id, ay * bz - az * by_ AS x, az * bx - ax * bz AS y, ax * by_ - ay * bx AS z FROM e), un AS (SELECT mesh_id, x / sqrt(x * x + y * y + z * z) AS x, y / sqrt(x * x + y * y + z * z) AS y, z / sqrt(x * x + y * y + z * z) AS z FROM n), s AS (SELECT mesh_id, sum(x) AS x, sum(y) AS y, sum(z) AS z FROM un GROUP BY 1), ax AS (SELECT mesh_id, x / sqrt(x * x + y * y + z * z) AS ax, y / sqrt(x * x + y * y + z * z) AS ay, z / sqrt(x * x + y * y + z * z) AS az FROM s), co AS (SELECT mesh_id, min(x * ax + y * ay + z * az) AS cosine FROM un JOIN ax USING (mesh_id) GROUP BY 1)"


@query("cluster_bounds", f"{_CB} SELECT mesh_id, cx, cy, cz, round(radius, 6) AS radius, round(ax, 6) AS ax, round(ay, 6) AS ay, round(az, 6) AS az, round(cosine, 6) AS cosine FROM b JOIN rd USING (mesh_id) JOIN ax USING (mesh_id) JOIN co USING (mesh_id)")
def cluster_bounds(spark, d):
    v = A.vertices(spark, d).select("vid", "x", "y", F.round(F.col("z") / 4096).alias("z"))
    names = ["cx", "cy", "cz", "radius", "ax", "ay", "az", "cosine"]
    out = order.with_positions(_meshes(spark, d), v, lambda pos, tri: pd.DataFrame([order.cluster_bounds(pos, tri)]), ", ".join(f"{n} double" for n in names))
    return out.select("mesh_id", *names[:3], *[F.round(n, 6).alias(n) for n in names[3:]])


@query("overdraw_clusters")
def overdraw_clusters(spark, d):
    """Clusters of each mesh in drawing order, with the pixels shaded over those covered before and after."""
    v = A.vertices(spark, d).select("vid", "x", "y", F.round(F.col("z") / 4096).alias("z"))

    def f(pos: np.ndarray, tri: np.ndarray) -> pd.DataFrame:
        cluster = order.meshlets(tri)
        o = order.overdraw_order(pos, tri, cluster)
        first = pd.unique(cluster[o])
        return pd.DataFrame({"place": np.arange(len(first)), "cluster": first, "before": order.overdraw(pos, tri), "after": order.overdraw(pos, tri[o])})

    return order.with_positions(_meshes(spark, d), v, f, "place long, cluster long, before double, after double")


_HF = f"{A.PTS}, hv AS (SELECT CAST(floor(x / 2000.0::DOUBLE) AS BIGINT) AS gx, CAST(floor(y / 2000.0::DOUBLE) AS BIGINT) AS gy, avg(z) AS z, count(*) AS n FROM pts GROUP BY 1, 2)"


@query("height_field", f"WITH {_HF} SELECT gy * 2147483648 + gx AS vid, (gx + 0.5::DOUBLE) * 2000 AS x, (gy + 0.5::DOUBLE) * 2000 AS y, round(z, 6) AS z, n FROM hv")
def height_field(spark, d):
    return surface.height_field(A.pts(spark, d), 2000.0)[0].withColumn("z", F.round("z", 6))


@query("height_field_triangles", f"WITH {_HF}, q AS (SELECT a.gy * 2147483648 + a.gx AS k FROM hv a WHERE EXISTS (SELECT 1 FROM hv b WHERE b.gx = a.gx + 1 AND b.gy = a.gy) AND EXISTS (SELECT 1 FROM hv b WHERE b.gx = a.gx AND b.gy = a.gy + 1) AND EXISTS (SELECT 1 FROM hv b WHERE b.gx = a.gx + 1 AND b.gy = a.gy + 1)) SELECT 2 * k AS tid, k AS i0, k + 1 AS i1, k + 2147483648 AS i2 FROM q UNION ALL SELECT 2 * k + 1, k + 1, k + 2147483649, k + 2147483648 FROM q")
def height_field_triangles(spark, d):
    return surface.height_field(A.pts(spark, d), 2000.0)[1]


# A sloping tile: places from the ids of `embeddings`, heights with the vectors' first numbers as noise.
_TILE = "pts AS (SELECT vec_id AS pid, vec_id % 5 AS source_id, (vec_id * 7919) % 100000 AS x, (vec_id * 104729) % 100000 AS y, (vec_id * 7919) % 100000 // 4 + (vec_id * 104729) % 100000 // 9 + CAST(round(CAST(embedding[1] AS DOUBLE) * 3000) AS BIGINT) AS z, CAST((vec_id * 31) % 61 - 30 AS INTEGER) AS scan_angle, CAST(vec_id AS DOUBLE) AS gps_time FROM embeddings)"


def _tile(spark, d):
    e = A.table(spark, d, "embeddings")
    z = F.expr("(vec_id * 7919) % 100000 div 4 + (vec_id * 104729) % 100000 div 9") + F.round(F.col("embedding")[0].cast("double") * 3000).cast("long")
    return e.select(F.col("vec_id").alias("pid"), F.expr("vec_id % 5").alias("source_id"), F.expr("(vec_id * 7919) % 100000").alias("x"), F.expr("(vec_id * 104729) % 100000").alias("y"), z.alias("z"), F.expr("cast((vec_id * 31) % 61 - 30 as int)").alias("scan_angle"), F.col("vec_id").cast("double").alias("gps_time"))


_OWN_LINES = _LINES.replace(" r AS (", " rl AS (").replace("r.n, repr", "rl.n, repr").replace("JOIN r USING", "JOIN rl USING")
_CHAIN = f"""{_OWN_LINES}, sp AS (SELECT min(z) AS lo, max(z) AS hi FROM pts), ut AS (SELECT 0.75::DOUBLE AS scale, 0.125::DOUBLE AS sh, 0.5::DOUBLE - round(0.5::DOUBLE * (lo + hi) * 1e-5::DOUBLE * 0.75::DOUBLE * 16) / 16.0::DOUBLE AS sz FROM sp),
 v AS (SELECT pid, x * 1e-5::DOUBLE * scale + sh AS x, y * 1e-5::DOUBLE * scale + sh AS y, z * 1e-5::DOUBLE * scale + sz AS z FROM pts, ut),
 pairs AS (SELECT a.pid, b.pid AS nbr, {_D2} AS d2 FROM v a, v b), kn AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY d2, nbr) AS rank FROM pairs QUALIFY rank <= 15), {_EIG},
 nv AS (SELECT pid, CASE WHEN axx >= ayy AND axx >= azz THEN axx WHEN ayy >= azz THEN axy ELSE axz END / sqrt(greatest(axx, ayy, azz) * t) AS nx, CASE WHEN axx >= ayy AND axx >= azz THEN axy WHEN ayy >= azz THEN ayy ELSE ayz END / sqrt(greatest(axx, ayy, azz) * t) AS ny, CASE WHEN axx >= ayy AND axx >= azz THEN axz WHEN ayy >= azz THEN ayz ELSE azz END / sqrt(greatest(axx, ayy, azz) * t) AS nz FROM e6),
 s0 AS (SELECT pid, nx, ny, nz, flat * near AS qual, is_valid, nx * cos(ac) * sin(radians(scan_angle)) + ny * sin(ac) * sin(radians(scan_angle)) - nz * cos(radians(scan_angle)) AS dd FROM nv JOIN eig USING (pid) JOIN pts USING (pid) JOIN fl USING (source_id)),
 s1 AS (SELECT *, coalesce(is_valid AND abs(dd) > 0.25 + 2 * (1 - qual), false) AS ok FROM s0), s2 AS (SELECT pid, CASE WHEN ok AND dd > 0 THEN -1 ELSE 1 END AS f, * EXCLUDE (pid) FROM s1),
 s3 AS (SELECT pid, f * nx AS nx, f * ny AS ny, f * nz AS nz, qual, CASE WHEN ok THEN 6 ELSE 1 END AS orient FROM s2), s4 AS (SELECT *, orient < 5 AND abs(nz) > 0.55 + 2 * (1 - qual) AS up FROM s3),
 st AS (SELECT pid, CASE WHEN up AND nz < 0 THEN -nx ELSE nx END AS nx, CASE WHEN up AND nz < 0 THEN -ny ELSE ny END AS ny, CASE WHEN up AND nz < 0 THEN -nz ELSE nz END AS nz, qual, CASE WHEN up THEN 5 ELSE orient END AS orient FROM s4)"""


@query("oriented_points", f"WITH RECURSIVE {_TILE}, {_CHAIN}, {_TURNS}, w AS (SELECT r.*, CASE WHEN orient >= 3 THEN qual ELSE 0 END AS k FROM r WHERE turn = (SELECT max(turn) FROM r)) SELECT pid, round(v.x, 9) AS x, round(v.z, 9) AS z, round(nx * k, 5) AS nx, round(ny * k, 5) AS ny, round(nz * k, 5) AS nz, round(qual, 5) AS qual, orient FROM w JOIN v USING (pid)")
def oriented_points(spark, d):
    o = pipelines.oriented_points(_tile(spark, d))
    return o.select("pid", *[F.round(c, 9).alias(c) for c in "xz"], *[F.round(c, 5).alias(c) for c in ("nx", "ny", "nz", "qual")], "orient")


def _region(spark, d):
    """Points dealt out over 3 x 3 tiles, thinly, with ids of their own in each tile."""
    p = A.pts(spark, d).withColumns({"tile_x": F.expr("cast(pid % 3 as int)"), "tile_y": F.expr("cast(pid div 3 % 3 as int)"), "pid": F.expr("pid div 9")})
    return p.withColumns({"x": F.pmod("x", F.lit(100000)), "y": F.pmod("y", F.lit(100000)), "classification": F.lit(2)})


_REGION = f"{A.PTS}, rp AS (SELECT CAST(pid % 3 AS INTEGER) AS tile_x, CAST(pid // 3 % 3 AS INTEGER) AS tile_y, pid // 9 AS pid, (x + 100000) % 100000 AS x, (y + 100000) % 100000 AS y, z FROM pts), st AS (SELECT a.i AS dx, b.i AS dy FROM (SELECT unnest([-1, 0, 1]) AS i) a, (SELECT unnest([-1, 0, 1]) AS i) b), hl AS (SELECT tile_x - dx AS tile_x, tile_y - dy AS tile_y, pid, x + 100000 * dx AS x, y + 100000 * dy AS y, dx = 0 AND dy = 0 AS own FROM rp, st)"


@query("region_halo", f"WITH {_REGION} SELECT tile_x, tile_y, pid, x, y, own FROM hl WHERE (own OR (x > -10000 AND x < 110000 AND y > -10000 AND y < 110000)) AND tile_x BETWEEN 0 AND 2 AND tile_y BETWEEN 0 AND 2")
def region_halo(spark, d):
    return pipelines.with_halo(_region(spark, d)).select("tile_x", "tile_y", "pid", "x", "y", "own")


@query("region_points")
def region_points(spark, d):
    return pipelines.region_points(_region(spark, d))


_FM = f"""WITH RECURSIVE {_HF}, q AS (SELECT a.gy * 2147483648 + a.gx AS k FROM hv a WHERE EXISTS (SELECT 1 FROM hv b WHERE b.gx = a.gx + 1 AND b.gy = a.gy) AND EXISTS (SELECT 1 FROM hv b WHERE b.gx = a.gx AND b.gy = a.gy + 1) AND EXISTS (SELECT 1 FROM hv b WHERE b.gx = a.gx + 1 AND b.gy = a.gy + 1)),
 tri AS MATERIALIZED (SELECT 2 * k AS tid, k AS i0, k + 1 AS i1, k + 2147483648 AS i2 FROM q UNION ALL SELECT 2 * k + 1, k + 1, k + 2147483649, k + 2147483648 FROM q),
 e AS (SELECT tid, least(i0, i1) AS a, greatest(i0, i1) AS b FROM tri UNION ALL SELECT tid, least(i1, i2), greatest(i1, i2) FROM tri UNION ALL SELECT tid, least(i2, i0), greatest(i2, i0) FROM tri),
 n AS MATERIALIZED (SELECT p.tid AS a, q.tid AS b FROM e p JOIN e q ON p.a = q.a AND p.b = q.b AND p.tid <> q.tid),
 reach(tid, root) USING KEY (tid) AS (SELECT tid, tid FROM tri UNION SELECT n.b, min(reach.root) FROM reach JOIN n ON n.a = reach.tid JOIN recurring.reach k ON k.tid = n.b WHERE reach.root < k.root GROUP BY n.b),
 best AS (SELECT root FROM reach GROUP BY 1 ORDER BY count(*) DESC, root LIMIT 1), pt AS (SELECT tri.* FROM tri JOIN reach USING (tid) JOIN best USING (root)),
 c AS (SELECT 3 * tid AS p, i0 AS v FROM pt UNION ALL SELECT 3 * tid + 1, i1 FROM pt UNION ALL SELECT 3 * tid + 2, i2 FROM pt), f AS (SELECT v, row_number() OVER (ORDER BY min(p)) - 1 AS new FROM c GROUP BY 1)"""


@query("finished_mesh", f"{_FM} SELECT tid, x.new AS i0, y.new AS i1, z.new AS i2 FROM pt JOIN f x ON i0 = x.v JOIN f y ON i1 = y.v JOIN f z ON i2 = z.v")
def finished_mesh(spark, d):
    return pipelines.finished_mesh(A.pts(spark, d), 2000.0)[1]


def _pyramid(spark, d):
    v = A.vertices(spark, d).withColumn("z", F.round(F.col("z") / 1024) / 8)
    return pipelines.build_pyramid(v, A.triangles(spark, d), (0.0, 0.0, 0.0), 25.0, 2)


@query("lod_pyramid")
def lod_pyramid(spark, d):
    return _pyramid(spark, d)[0]


_LB = f"""WITH {A.VTX}, {A.TRI}, zv AS (SELECT vid, x, y, round(z / 1024) / 8 AS z FROM vtx), cl AS (SELECT tid, i0, i1, i2, {', '.join(f"floor((a.{c} + b.{c} + c.{c}) / 3 / 25) AS c{c}" for c in 'xyz')} FROM tri JOIN zv a ON i0 = a.vid JOIN zv b ON i1 = b.vid JOIN zv c ON i2 = c.vid),
 bl AS (SELECT tid, i0, i1, i2, {', '.join(f"CAST(2 * floor((floor(c{c} / 2) + 1) / 2) - 1 AS BIGINT) AS bc{c}" for c in 'xyz')} FROM cl), h AS (SELECT bcx, bcy, bcz, i0 AS src, i1 AS dst FROM bl UNION ALL SELECT bcx, bcy, bcz, i1, i2 FROM bl UNION ALL SELECT bcx, bcy, bcz, i2, i0 FROM bl),
 be AS (SELECT a.* FROM h a LEFT JOIN h b ON b.bcx = a.bcx AND b.bcy = a.bcy AND b.bcz = a.bcz AND b.src = a.dst AND b.dst = a.src WHERE b.src IS NULL), f AS (SELECT bcx, bcy, bcz, src AS vid FROM be UNION SELECT bcx, bcy, bcz, dst FROM be), u AS (SELECT DISTINCT bcx, bcy, bcz, src AS vid FROM h)"""


@query("lod_parent_map", f"{_LB} SELECT bcx, bcy, bcz, count(*) AS vertices, count(f.vid) AS border, 0 AS moved_border FROM u LEFT JOIN f USING (bcx, bcy, bcz, vid) GROUP BY 1, 2, 3")
def lod_parent_map(spark, d):
    """Of each block of the first level's map: its vertices, those on the block's border, and border ones that moved."""
    v = A.vertices(spark, d).withColumn("z", F.round(F.col("z") / 1024) / 8)
    t = A.triangles(spark, d)
    key = ["bcx", "bcy", "bcz"]
    cells = grid.partition(v, t, (0.0, 0.0, 0.0), 25.0)
    own = t.join(cells.select("tid", *grid.parent("cx", "cy", "cz")).select("tid", *grid.block_base("pcx", "pcy", "pcz")), "tid").withColumnsRenamed({f"bpc{c}": f"bc{c}" for c in "xyz"})
    h = own.select(*key, F.explode(F.array(*[F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in (("i0", "i1"), ("i1", "i2"), ("i2", "i0"))])).alias("h")).select(*key, "h.src", "h.dst")
    edge = h.join(h.select(*key, F.col("dst").alias("src"), F.col("src").alias("dst")), [*key, "src", "dst"], "left_anti").select(*key, F.explode(F.array("src", "dst")).alias("vid")).distinct().withColumn("edge", F.lit(True))
    maps = _pyramid(spark, d)[1].filter("lod = 1").join(edge, [*key, "vid"], "left")
    return maps.groupBy(*key).agg(F.count("*").alias("vertices"), F.count("edge").alias("border"), F.sum(F.when(F.col("edge") & (F.col("parent") != F.col("vid")), 1).otherwise(0)).cast("int").alias("moved_border"))
