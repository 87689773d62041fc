"""Neighbour, normal, stitching, simplification and scalar-library queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as A
from ..functions import hashing, vec
from ..operators import grid, knn, mesh, normals, simplify
from .registry import query

_D2 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)"
_KNN = f"{A.V}, pairs AS (SELECT a.pid, b.pid AS nbr, {_D2} AS d2 FROM v a, v b), kn AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY d2, nbr) AS rank FROM pairs QUALIFY rank <= 15)"


def _nbrs(spark, d):
    p = A.v(spark, d)
    return knn.knn(p, p, 15)


@query("knn15", f"WITH {_KNN} SELECT pid, nbr, rank, d2 FROM kn")
def knn15(spark, d):
    return _nbrs(spark, d)


@query("radius_neighbours", f"WITH {A.V} SELECT a.pid, b.pid AS nbr, {_D2} AS d FROM v a JOIN v b ON {_D2} < CAST(0.08 AS DOUBLE) * CAST(0.08 AS DOUBLE)")
def radius_neighbours(spark, d):
    p = A.v(spark, d)
    return knn.within(p, p, 0.08)


@query("radius_neighbours_l1", f"WITH {A.V} SELECT a.pid, b.pid AS nbr, abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) AS d FROM v a JOIN v b ON abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) < CAST(0.1 AS DOUBLE)")
def radius_neighbours_l1(spark, d):
    p = A.v(spark, d)
    return knn.within(p, p, 0.1, "l1")


_COV = "cov AS (SELECT kn.pid, count(*) AS n, " + ", ".join(f"covar_pop(v.{p}, v.{q}) AS {p}{q}" for p, q in normals.COVARIANCE) + ", avg(v.x) AS bx, avg(v.y) AS by_, avg(v.z) AS bz FROM kn JOIN v ON kn.nbr = v.pid GROUP BY 1)"


def _cov(spark, d):
    return normals.covariance(_nbrs(spark, d), A.v(spark, d))


@query("neighbour_covariance", f"WITH {_KNN}, {_COV} SELECT pid, n, " + ", ".join(f"round({c}, 12) AS {c}" for c in normals.COVARIANCE) + ", round(bx, 12) AS bx FROM cov")
def neighbour_covariance(spark, d):
    return _cov(spark, d).select("pid", "n", *[F.round(c, 12).alias(c) for c in (*normals.COVARIANCE, "bx")])


_DET = f"""{_COV}, m AS (SELECT pid, 15 * xx AS xx, 15 * xy AS xy, 15 * xz AS xz, 15 * yy AS yy, 15 * yz AS yz, 15 * zz AS zz FROM cov),
 g AS (SELECT pid, yy * zz - yz * yz AS dx, xx * zz - xz * xz AS dy, xx * yy - xy * xy AS dz, xz * yz - xy * zz AS a, xy * yz - xz * yy AS b, xy * xz - yz * xx AS c FROM m),
 s1 AS (SELECT *, dx * dx * dx AS p, a * dx * dx AS q, b * dx * dx AS r FROM g), s2 AS (SELECT *, CASE WHEN p * a + q * dy + r * c < 0 THEN -1 ELSE 1 END * dy * dy AS w FROM s1),
 s3 AS (SELECT *, p + a * w AS p2, q + dy * w AS q2, r + c * w AS r2 FROM s2), s4 AS (SELECT *, CASE WHEN p2 * b + q2 * c + r2 * dz < 0 THEN -1 ELSE 1 END * dz * dz AS w2 FROM s3),
 s5 AS (SELECT pid, p2 + b * w2 AS p3, q2 + c * w2 AS q3, r2 + dz * w2 AS r3 FROM s4), det AS (SELECT pid, p3 / sqrt(p3 * p3 + q3 * q3 + r3 * r3) AS nx, q3 / sqrt(p3 * p3 + q3 * q3 + r3 * r3) AS ny, r3 / sqrt(p3 * p3 + q3 * q3 + r3 * r3) AS nz FROM s5)"""


@query("plane_fit_det", f"WITH {_KNN}, {_DET} SELECT pid, round(nx, 6) AS nx, round(ny, 6) AS ny, round(nz, 6) AS nz FROM det")
def plane_fit_det(spark, d):
    return normals.fit_determinant(_cov(spark, d)).select("pid", *[F.round(c, 6).alias(c) for c in ("nx", "ny", "nz")])


# Eigenvalues in closed form; with e the least, the adjugate of the matrix less e is a multiple of n n^T.
_EIG = f"""{_COV}, e0 AS (SELECT *, (xx + yy + zz) / 3 AS q FROM cov), e1 AS (SELECT *, sqrt(((xx - q) ** 2 + (yy - q) ** 2 + (zz - q) ** 2 + 2 * (xy ** 2 + xz ** 2 + yz ** 2)) / 6) AS p FROM e0),
 e2 AS (SELECT *, acos(greatest(-1, least(1, ((xx - q) * ((yy - q) * (zz - q) - yz * yz) - xy * (xy * (zz - q) - yz * xz) + xz * (xy * yz - (yy - q) * xz)) / (2 * p * p * p)))) / 3 AS f FROM e1),
 e3 AS (SELECT *, q + 2 * p * cos(f) AS top, q + 2 * p * cos(f + 2 * pi() / 3) AS low FROM e2), e4 AS (SELECT *, 3 * q - top - low AS mid, xx - low AS a, yy - low AS b, zz - low AS c FROM e3),
 e5 AS (SELECT *, b * c - yz * yz AS axx, a * c - xz * xz AS ayy, a * b - xy * xy AS azz, xz * yz - xy * c AS axy, xy * yz - b * xz AS axz, xy * xz - a * yz AS ayz FROM e4),
 e6 AS (SELECT e5.*, axx + ayy + azz AS t, v.x - bx AS dx, v.y - by_ AS dy, v.z - bz AS dz FROM e5 JOIN v USING (pid)),
 eig AS (SELECT pid, axx / t AS nxx, axy / t AS nxy, azz / t AS nzz, 1 - low / mid AS one, greatest(1 - low * top / (mid * mid), 0) AS flat, greatest(1 - 3 * (axx * dx * dx + ayy * dy * dy + azz * dz * dz + 2 * (axy * dx * dy + axz * dx * dz + ayz * dy * dz)) / t / top, 0) AS near FROM e6)"""


def _squares():
    """A normal's products, which do not depend on its sign."""
    return [F.round(F.col(a) * F.col(b), 5).alias(n) for a, b, n in (("nx", "nx", "nxx"), ("nx", "ny", "nxy"), ("nz", "nz", "nzz"))]


@query("plane_fit_eig", f"WITH {_KNN}, {_EIG} SELECT pid, round(nxx, 5) AS nxx, round(nxy, 5) AS nxy, round(nzz, 5) AS nzz, round(flat * near, 5) AS qual FROM eig")
def plane_fit_eig(spark, d):
    return normals.fit_planes(_cov(spark, d), A.v(spark, d)).select("pid", *_squares(), F.round("qual", 5).alias("qual"))


@query("plane_fit_split", f"WITH {_KNN}, {_EIG} SELECT pid, round(nxx, 5) AS nxx, round(nxy, 5) AS nxy, round(nzz, 5) AS nzz, round(one, 5) AS qual, round(near, 5) AS qual2 FROM eig")
def plane_fit_split(spark, d):
    return normals.fit_planes(_cov(spark, d), A.v(spark, d), split=True).select("pid", *_squares(), F.round("qual", 5).alias("qual"), F.round("qual2", 5).alias("qual2"))


_ST = "st AS (SELECT pid, x / sqrt(x * x + y * y + z * z) AS nx, y / sqrt(x * x + y * y + z * z) AS ny, z / sqrt(x * x + y * y + z * z) AS nz, CAST(0.9 AS DOUBLE) + (pid % 11) / CAST(110 AS DOUBLE) AS qual, CASE WHEN pid % 4 = 0 THEN 6 ELSE 1 END AS orient, CAST((pid * 31) % 61 - 30 AS INTEGER) AS scan_angle, pid % 5 <> 0 AS is_valid, (pid % 628) / CAST(100 AS DOUBLE) AS theta FROM v)"


def _st(spark, d):
    n = "sqrt(x * x + y * y + z * z)"
    return A.v(spark, d).selectExpr("pid", f"x / {n} nx", f"y / {n} ny", f"z / {n} nz", "0.9D + (pid % 11) / 110D qual", "case when pid % 4 = 0 then 6 else 1 end orient", "cast((pid * 31) % 61 - 30 as int) scan_angle", "pid % 5 <> 0 is_valid", "(pid % 628) / 100D theta_across")


@query("orient_scan", f"WITH {A.V}, {_ST}, b AS (SELECT *, nx * cos(theta) * sin(radians(scan_angle)) + ny * sin(theta) * sin(radians(scan_angle)) - nz * cos(radians(scan_angle)) AS dd FROM st), c AS (SELECT *, orient < 6 AND is_valid AND abs(dd) > 0.25 + 2 * (1 - qual) AS ok FROM b) SELECT pid, round(CASE WHEN ok AND dd > 0 THEN -nx ELSE nx END, 9) AS nx, round(CASE WHEN ok AND dd > 0 THEN -nz ELSE nz END, 9) AS nz, CASE WHEN ok THEN 6 ELSE orient END AS orient FROM c")
def orient_scan(spark, d):
    return normals.orient_by_beam(_st(spark, d)).select("pid", F.round("nx", 9).alias("nx"), F.round("nz", 9).alias("nz"), "orient")


@query("orient_z", f"WITH {A.V}, {_ST}, c AS (SELECT *, orient < 5 AND abs(nz) > 0.55 + 2 * (1 - qual) AS ok FROM st) SELECT pid, round(CASE WHEN ok AND nz < 0 THEN -nx ELSE nx END, 9) AS nx, round(CASE WHEN ok AND nz < 0 THEN -nz ELSE nz END, 9) AS nz, CASE WHEN ok THEN 5 ELSE orient END AS orient FROM c")
def orient_z(spark, d):
    return normals.orient_up(_st(spark, d)).select("pid", F.round("nx", 9).alias("nx"), F.round("nz", 9).alias("nz"), "orient")


_VOTE = "vt AS (SELECT a.pid, sum(sign(a.nx * b.nx + a.ny * b.ny + a.nz * b.nz)) AS major, count(*) AS votes FROM st a JOIN kn USING (pid) JOIN st b ON kn.nbr = b.pid WHERE a.orient IN (1, 2) AND b.orient >= 3 AND abs(a.nx * b.nx + a.ny * b.ny + a.nz * b.nz) > 0.85 + 0.15 * (1 - a.qual * b.qual) GROUP BY 1), won AS (SELECT pid, major FROM vt WHERE major <> 0 AND abs(major) >= votes // 2), vis AS (SELECT DISTINCT nbr AS pid FROM won JOIN kn USING (pid))"


@query("orient_propagate_1", f"WITH {_KNN}, {_ST}, {_VOTE} SELECT st.pid, CASE WHEN won.pid IS NOT NULL THEN 4 WHEN orient < 2 THEN CASE WHEN vis.pid IS NOT NULL THEN 1 ELSE 0 END ELSE orient END AS orient, round(CASE WHEN major < 0 THEN -nx ELSE nx END, 9) AS nx FROM st LEFT JOIN won ON st.pid = won.pid LEFT JOIN vis ON st.pid = vis.pid")
def orient_propagate_1(spark, d):
    s = normals.propagate_once(_st(spark, d).select("pid", "nx", "ny", "nz", "qual", "orient"), _nbrs(spark, d))
    return s.select("pid", "orient", F.round("nx", 9).alias("nx"))


# Each turn works on all points; the last one has nothing undecided, or as much as the one before.
_TURNS = """kk AS MATERIALIZED (SELECT pid, nbr FROM kn), r(turn, pid, nx, ny, nz, qual, orient, before, unset) AS (
  SELECT 0, pid, nx, ny, nz, qual, orient, -1::BIGINT, sum(CASE WHEN orient < 3 THEN 1 ELSE 0 END) OVER ()::BIGINT FROM st UNION ALL
  SELECT turn + 1, pid, nx, ny, nz, qual, orient, unset, sum(CASE WHEN orient < 3 THEN 1 ELSE 0 END) OVER ()::BIGINT FROM (
   WITH cur AS (SELECT * FROM r WHERE unset <> 0 AND unset <> before AND turn < 99),
    vt AS (SELECT a.pid, sum(sign(a.nx * b.nx + a.ny * b.ny + a.nz * b.nz)) AS major, count(*) AS votes FROM cur a JOIN kk USING (pid) JOIN cur b ON kk.nbr = b.pid WHERE a.orient IN (1, 2) AND b.orient >= 3 AND abs(a.nx * b.nx + a.ny * b.ny + a.nz * b.nz) > 0.85 + 0.15 * (1 - a.qual * b.qual) GROUP BY 1),
    won AS (SELECT pid, major FROM vt WHERE major <> 0 AND abs(major) >= votes // 2), vis AS (SELECT DISTINCT nbr AS pid FROM won JOIN kk USING (pid))
   SELECT cur.turn, cur.pid, CASE WHEN major < 0 THEN -nx ELSE nx END AS nx, CASE WHEN major < 0 THEN -ny ELSE ny END AS ny, CASE WHEN major < 0 THEN -nz ELSE nz END AS nz, qual, CASE WHEN won.pid IS NOT NULL THEN 4 WHEN orient < 2 THEN CASE WHEN vis.pid IS NOT NULL THEN 1 ELSE 0 END ELSE orient END AS orient, unset
   FROM cur LEFT JOIN won ON cur.pid = won.pid LEFT JOIN vis ON cur.pid = vis.pid))"""


@query("orient_propagate", f"WITH RECURSIVE {_KNN}, {_ST}, {_TURNS} SELECT pid, round(nx, 9) AS nx, round(nz, 9) AS nz, orient FROM r WHERE turn = (SELECT max(turn) FROM r)")
def orient_propagate(spark, d):
    s = normals.propagate(_st(spark, d).select("pid", "nx", "ny", "nz", "qual", "orient"), _nbrs(spark, d))
    return s.select("pid", F.round("nx", 9).alias("nx"), F.round("nz", 9).alias("nz"), "orient")


@query("orient_progress", f"WITH {A.V}, {_ST} SELECT avg(CASE WHEN orient >= 3 THEN 1.0 ELSE 0.0 END) AS oriented FROM st")
def orient_progress(spark, d):
    return normals.progress(_st(spark, d))


# Two meshes that meet: the last and first columns of the grid, the second shifted.
_STITCH = f"{A.VTX}, a AS (SELECT vid, y, z / 100000 AS z FROM vtx WHERE vid % 100 = 99), b AS (SELECT vid, y + CAST(0.37 AS DOUBLE) AS y, z / 100000 AS z FROM vtx WHERE vid % 100 = 0 AND vid % 300 <> 0)"
_NN = "(SELECT {p}.vid AS p, {q}.vid AS q, row_number() OVER (PARTITION BY {p}.vid ORDER BY ({p}.y - {q}.y) * ({p}.y - {q}.y) + ({p}.z - {q}.z) * ({p}.z - {q}.z), {q}.vid) AS r FROM {p}, {q})"


def _sides(v):
    a = v.filter("vid % 100 = 99").selectExpr("vid", "1D x", "y", "z / 100000 z")
    b = v.filter("vid % 100 = 0 AND vid % 300 <> 0").selectExpr("vid", "0D x", "y + 0.37D y", "z / 100000 z")
    return a, b


def _stitched(v):
    a, b = _sides(v)
    at0 = a.withColumn("x", F.lit(0.0))  # both sides in the frame of the seam
    out0, out1 = knn.stitch(at0, b, a.select("vid"), b.select("vid"))
    return out0.select(F.lit(0).alias("mesh"), "vid", "y", "z").unionByName(out1.select(F.lit(1).alias("mesh"), "vid", "y", "z"))


@query("nearest_stitch", f"WITH {_STITCH}, n10 AS (SELECT p AS v1, q AS v0 FROM {_NN.format(p='b', q='a')} WHERE r = 1), n01 AS (SELECT p AS v0, q AS v1 FROM {_NN.format(p='a', q='b')} WHERE r = 1), via AS (SELECT n01.v0 AS vid, n10.v0 AS t FROM n01 JOIN n10 USING (v1) WHERE n01.v0 NOT IN (SELECT v0 FROM n10)) SELECT 0 AS mesh, a.vid, coalesce(t.y, a.y) AS y, coalesce(t.z, a.z) AS z FROM a LEFT JOIN via ON a.vid = via.vid LEFT JOIN a t ON via.t = t.vid UNION ALL SELECT 1, b.vid, t.y, t.z FROM b JOIN n10 ON b.vid = v1 JOIN a t ON v0 = t.vid")
def nearest_stitch(spark, d):
    return _stitched(A.vertices(spark, d))


_ZV = "zv AS (SELECT vid, x, y, z / 5000 AS z FROM vtx)"
_G = "ex AS (SELECT min(x) AS x0, min(y) AS y0, min(z) AS z0, 1 / greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS s FROM zv), g AS (SELECT vid, x, y, z, CAST(floor((x - x0) * s * 31 + 0.5) AS INTEGER) AS gx, CAST(floor((y - y0) * s * 31 + 0.5) AS INTEGER) AS gy, CAST(floor((z - z0) * s * 31 + 0.5) AS INTEGER) AS gz FROM zv, ex)"


def _zv(spark, d):
    return A.vertices(spark, d).withColumn("z", F.col("z") / 5000)


@query("simplify_scale", f"WITH {A.VTX}, {_ZV} SELECT greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS scale FROM zv")
def simplify_scale(spark, d):
    return simplify.extent(_zv(spark, d))


@query("voxel_simplify", f"WITH {A.VTX}, {_ZV}, {_G}, mm AS (SELECT gx, gy, gz, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM g GROUP BY 1, 2, 3), dd AS (SELECT g.*, round((x - mx) * (x - mx) + (y - my) * (y - my) + (z - mz) * (z - mz), 9) AS dist FROM g JOIN mm USING (gx, gy, gz)) SELECT vid FROM dd QUALIFY row_number() OVER (PARTITION BY gx, gy, gz ORDER BY dist, vid) = 1")
def voxel_simplify(spark, d):
    return simplify.voxel_points(_zv(spark, d), 32)


@query("grid_snap_simplify", f"WITH {A.VTX}, {A.TRI}, {_ZV}, {_G}, lo AS (SELECT vid, min(vid) OVER (PARTITION BY gx, gy, gz) AS r FROM g), t AS (SELECT a.r AS i0, b.r AS i1, c.r AS i2 FROM tri JOIN lo a ON i0 = a.vid JOIN lo b ON i1 = b.vid JOIN lo c ON i2 = c.vid WHERE a.r <> b.r AND b.r <> c.r AND c.r <> a.r) SELECT DISTINCT CASE WHEN i0 < i1 AND i0 < i2 THEN i0 WHEN i1 < i2 THEN i1 ELSE i2 END AS i0, CASE WHEN i0 < i1 AND i0 < i2 THEN i1 WHEN i1 < i2 THEN i2 ELSE i0 END AS i1, CASE WHEN i0 < i1 AND i0 < i2 THEN i2 WHEN i1 < i2 THEN i0 ELSE i1 END AS i2 FROM t")
def grid_snap_simplify(spark, d):
    return simplify.snap_to_grid(_zv(spark, d), A.triangles(spark, d), 32)


_GS = "ex AS (SELECT min(x) AS x0, min(y) AS y0, min(z) AS z0, 1 / greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS s FROM zv), b(low, high) AS (SELECT 1, 257 UNION ALL SELECT CASE WHEN c <= 2000 THEN mid ELSE low END, CASE WHEN c <= 2000 THEN high ELSE mid END FROM (SELECT low, high, (low + high) // 2 AS mid, (SELECT count(*) FROM (SELECT DISTINCT floor((x - x0) * s * ((low + high) // 2 - 1) + 0.5), floor((y - y0) * s * ((low + high) // 2 - 1) + 0.5), floor((z - z0) * s * ((low + high) // 2 - 1) + 0.5) FROM zv, ex)) AS c FROM b WHERE high - low > 1)), g AS (SELECT max(low) AS grid FROM b)"


@query("grid_search", f"WITH RECURSIVE {A.VTX}, {_ZV}, {_GS} SELECT CAST(grid AS INTEGER) AS grid, count(DISTINCT (floor((x - x0) * s * (grid - 1) + 0.5), floor((y - y0) * s * (grid - 1) + 0.5), floor((z - z0) * s * (grid - 1) + 0.5))) AS points FROM zv, ex, g GROUP BY grid")
def grid_search(spark, d):
    """The widest grid of at most 2000 cells, and the points that stand for its cells."""
    n = simplify.fit_grid(_zv(spark, d), 2000, 256)
    return simplify.voxel_points(_zv(spark, d), n).agg(F.lit(n).alias("grid"), F.count("*").alias("points")).select("grid", "points")


def _blocks(spark, d):
    return A.triangles(spark, d).select(F.expr("i0 % 100 div 25").alias("cx"), F.expr("i0 div 2500").alias("cy"), "tid", "i0", "i1", "i2")


_QB = "qt AS (SELECT i0 % 100 // 25 AS cx, i0 // 2500 AS cy, * FROM tri), qh AS (SELECT cx, cy, i0 AS src, i1 AS dst FROM qt UNION ALL SELECT cx, cy, i1, i2 FROM qt UNION ALL SELECT cx, cy, i2, i0 FROM qt), qb AS (SELECT * FROM qh a WHERE NOT EXISTS (SELECT 1 FROM qh b WHERE b.cx = a.cx AND b.cy = a.cy AND b.src = a.dst AND b.dst = a.src))"


@query("qem_simplify", f"WITH {A.VTX}, {A.TRI}, {_QB} SELECT cx, cy, src, dst FROM qb")
def qem_simplify(spark, d):
    """The border half-edges of each simplified block: collapses leave the border as it was."""
    t = simplify.collapse_blocks(_zv(spark, d), _blocks(spark, d), ["cx", "cy"])
    h = t.select("cx", "cy", F.explode(F.array(*[F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in (("i0", "i1"), ("i1", "i2"), ("i2", "i0"))])).alias("h")).select("cx", "cy", "h.src", "h.dst")
    return h.join(h.select("cx", "cy", F.col("dst").alias("src"), F.col("src").alias("dst")), ["cx", "cy", "src", "dst"], "left_anti")


@query("qem_remap", f"WITH {A.VTX}, {A.TRI}, {_QB}, u AS (SELECT DISTINCT cx, cy, src AS vid FROM qh), f AS (SELECT DISTINCT cx, cy, src AS vid FROM qb UNION SELECT cx, cy, dst FROM qb) SELECT u.cx, u.cy, count(*) AS vertices, count(f.vid) AS border, count(f.vid) AS fixed_border, 0 AS astray FROM u LEFT JOIN f ON f.cx = u.cx AND f.cy = u.cy AND f.vid = u.vid GROUP BY 1, 2")
def qem_remap(spark, d):
    """Of each block: vertices in the remap, border ones, those of them that stay and remaps to a vertex that does not stay itself."""
    t = _blocks(spark, d)
    r = simplify.collapse_blocks(_zv(spark, d), t, ["cx", "cy"], with_remap=True)
    h = t.select("cx", "cy", F.explode(F.array(*[F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in (("i0", "i1"), ("i1", "i2"), ("i2", "i0"))])).alias("h")).select("cx", "cy", "h.src", "h.dst")
    edge = h.join(h.select("cx", "cy", F.col("dst").alias("src"), F.col("src").alias("dst")), ["cx", "cy", "src", "dst"], "left_anti")
    border = edge.select("cx", "cy", F.explode(F.array("src", "dst")).alias("vid")).distinct().withColumn("edge", F.lit(True))
    own = r.select("cx", "cy", "vid", "remap").join(border, ["cx", "cy", "vid"], "left")
    astray = r.filter("remap <> vid").select("cx", "cy", F.col("remap").alias("vid")).distinct().join(r.filter("remap = vid").select("cx", "cy", "vid"), ["cx", "cy", "vid"], "left_anti").groupBy("cx", "cy").agg(F.count("*").alias("lost"))
    return own.groupBy("cx", "cy").agg(F.count("*").alias("vertices"), F.count("edge").alias("border"), F.sum(F.when(F.col("edge") & (F.col("remap") == F.col("vid")), 1).otherwise(0)).alias("fixed_border")).join(astray, ["cx", "cy"], "left").select("cx", "cy", "vertices", "border", "fixed_border", F.coalesce("lost", F.lit(0)).cast("int").alias("astray"))


_UQ = "w AS (SELECT pid, (x + 10000) / CAST(120000 AS DOUBLE) AS x, (y + 10000) / CAST(120000 AS DOUBLE) AS y, z / CAST(50000 AS DOUBLE) AS z FROM pts)"


def _w(spark, d):
    return A.pts(spark, d).selectExpr("pid", "(x + 10000) / 120000D x", "(y + 10000) / 120000D y", "z / 50000D z")


@query("quantize_h", f"WITH {A.PTS}, {_UQ} SELECT pid, round(x / CAST(0.0625 AS DOUBLE)) * 0.0625 AS x, round(z / CAST(0.0625 AS DOUBLE)) * 0.0625 AS z FROM w")
def quantize_h(spark, d):
    return _w(spark, d).select("pid", *[grid.quantize_step(F.col(c), 0.0625).alias(c) for c in "xz"])


@query("quantize_u16", f"WITH {A.PTS}, {_UQ} SELECT pid, CAST(trunc(x * 32768 + 16384) AS INTEGER) & 65535 AS qx, CAST(trunc(y * 32768 + 16384) AS INTEGER) & 65535 AS qy, CAST(trunc(z * 16384) AS INTEGER) & 65535 AS qz FROM w")
def quantize_u16(spark, d):
    return _w(spark, d).select("pid", *[e.alias(n) for e, n in zip(grid.quantize_u16(F.col("x"), F.col("y"), F.col("z")), ("qx", "qy", "qz"), strict=True)])


_CQ = "c AS (SELECT pid, x, floor(x * 8) / 8 AS s, CAST(trunc((x - floor(x * 8) / 8) * 262144 + 16384) AS INTEGER) AS q FROM w)"


@query("quantize_cell", f"WITH {A.PTS}, {_UQ}, {_CQ} SELECT pid, s, q FROM c")
def quantize_cell(spark, d):
    s = F.floor(F.col("x") * 8) / 8
    return _w(spark, d).select("pid", s.alias("s"), grid.quantize_cell(F.col("x"), s, 8).alias("q"))


@query("dequantize", f"WITH {A.PTS}, {_UQ}, {_CQ} SELECT pid, (q - 16384) / CAST(262144 AS DOUBLE) + s AS x, abs((q - 16384) / CAST(262144 AS DOUBLE) + s - x) < 0.00001 AS near FROM c")
def dequantize(spark, d):
    s = F.floor(F.col("x") * 8) / 8
    q = grid.dequantize_cell(grid.quantize_cell(F.col("x"), s, 8), s, 8)
    return _w(spark, d).select("pid", q.alias("x"), (F.abs(q - F.col("x")) < 0.00001).alias("near"))


@query("unorm_snorm", f"WITH {A.PTS}, {_UQ}, {A.V} SELECT w.pid, CAST(floor(greatest(0, least(1, w.x)) * 1023 + 0.5) AS INTEGER) AS u, CAST(trunc(greatest(-1, least(1, v.x * 4)) * 127 + CASE WHEN greatest(-1, least(1, v.x * 4)) >= 0 THEN 0.5 ELSE -0.5 END) AS INTEGER) AS s FROM w JOIN v USING (pid)")
def unorm_snorm(spark, d):
    j = _w(spark, d).select("pid", "x").join(A.v(spark, d).select("pid", F.col("x").alias("vx")), "pid")
    return j.select("pid", grid.unorm(F.col("x"), 10).alias("u"), grid.snorm(F.col("vx") * 4, 8).alias("s"))


_PAIR = "p AS (SELECT a.pid, a.x AS ax, a.y AS ay, a.z AS az, b.x AS bx, b.y AS by_, b.z AS bz FROM v a JOIN v b ON b.pid = a.pid + 1)"


def _pair(spark, d):
    a, b = A.v(spark, d), A.v(spark, d).selectExpr("pid - 1 pid", "x bx", "y by_", "z bz")
    return a.selectExpr("pid", "x ax", "y ay", "z az").join(b, "pid"), vec.vec("ax", "ay", "az"), vec.vec("bx", "by_", "bz")


@query("vec_ops", f"WITH {A.V}, {_PAIR} SELECT pid, ax * bx + ay * by_ + az * bz AS dot, ay * bz - az * by_ AS cross_x, az * bx - ax * bz AS cross_y, ax * by_ - ay * bx AS cross_z, sqrt(ax * ax + ay * ay + az * az) AS norm, greatest(ax, bx) AS max_x, least(ay, by_) AS min_y, abs(az) AS abs_z, ax + bx AS add_x, ay - by_ AS sub_y, az * 2.5 AS scale_z, ax / 3 AS div_x FROM p")
def vec_ops(spark, d):
    p, a, b = _pair(spark, d)
    c = vec.cross(a, b)
    return p.select("pid", vec.dot(a, b).alias("dot"), *[e.alias(f"cross_{k}") for e, k in zip(c, "xyz", strict=True)], vec.norm(a).alias("norm"), vec.vmax(a, b)[0].alias("max_x"), vec.vmin(a, b)[1].alias("min_y"), vec.vabs(a)[2].alias("abs_z"), vec.add(a, b)[0].alias("add_x"), vec.sub(a, b)[1].alias("sub_y"), vec.scale(a, 2.5)[2].alias("scale_z"), vec.divide(a, 3)[0].alias("div_x"))


@query("quat_ops", f"WITH {A.V}, {_PAIR}, q AS (SELECT *, 1 - ax * ax AS aw, 1 + bx * bx AS bw FROM p) SELECT pid, round(aw * bx + ax * bw + ay * bz - az * by_, 9) AS mx, round(aw * by_ + ay * bw + az * bx - ax * bz, 9) AS my, round(aw * bz + az * bw + ax * by_ - ay * bx, 9) AS mz, round(aw * bw - (ax * bx + ay * by_ + az * bz), 9) AS mw, round(-ax / (ax * ax + ay * ay + az * az + aw * aw), 9) AS inv_x, round(sqrt(ax * ax + ay * ay + az * az + aw * aw), 9) AS norm FROM q")
def quat_ops(spark, d):
    p, a, b = _pair(spark, d)
    qa, qb = (*a, 1 - a[0] * a[0]), (*b, 1 + b[0] * b[0])
    m = vec.qmul(qa, qb)
    return p.select("pid", *[F.round(e, 9).alias(f"m{k}") for e, k in zip(m, "xyzw", strict=True)], F.round(vec.inv(qa)[0], 9).alias("inv_x"), F.round(vec.norm(qa), 9).alias("norm"))


_SLERP = "u AS (SELECT *, sqrt(ax * ax + ay * ay + az * az + 1) AS n FROM p), h AS (SELECT pid, ax / n AS x, ay / n AS y, az / n AS z, 1 / n AS w FROM u), o AS (SELECT *, acos(greatest(-1, least(1, w))) AS om FROM h)"


@query("quat_slerp", f"WITH {A.V}, {_PAIR}, {_SLERP} SELECT pid, round(CASE WHEN sin(om) <> 0 THEN sin(0.25 * om) / sin(om) ELSE 0.25 END * x, 9) AS x, round(cos(0.25 * om), 9) AS w FROM o")
def quat_slerp(spark, d):
    p, a, _ = _pair(spark, d)
    n = F.sqrt(vec.dot(a, a) + 1)
    q = (*vec.divide(a, n), 1 / n)
    one = vec.lift((0, 0, 0, 1))
    s = vec.slerp(one, q, F.lit(0.25))
    return p.select("pid", F.round(s[0], 9).alias("x"), F.round(s[3], 9).alias("w"))


@query("great_circle", f"WITH {A.V}, {_PAIR}, u AS (SELECT pid, ax / sqrt(ax * ax + ay * ay + az * az) AS x, ay / sqrt(ax * ax + ay * ay + az * az) AS y, az / sqrt(ax * ax + ay * ay + az * az) AS z FROM p) SELECT pid, round(-y * (0.5 / sqrt((1 + z) / 2)), 9) AS qx, round(x * (0.5 / sqrt((1 + z) / 2)), 9) AS qy, round(sqrt((1 + z) / 2), 9) AS qw FROM u")
def great_circle(spark, d):
    p, a, _ = _pair(spark, d)
    q = vec.great_circle(vec.lift(vec.Z_AXIS), vec.normalized(a))
    return p.select("pid", F.round(q[0], 9).alias("qx"), F.round(q[1], 9).alias("qy"), F.round(q[3], 9).alias("qw"))


@query("ray_plane", f"WITH {A.V}, {_PAIR} SELECT pid, round(alpha * bx + beta * ax, 9) AS px, round(alpha * by_ + beta * ay, 9) AS py, round(alpha * bz + beta * az, 9) AS pz, round(alpha, 9) AS pw FROM (SELECT *, az AS alpha, 0.5 - bz AS beta FROM p)")
def ray_plane(spark, d):
    p, a, b = _pair(spark, d)
    pl = vec.plane(vec.lift(vec.Z_AXIS), vec.lift((0, 0, 0.5)))
    h = vec.ray_plane(b, a, pl)
    return p.select("pid", *[F.round(c, 9).alias(n) for c, n in zip(h, ("px", "py", "pz", "pw"), strict=True)])


@query("triangle_normals", f"WITH {A.V}, {_PAIR} SELECT pid, round((ay * bz - az * by_) / sqrt((ay * bz - az * by_) ** 2 + (az * bx - ax * bz) ** 2 + (ax * by_ - ay * bx) ** 2), 9) AS nx FROM p")
def triangle_normals(spark, d):
    p, a, b = _pair(spark, d)
    return p.select("pid", F.round(vec.triangle_normal(vec.lift(vec.ZERO), a, b)[0], 9).alias("nx"))


@query("boundary_counts", f"WITH {A.VTX}, {A.TRI}, {A.HE} SELECT count(DISTINCT src) AS boundary FROM he a WHERE NOT EXISTS (SELECT 1 FROM he b WHERE b.src = a.dst AND b.dst = a.src)")
def boundary_counts(spark, d):
    return mesh.boundary_vertices(A.triangles(spark, d)).agg(F.count("*").alias("boundary"))


@query("position_hash", f"WITH {A.PTS}, b AS (SELECT pid, (x + 20000) * 40503 % 4294967296 AS p, (y + 20000) * 30011 % 4294967296 AS q, z % 4294967296 AS r FROM pts) SELECT pid, xor(xor(((xor(p, p >> 17)) * 73856093) & 4294967295, ((xor(q, q >> 17)) * 19349663) & 4294967295), ((xor(r, r >> 17)) * 83492791) & 4294967295) AS hash FROM b")
def position_hash(spark, d):
    b = A.pts(spark, d).selectExpr("pid", "(x + 20000) * 40503 % 4294967296 p", "(y + 20000) * 30011 % 4294967296 q", "z % 4294967296 r")
    return b.select("pid", hashing.position_hash((F.col("p"), F.col("q"), F.col("r"))).alias("hash"))


@query("mix_hash", f"WITH {A.PTS}, b AS (SELECT pid, (z * 1540483477) & 4294967295 AS k FROM pts), c AS (SELECT pid, (xor(k, k >> 24) * 1540483477) & 4294967295 AS k FROM b) SELECT pid, xor((pid * 1540483477) & 4294967295, k) AS hash FROM c")
def mix_hash(spark, d):
    return A.pts(spark, d).select("pid", hashing.mix32(F.col("pid"), F.col("z")).alias("hash"))
