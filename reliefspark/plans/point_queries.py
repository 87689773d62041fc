"""Point, flight-line and raster queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as A
from ..operators import flightlines, points, raster
from .registry import query

# The world box of the tile (0, 1) and its halo, in metres.
BOX = (-50.0, 1050.0, -100.0, 1000.0)


@query("point_filter_ground", f"WITH {A.PTS} SELECT pid, x, y, z, classification FROM pts WHERE x * CAST(0.01 AS DOUBLE) BETWEEN -50 AND 1050 AND y * CAST(0.01 AS DOUBLE) BETWEEN -100 AND 1000 AND CASE WHEN z * CAST(0.01 AS DOUBLE) < 200 THEN classification IN (2, 9) ELSE classification <= 9 END")
def point_filter_ground(spark, d):
    return points.filter_ground(A.pts(spark, d), BOX, high=200.0).select("pid", "x", "y", "z", "classification")


@query("point_filter_local", f"WITH {A.PTS} SELECT pid, x, y, z FROM pts WHERE x > -10000 AND x < 110000 AND y > -10000 AND y < 110000 AND classification = 2")
def point_filter_local(spark, d):
    return points.filter_local(A.pts(spark, d)).select("pid", "x", "y", "z")


_AROUND = "CROSS JOIN (VALUES (-1), (0), (1)) AS a(dx) CROSS JOIN (VALUES (-1), (0), (1)) AS b(dy)"


@query("tile_neighbours", f"WITH {A.TILES} SELECT t.tile_x, t.tile_y, dx, dy, o.area FROM tiles t {_AROUND} JOIN tiles o ON o.tile_x = t.tile_x + dx AND o.tile_y = t.tile_y + dy")
def tile_neighbours(spark, d):
    return points.neighbours(A.tiles(spark, d)).select("tile_x", "tile_y", "dx", "dy", "area")


@query("rebase_neighbours", f"WITH {A.PTS}, own AS (SELECT *, CAST(pid % 3 AS INTEGER) - 1 AS dx, CAST((pid // 3) % 3 AS INTEGER) - 1 AS dy FROM pts) SELECT pid, dx, dy, x + dx * 100000 AS x, y + dy * 100000 AS y FROM own")
def rebase_neighbours(spark, d):
    own = A.pts(spark, d).withColumns({"dx": F.expr("cast(pid % 3 as int) - 1"), "dy": F.expr("cast((pid div 3) % 3 as int) - 1")})
    return points.rebase(own).select("pid", "dx", "dy", "x", "y")


@query("tile_bbox", f"WITH {A.TILES} SELECT tile_x, tile_y, tile_x * 1000 - 100 AS min_x, tile_x * 1000 + 1100 AS max_x, tile_y * 1000 - 1100 AS min_y, tile_y * 1000 + 100 AS max_y, -1000 AS min_z, 9000 AS max_z FROM tiles")
def tile_bbox(spark, d):
    return points.tile_box(A.tiles(spark, d)).drop("area")


@query("source_encode", f"WITH {A.PTS}, f AS (SELECT source_id, min(pid) AS first_pid FROM pts GROUP BY 1) SELECT source_id, first_pid, row_number() OVER (ORDER BY first_pid) - 1 AS source_idx FROM f")
def source_encode(spark, d):
    return points.source_index(A.pts(spark, d))


_STATS = "SELECT source_id, count(*) AS n, least(90, min(scan_angle)) AS min_angle, greatest(-90, max(scan_angle)) AS max_angle, min(gps_time) AS min_gps, max(gps_time) AS max_gps FROM pts GROUP BY 1"


@query("source_stats", f"WITH {A.PTS} {_STATS}")
def source_stats(spark, d):
    return flightlines.source_stats(A.pts(spark, d))


_REPR = """CASE WHEN max_angle - min_angle <= 10 THEN (max_angle + min_angle) // 2
  WHEN min_angle + 5 <= 0 AND max_angle - 5 >= 0 THEN 0 WHEN min_angle + 5 >= 0 THEN min_angle + 5 ELSE max_angle - 5 END"""


@query("repr_angle", f"WITH {A.PTS}, s AS ({_STATS}) SELECT source_id, CAST({_REPR} AS INTEGER) AS repr_angle FROM s")
def repr_angle(spark, d):
    return flightlines.representative_angle(flightlines.source_stats(A.pts(spark, d))).select("source_id", "repr_angle")


_LINES = f"""s AS ({_STATS}), r AS (SELECT *, {_REPR} AS repr FROM s),
 j AS (SELECT p.*, r.n, repr, abs(p.scan_angle - repr) <= 2 AS along, abs(p.gps_time - (max_gps + min_gps) / 2) <= (max_gps - min_gps) / 100 AS across FROM pts p JOIN r USING (source_id)),
 e AS (SELECT source_id, max(n) AS n, first(struct_pack(x := x, y := y) ORDER BY gps_time, pid) FILTER (along) AS p0, first(struct_pack(x := x, y := y) ORDER BY gps_time DESC, pid) FILTER (along) AS p1,
  first(struct_pack(x := x, y := y) ORDER BY scan_angle, pid) FILTER (across AND scan_angle < 90) AS p2, first(struct_pack(x := x, y := y) ORDER BY scan_angle DESC, pid) FILTER (across AND scan_angle > -90) AS p3 FROM j GROUP BY 1),
 t AS (SELECT *, atan2(p1.y - p0.y, p1.x - p0.x) AS al, atan2(p3.y - p2.y, p3.x - p2.x) AS ac FROM e),
 fl AS (SELECT source_id, n, coalesce(p0 IS NOT NULL AND p1 IS NOT NULL AND p2 IS NOT NULL AND p3 IS NOT NULL AND p0 <> p1 AND p2 <> p3 AND abs(cos(al) * sin(ac) - cos(ac) * sin(al)) >= 0.5, false) AS is_valid, al, ac FROM t)"""


@query("flight_lines", f"WITH {A.PTS}, {_LINES} SELECT source_id, n, is_valid, CASE WHEN is_valid THEN round(al, 9) END AS theta_along, CASE WHEN is_valid THEN round(ac, 9) END AS theta_across FROM fl")
def flight_lines(spark, d):
    return flightlines.flight_lines(A.pts(spark, d)).withColumns({c: F.round(c, 9) for c in ("theta_along", "theta_across")})


@query("beam_join", f"WITH {A.PTS}, {_LINES} SELECT pid, source_id, is_valid, CASE WHEN is_valid THEN round(ac, 9) END AS theta_across FROM pts JOIN fl USING (source_id)")
def beam_join(spark, d):
    p = A.pts(spark, d)
    return flightlines.with_flight_lines(p, flightlines.flight_lines(p)).select("pid", "source_id", "is_valid", F.round("theta_across", 9).alias("theta_across"))


@query("z_extent", f"WITH {A.PTS} SELECT min(z) AS min_z, max(z) AS max_z FROM pts")
def z_extent(spark, d):
    return points.z_extent(A.pts(spark, d))


_T = "t AS (SELECT *, n / (n + CAST(2 AS DOUBLE)) AS scale, 1 / (n + CAST(2 AS DOUBLE)) AS shift_xy FROM (SELECT tile, min(z) AS lo, max(z) AS hi, CASE WHEN (max(z) - min(z)) * CAST(0.01 AS DOUBLE) < 1250 THEN 6 WHEN (max(z) - min(z)) * CAST(0.01 AS DOUBLE) < 1875 THEN 2 END AS n FROM tp GROUP BY 1)), u AS (SELECT *, 0.5 - round(16 * (CAST(0.5 AS DOUBLE) * (lo + hi) * CAST(1e-5 AS DOUBLE) * scale)) / 16 AS shift_z FROM t)"
_TP = "tp AS (SELECT pid, pid % 4 AS tile, x, y, z * (pid % 4 + 1) AS z FROM pts)"


def _tiled(spark, d):
    return A.pts(spark, d).select("pid", F.expr("pid % 4").alias("tile"), "x", "y", F.expr("z * (pid % 4 + 1)").alias("z"))


@query("unit_cube_transform", f"WITH {A.PTS}, {_TP}, {_T} SELECT tile, n, scale, shift_xy, shift_z FROM u")
def unit_cube_transform(spark, d):
    return points.unit_cube_transform(_tiled(spark, d), "tile")


_U = "c AS (SELECT pid, tile, x * CAST(1e-5 AS DOUBLE) * scale + shift_xy AS px, y * CAST(1e-5 AS DOUBLE) * scale + shift_xy AS py, z * CAST(1e-5 AS DOUBLE) * scale + shift_z AS pz, scale, shift_xy, shift_z FROM tp JOIN u USING (tile) WHERE n IS NOT NULL)"


def _cube(spark, d):
    t = _tiled(spark, d)
    return points.to_unit_cube(t, points.unit_cube_transform(t, "tile"), "tile")


@query("unit_cube", f"WITH {A.PTS}, {_TP}, {_T}, {_U} SELECT pid, tile, round(px, 12) AS px, round(py, 12) AS py, round(pz, 12) AS pz FROM c")
def unit_cube(spark, d):
    return _cube(spark, d).select("pid", "tile", *[F.round(c, 12).alias(c) for c in ("px", "py", "pz")])


@query("inverse_transform", f"WITH {A.PTS}, {_TP}, {_T}, {_U} SELECT pid, round((px - shift_xy) / scale, 9) AS kx, round((py - shift_xy) / scale, 9) AS ky, round((pz - shift_z) / scale, 9) AS kz FROM c")
def inverse_transform(spark, d):
    return points.from_unit_cube(_cube(spark, d)).select("pid", *[F.round(c, 9).alias(c) for c in ("kx", "ky", "kz")])


@query("metric_positions", f"WITH {A.PTS} SELECT pid, x * CAST(0.01 AS DOUBLE) AS mx, y * CAST(0.01 AS DOUBLE) AS my, z * CAST(0.01 AS DOUBLE) AS mz FROM pts")
def metric_positions(spark, d):
    return points.metric(A.pts(spark, d)).select("pid", "mx", "my", "mz")


_RP = "rp AS (SELECT px, py, CAST(((2 * px + 1) * 50000) // 50 AS BIGINT) AS x, CAST(((2 * (400 - py) - 1) * 50000) // 400 AS BIGINT) AS y, CAST(trunc(alt * 100) AS BIGINT) AS z FROM raster WHERE alt >= -500)"


def _raster_points(spark, d):
    return raster.raster_points(A.raster(spark, d), A.RASTER_NX, A.RASTER_NY)


@query("raster_points", f"WITH {A.RASTER}, {_RP} SELECT * FROM rp")
def raster_points(spark, d):
    return _raster_points(spark, d)


def _pix(c, n=120):
    return f"greatest(0, least({n - 1}, CAST(trunc(({c} + 10000) * CAST({n} AS DOUBLE) / CAST(120000 AS DOUBLE) - CAST(0.5 AS DOUBLE)) AS INTEGER)))"


_GRID = f"grid AS (SELECT {_pix('x')} AS gx, {_pix('y')} AS gy, count(*) AS count FROM pts GROUP BY 1, 2)"


@query("density_raster", f"WITH {A.PTS}, {_GRID} SELECT * FROM grid")
def density_raster(spark, d):
    return raster.density(A.pts(spark, d), 120)


@query("empty_pixels", f"WITH {A.PTS}, {_GRID} SELECT CAST(14400 AS BIGINT) - count(*) AS empty FROM grid")
def empty_pixels(spark, d):
    return raster.empty_pixels(raster.density(A.pts(spark, d), 120), 120)


@query("hole_fill", f"WITH {A.PTS}, {_GRID}, {A.RASTER}, {_RP} SELECT px, py, x, y, z FROM rp WHERE x BETWEEN -10000 AND 110000 AND y BETWEEN -10000 AND 110000 AND NOT EXISTS (SELECT 1 FROM grid WHERE gx = {_pix('x')} AND gy = {_pix('y')})")
def hole_fill(spark, d):
    return raster.hole_fill(_raster_points(spark, d), raster.density(A.pts(spark, d), 120), 120)


@query("boundary_ring", f"WITH {A.PTS}, m AS (SELECT min(z) AS lo, max(z) AS hi FROM pts), {A.RASTER}, {_RP}, w AS (SELECT px, py, 3 * x - 100000 AS x, y - 40000 AS y, z FROM rp) SELECT px, py, x, y, greatest(least(z, hi), lo) AS z FROM w, m WHERE x > -48000 AND x < 148000 AND y > -48000 AND y < 148000 AND NOT (x BETWEEN -10000 AND 110000 AND y BETWEEN -10000 AND 110000)")
def boundary_ring(spark, d):
    wide = _raster_points(spark, d).withColumns({"x": F.expr("3 * x - 100000"), "y": F.expr("y - 40000")})
    return raster.boundary_ring(wide, points.z_extent(A.pts(spark, d)))


@query("counting_sort", f"WITH {A.PTS} SELECT pid, source_id, row_number() OVER (ORDER BY source_id, pid) - 1 AS position FROM pts")
def counting_sort(spark, d):
    return points.counting_sort(A.pts(spark, d)).select("pid", "source_id", "position")


_Q = "q AS (SELECT pid, (pid % 1001) / CAST(1000 AS DOUBLE) AS qual, CAST(pid % 7 AS INTEGER) AS orient, sin(CAST(0 AS DOUBLE)) + (pid % 13) / CAST(13 AS DOUBLE) AS nx, (pid % 5) / CAST(5 AS DOUBLE) AS ny, CAST(1 AS DOUBLE) AS nz FROM pts)"


def _q(spark, d):
    return A.pts(spark, d).select("pid", F.expr("(pid % 1001) / 1000D").alias("qual"), F.expr("cast(pid % 7 as int)").alias("orient"), F.expr("(pid % 13) / 13D").alias("nx"), F.expr("(pid % 5) / 5D").alias("ny"), F.lit(1.0).alias("nz"))


@query("weight_normals", f"WITH {A.PTS}, {_Q} SELECT pid, CASE WHEN orient >= 3 THEN nx * qual ELSE 0 END AS nx, CASE WHEN orient >= 3 THEN nz * qual ELSE 0 END AS nz, CASE WHEN orient <> 1 THEN nx * qual ELSE 0 END AS nx_reached FROM q")
def weight_normals(spark, d):
    q = _q(spark, d)
    other = points.weight_normals(q, "reached").select("pid", F.col("nx").alias("nx_reached"))
    return points.weight_normals(q).select("pid", "nx", "nz").join(other, "pid")


@query("drop_unoriented", f"WITH {A.PTS}, {_Q} SELECT pid, orient FROM q WHERE orient >= 3")
def drop_unoriented(spark, d):
    return points.drop_unoriented(_q(spark, d)).select("pid", "orient")


@query("quality_rgb", f"WITH {A.PTS}, {_Q}, w AS (SELECT pid, qual, 1 - 2 * abs(qual - CAST(0.5 AS DOUBLE)) AS b FROM q) SELECT pid, CAST(floor(255 * CASE WHEN qual < 0.5 THEN 1 - b ELSE 0 END + 0.5) AS INTEGER) AS cr, CAST(floor(255 * CASE WHEN qual > 0.5 THEN 1 - b ELSE 0 END + 0.5) AS INTEGER) AS cg, CAST(floor(255 * b + 0.5) AS INTEGER) AS cb FROM w")
def quality_rgb(spark, d):
    return points.quality_rgb(_q(spark, d)).select("pid", "cr", "cg", "cb")


@query("dummy_corners", f"WITH {A.V} SELECT pid, x AS px, y AS py, z AS pz, CAST(1 AS DOUBLE) AS qual FROM v UNION ALL SELECT NULL, 0, 0, 0, 0 UNION ALL SELECT NULL, 1, 1, 1, 0")
def dummy_corners(spark, d):
    p = A.v(spark, d).select("pid", F.col("x").alias("px"), F.col("y").alias("py"), F.col("z").alias("pz"), *[F.lit(1.0).alias(c) for c in ("nx", "ny", "nz", "qual")])
    return points.add_corners(p).select("pid", "px", "py", "pz", "qual")


@query("translate_mesh", f"WITH {A.VTX} SELECT vid, x + 12.5 AS x, y - 3.25 AS y, z FROM vtx")
def translate_mesh(spark, d):
    return points.translate(A.vertices(spark, d), 12.5, -3.25)


@query("corner_required", f"WITH {A.PTS}, w AS (SELECT pid, greatest(0, least(1, (x - 5000) / CAST(90000 AS DOUBLE))) AS x, greatest(0, least(1, (y - 5000) / CAST(90000 AS DOUBLE))) AS y FROM pts) SELECT pid, (x IN (0, 1) AND (abs(y) < 0.05 OR abs(y - 1) < 0.05)) OR (y IN (0, 1) AND (abs(x) < 0.05 OR abs(x - 1) < 0.05)) AS required FROM w")
def corner_required(spark, d):
    unit = A.pts(spark, d).select("pid", *[F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(c) - 5000) / F.lit(90000.0))).alias(c) for c in "xy"])
    return points.corner_required(unit, 0.05).select("pid", "required")


_M = " + ".join(f"((({c} >> {b}) & 1) << {3 * b + k})" for k, c in enumerate(("a", "b", "c")) for b in range(10))


@query("morton_sort", f"WITH {A.V}, e AS (SELECT min(x) AS x0, min(y) AS y0, min(z) AS z0, 1 / greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS s FROM v), q AS (SELECT pid, CAST(floor((x - x0) * s * 1023 + 0.5) AS BIGINT) AS a, CAST(floor((y - y0) * s * 1023 + 0.5) AS BIGINT) AS b, CAST(floor((z - z0) * s * 1023 + 0.5) AS BIGINT) AS c FROM v, e) SELECT pid, {_M} AS code FROM q")
def morton_sort(spark, d):
    return points.spatial_order(A.v(spark, d)).select("pid", "code").orderBy("code", "pid")
