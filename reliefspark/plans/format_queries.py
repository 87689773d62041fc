"""Point and raster formats, cell hierarchies, the multigrid store and side-cars, written and read back."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from .. import adapters as A
from ..operators import grid
from ..sources import catalogue, files, las, meshes, multigrid, tiff
from .file_queries import _CELLS, _folder
from .registry import query

_ANGLE = "CASE WHEN f >= 6 THEN CAST(trunc(round(scan_angle / CAST(0.006 AS DOUBLE)) * 0.006) AS INTEGER) ELSE scan_angle END"


@query("las_formats", f"WITH {A.PTS}, fp AS (SELECT *, [1, 3, 6, 7, 8][1 + pid % 5] AS f FROM pts) SELECT f AS format, x, y, z, classification, {_ANGLE} AS scan_angle, CASE WHEN f >= 6 THEN (((pid % 4) << 14) | source_id) & 65535 ELSE source_id END AS source_id, gps_time, CAST(z % 1000 AS INTEGER) AS intensity, CAST(1 + pid % 3 AS INTEGER) AS return_number FROM fp")
def las_formats(spark, d):
    p = A.pts(spark, d).selectExpr("*", "cast(z % 1000 as int) intensity", "cast(1 + pid % 3 as int) return_number", "cast(3 as int) number_of_returns", "cast(pid % 4 as int) channel")
    out = None
    for k, f in enumerate((1, 3, 6, 7, 8)):
        made = [r["uri"] for r in las.write(p.filter(F.col("pid") % 5 == k).repartition(2, "pid"), _folder(spark, "las"), f, records=7000).collect()]
        rows = las.read(spark, made, records=3000).select(F.lit(f).alias("format"), "x", "y", "z", "classification", F.col("scan_angle").cast("int").alias("scan_angle"), "source_id", "gps_time", "intensity", F.col("return_number").cast("int").alias("return_number"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("laz_roundtrip", f"WITH {A.PTS}, fp AS (SELECT *, 6 AS f FROM pts) SELECT x, y, z, classification, {_ANGLE} AS scan_angle, (((pid % 4) << 14) | source_id) & 65535 AS source_id, gps_time, CAST(z % 1000 AS INTEGER) AS intensity, CAST(1 + pid % 3 AS INTEGER) AS return_number FROM fp")
def laz_roundtrip(spark, d):
    """Compressed files, read a chunk at a time."""
    p = A.pts(spark, d).selectExpr("*", "cast(z % 1000 as int) intensity", "cast(1 + pid % 3 as int) return_number", "cast(3 as int) number_of_returns", "cast(pid % 4 as int) channel")
    made = [r["uri"] for r in las.write(p.repartition(4, "pid"), _folder(spark, "laz"), compressed=True).collect()]
    return las.read(spark, made).select("x", "y", "z", "classification", F.col("scan_angle").cast("int").alias("scan_angle"), "source_id", "gps_time", "intensity", F.col("return_number").cast("int").alias("return_number"))


_INSIDE = (20000.0, 5000.0, 0.0, 40000.0, 30000.0, 20000.0)


@query("copc_load_inside", f"WITH {A.PTS}, lp AS (SELECT *, CAST(pid % 5 AS INTEGER) AS level FROM pts), b AS (SELECT *, 131072 / power(2, level) AS w, floor((x + 10000) * power(2, level) / 131072) AS cx, floor((y + 10000) * power(2, level) / 131072) AS cy, floor(z * power(2, level) / 131072) AS cz FROM lp) SELECT x, y, z, gps_time, classification FROM b WHERE cx * w - 10000 <= 40000 AND (cx + 1) * w - 10000 >= 20000 AND cy * w - 10000 <= 30000 AND (cy + 1) * w - 10000 >= 5000 AND cz * w <= 20000 AND (cz + 1) * w >= 0")
def copc_load_inside(spark, d):
    """The points of all cells that meet a box, from COPC files that hold each point at one level."""
    at = _folder(spark, "copc")
    p = A.pts(spark, d).withColumn("level", F.expr("cast(pid % 5 as int)"))
    f = F.pow(F.lit(2.0), F.col("level")) / 131072
    p = p.withColumns({"cx": F.floor((F.col("x") + 10000) * f), "cy": F.floor((F.col("y") + 10000) * f), "cz": F.floor(F.col("z") * f), "file": F.col("pid") % 3})

    def put(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cells, chunks = [], []
        for cell, own in rows.groupby(["level", "cx", "cy", "cz"], sort=True):
            cells.append((*map(int, cell), len(own)))
            chunks.append({c: own[c].to_numpy() for c in ("x", "y", "z", "classification", "scan_angle", "source_id", "gps_time")})
        uri = f"{at}/{key[0]}-{TaskContext.get().taskAttemptId()}.copc.laz"
        files.write(uri, las.encode_copc((55536.0, 55536.0, 65536.0), 65536.0, cells, len(rows), chunks=chunks))
        return pd.DataFrame({"uri": [uri]})

    uris = [r["uri"] for r in p.groupBy("file").applyInPandas(put, "uri string").collect()]
    cells = las.cells_inside(las.copc_table(spark, uris), (55536.0, 55536.0, 65536.0), 65536.0, _INSIDE)
    return las.read_cells(cells).select("x", "y", "z", "gps_time", "classification")


@query("las_vlrs", f"WITH {A.TILES}, r AS (SELECT tile_x, tile_y, min(area) AS area FROM tiles GROUP BY ALL) SELECT CAST(tile_x * 10 + tile_y AS BIGINT) AS record_id, 'area' AS user_id, false AS extended, CAST(strlen(area) AS BIGINT) AS length, area AS text FROM r UNION ALL SELECT CAST(tile_x * 10 + tile_y AS BIGINT), 'tile', false, CAST(strlen(concat(tile_x, '_', tile_y)) AS BIGINT), concat(tile_x, '_', tile_y) FROM r UNION ALL SELECT CAST(tile_x * 10 + tile_y AS BIGINT), 'long', true, CAST(1000 * strlen(area) AS BIGINT), area FROM r")
def las_vlrs(spark, d):
    at = _folder(spark, "vlr")

    def put(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x, y = map(int, key)
        area, uri = rows["area"].min(), f"{at}/{x}_{y}-{TaskContext.get().taskAttemptId()}.las"
        one = {c: np.array([1]) for c in ("x", "y", "z", "classification", "scan_angle", "source_id", "gps_time")}
        files.write(uri, las.encode(one, fmt=6, vlrs=[("area", 10 * x + y, area.encode()), ("tile", 10 * x + y, f"{x}_{y}".encode())], evlrs=[("long", 10 * x + y, area.encode() * 1000)]))
        return pd.DataFrame({"uri": [uri]})

    uris = [r["uri"] for r in A.tiles(spark, d).groupBy("tile_x", "tile_y").applyInPandas(put, "uri string").collect()]
    v = las.vlrs(spark, uris)
    text = F.col("data").cast("string")
    return v.select("record_id", "user_id", "extended", "length", F.when(F.col("extended"), F.substring(text, F.lit(1), F.expr("cast(length div 1000 as int)"))).otherwise(text).alias("text"))


_COPC = f"{_CELLS}, cc AS (SELECT level, CAST(floor((x + 10000) * power(2, level) / 131072) AS BIGINT) AS x, CAST(floor((y + 10000) * power(2, level) / 131072) AS BIGINT) AS y, CAST(floor(z * power(2, level) / 131072) AS BIGINT) AS z, count(*) AS point_count FROM pts, lv GROUP BY ALL)"


def _copc(spark, d):
    """COPC files, one a quarter of level 1, and their cells: every level holds all points once."""
    at = _folder(spark, "copc")
    p = A.pts(spark, d).withColumn("level", F.explode(F.array(*map(F.lit, range(5)))))
    f = F.pow(F.lit(2.0), F.col("level")) / 131072
    cells = p.groupBy("level", F.floor((F.col("x") + 10000) * f).alias("cx"), F.floor((F.col("y") + 10000) * f).alias("cy"), F.floor(F.col("z") * f).alias("cz")).agg(F.count("*").alias("n"))

    def put(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        uri = f"{at}/{key[0]}-{TaskContext.get().taskAttemptId()}.copc.laz"
        entries = sorted(map(tuple, rows[["level", "cx", "cy", "cz", "n"]].to_numpy().tolist()))
        files.write(uri, las.encode_copc((55536.0, 55536.0, 65536.0), 65536.0, entries, int(rows["n"].sum())))
        return pd.DataFrame({"uri": [uri]})

    quarter = F.when(F.col("level") == 0, 0).otherwise(F.expr("cast(floor(cx / power(2, level - 1)) + 2 * floor(cy / power(2, level - 1)) as int)"))
    return [r["uri"] for r in cells.withColumn("quarter", quarter).groupBy("quarter").applyInPandas(put, "uri string").collect()]


@query("copc_hierarchy", f"WITH {_COPC} SELECT CAST(level AS BIGINT) AS level, x, y, z, point_count, CAST(65536 AS DOUBLE) AS half FROM cc")
def copc_hierarchy(spark, d):
    return las.copc_table(spark, _copc(spark, d)).select("level", "x", "y", "z", "point_count", "half")


@query("copc_bound_inside", f"WITH {_COPC}, b AS (SELECT *, 131072 / power(2, level) AS w FROM cc) SELECT CAST(sum(point_count) AS BIGINT) AS points FROM b WHERE x * w - 10000 <= 40000 AND (x + 1) * w - 10000 >= 20000 AND y * w - 10000 <= 30000 AND (y + 1) * w - 10000 >= 5000 AND z * w <= 20000 AND (z + 1) * w >= 0")
def copc_bound_inside(spark, d):
    return las.bound_inside(las.copc_table(spark, _copc(spark, d)), (55536.0, 55536.0, 65536.0), 65536.0, _INSIDE)


@query("las_detection", f"WITH {A.PTS} SELECT true AS copc, true AS compressed, '1.4' AS version, CAST(6 AS BIGINT) AS format, CAST(5 * count(*) AS BIGINT) AS points FROM pts UNION ALL SELECT false, false, '1.2', 1, count(*) FROM pts UNION ALL SELECT false, false, '1.4', 7, count(*) FROM pts")
def las_detection(spark, d):
    uris = _copc(spark, d)
    for f in (1, 7):
        uris += [r["uri"] for r in las.write(A.pts(spark, d).repartition(2, "pid"), _folder(spark, "las"), f).collect()]
    return las.headers(spark, uris).groupBy("copc", "compressed", "version", "format").agg(F.sum("count").alias("points"))


@query("tiff_raster", f"WITH {A.RASTER} SELECT px, py, CAST(CAST(alt AS FLOAT) AS DOUBLE) AS alt FROM raster WHERE alt > -500")
def tiff_raster(spark, d):
    """Rasters of 20 rows a file, with each predictor in turn, read back without the missing pixels."""
    at = _folder(spark, "tiff")

    def put(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a = np.full((20, A.RASTER_NX), -9999, np.float32)
        a[rows["py"] % 20, rows["px"]] = rows["alt"]
        uri = f"{at}/{key[0]}-{TaskContext.get().taskAttemptId()}.tif"
        files.write(uri, tiff.encode(a, predictor=1 + int(key[0]) % 3, rows=7))
        return pd.DataFrame({"uri": [uri]})

    made = [r["uri"] for r in A.raster(spark, d).withColumn("file", F.expr("py div 20")).groupBy("file").applyInPandas(put, "uri string").collect()]
    file = F.regexp_extract("path", r"/(\d+)-\d+\.tif$", 1).cast("int")
    return tiff.read(spark, made).filter("alt > -500").select("px", (F.col("py") + 20 * file).alias("py"), "alt")


@query("ply_aliases", f"WITH {A.VTX} SELECT vid, x, y, CAST(vid % 64 AS DOUBLE) / 64 AS u, CAST(vid % 32 AS DOUBLE) / 32 AS v, CAST(vid % 256 AS DOUBLE) AS r, CAST(vid % 7 AS DOUBLE) AS b FROM vtx")
def ply_aliases(spark, d):
    """Vertices under every alias of texture coordinates and colours, in ASCII files."""
    at = _folder(spark, "ply")
    names = [("u", "v", "r", "g", "b"), ("s", "t", "red", "green", "blue"), ("texture_u", "texture_v", "red", "green", "blue"), ("texture_s", "texture_t", "r", "g", "b")]

    def put(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        u, v, r, g, b = names[int(key[0]) % 4]
        head = ["ply", "format ascii 1.0", f"element vertex {len(rows)}", *[f"property double {c}" for c in ("x", "y", "z", u, v)], *[f"property uchar {c}" for c in (r, g, b)], "element face 0", f"property list uchar int {'vertex_index' if key[0] % 2 else 'vertex_indices'}", "end_header"]
        body = [f"{x} {y} {i} {i % 64 / 64} {i % 32 / 32} {i % 256} 0 {i % 7}" for i, x, y in zip(rows["vid"], rows["x"], rows["y"], strict=True)]
        uri = f"{at}/{key[0]}-{TaskContext.get().taskAttemptId()}.ply"
        files.write(uri, "\n".join([*head, *body, ""]).encode())
        return pd.DataFrame({"uri": [uri]})

    made = [r["uri"] for r in A.vertices(spark, d).withColumn("mesh_id", F.expr("vid div 3000")).groupBy("mesh_id").applyInPandas(put, "uri string").collect()]
    v = meshes.read(spark, made, "ply")[0]
    return v.select(F.col("z").cast("long").alias("vid"), "x", "y", "u", "v", "r", "b")


@query("polygon_ears", "WITH h AS (SELECT p_partkey // 8 AS polygon, CAST(p_partkey % 8 AS BIGINT) AS i, CAST(p_size AS BIGINT) AS h FROM part), n AS (SELECT *, lead(h) OVER (PARTITION BY polygon ORDER BY i) AS next FROM h) SELECT polygon, CAST(count(*) AS BIGINT) AS triangles, CAST(coalesce(sum(h + next), 0) AS BIGINT) AS twice_area FROM n GROUP BY 1")
def polygon_ears(spark, d):
    """Ridges (columns of height p_size over a flat foot) cut into triangles: their sizes add up only if none overlap."""

    def cut(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i", ascending=False)
        x, h = rows["i"].to_numpy(float), rows["h"].to_numpy(float)
        pos = np.stack([np.concatenate([[x[-1], x[0]], x]), np.concatenate([[0, 0], h]), np.zeros(len(x) + 2)], 1)
        t = np.array(meshes.triangulate(list(range(len(pos))), pos)).reshape(-1, 3)
        a = np.cross(pos[t[:, 1]] - pos[t[:, 0]], pos[t[:, 2]] - pos[t[:, 0]])
        return pd.DataFrame({"polygon": [key[0]], "triangles": [len(t)], "twice_area": [int(np.abs(a[:, 2]).sum())]})

    p = A.table(spark, d, "part").selectExpr("p_partkey div 8 polygon", "p_partkey % 8 i", "p_size h")
    return p.groupBy("polygon").applyInPandas(cut, "polygon long, triangles long, twice_area long")


_UNIT = f"WITH {A.VTX}, {A.TRI}, uv AS (SELECT vid, x / 128 AS x, y / 2048 AS y, round(z / 64) / 16384 AS z FROM vtx)"
_UTRI = "ut AS (SELECT tid, least(7, greatest(0, floor((a.x + b.x + c.x) / 3 * 8)))::INTEGER AS nx, least(7, greatest(0, floor((a.y + b.y + c.y) / 3 * 8)))::INTEGER AS ny, i0, i1, i2 FROM tri JOIN uv a ON i0 = a.vid JOIN uv b ON i1 = b.vid JOIN uv c ON i2 = c.vid)"
_UCOR = """uc AS (SELECT tid, 0 AS k, nx, ny, x, y, z FROM ut JOIN uv ON i0 = vid UNION ALL SELECT tid, 1, nx, ny, x, y, z FROM ut JOIN uv ON i1 = vid UNION ALL SELECT tid, 2, nx, ny, x, y, z FROM ut JOIN uv ON i2 = vid),
 us AS (SELECT nx, ny, CAST(2 * floor(100000 * min(z) / 2) AS BIGINT) AS shift_z FROM uc GROUP BY ALL),
 uq AS (SELECT tid, k, nx, ny, shift_z, CAST(trunc((x - nx / 8.0::DOUBLE) * 262144 + 16384) AS INTEGER) AS ux, CAST(trunc((y - ny / 8.0::DOUBLE) * 262144 + 16384) AS INTEGER) AS uy, CAST(floor((100000 * z - shift_z) / 2) AS INTEGER) AS uz FROM uc JOIN us USING (nx, ny)),
 uw AS (SELECT nx, ny, shift_z, ux, uy, uz, min(3 * tid + k) AS first FROM uq GROUP BY ALL),
 un AS (SELECT *, row_number() OVER (PARTITION BY nx, ny ORDER BY first) - 1 AS vid FROM uw),
 uf AS (SELECT q.nx, q.ny, tid, max(vid) FILTER (k = 0) AS i0, max(vid) FILTER (k = 1) AS i1, max(vid) FILTER (k = 2) AS i2 FROM uq q JOIN un USING (nx, ny, ux, uy, uz) GROUP BY ALL),
 ug AS (SELECT * FROM uf WHERE i0 <> i1 AND i1 <> i2 AND i2 <> i0)"""
_CELLS2D = f"{_UNIT}, {_UTRI}, {_UCOR}"


def _unit(spark, d):
    v = A.vertices(spark, d).select("vid", (F.col("x") / 128).alias("x"), (F.col("y") / 2048).alias("y"), (F.round(F.col("z") / 64) / 16384).alias("z"))
    return grid.cells2d(v, A.triangles(spark, d), 3)


@query("cells_2d", f"{_CELLS2D}, v AS (SELECT nx, ny, shift_z, count(*) AS vtx_count, min(ux) AS min_ux, max(ux) AS max_ux, min(uy) AS min_uy, max(uy) AS max_uy, min(uz) AS min_uz, max(uz) AS max_uz FROM un GROUP BY ALL), t AS (SELECT nx, ny, 3 * count(*) AS idx_count FROM ug GROUP BY ALL) SELECT 0 AS lod, 2 AS scale_z, v.*, coalesce(idx_count, 0) AS idx_count FROM v LEFT JOIN t USING (nx, ny)")
def cells_2d(spark, d):
    return _unit(spark, d)[0]


def _store(spark, d):
    at = _folder(spark, "multigrid")
    info, v, t = _unit(spark, d)
    multigrid.write({"cells": info, "vertices": v, "triangles": t}, at)
    return at


_BLOCK = "nx BETWEEN 1 AND 4 AND ny BETWEEN 0 AND 3"


@query("multigrid_block", f"{_CELLS2D} SELECT nx, ny, vid, (ux - 16384 + (nx - 3) * 32768) / 65536.0::DOUBLE AS x, (uy - 16384 + (ny - 2) * 32768) / 65536.0::DOUBLE AS y, (uz * 2 + shift_z) / 200000.0::DOUBLE AS z FROM un WHERE {_BLOCK}")
def multigrid_block(spark, d):
    return multigrid.load_block(spark, _store(spark, d), 0, 3, 2)[0]


@query("multigrid_cells", f"{_CELLS2D} SELECT nx, ny, tid, i0, i1, i2 FROM ug WHERE {_BLOCK}")
def multigrid_cells(spark, d):
    return multigrid.load_block(spark, _store(spark, d), 0, 3, 2)[1]


@query("multigrid_update", f"{_CELLS2D}, a AS (SELECT 0 AS lod, nx, ny, vid, CASE WHEN nx = 2 AND ny = 1 THEN ux + 1 ELSE ux END AS ux, uy, uz FROM un UNION ALL SELECT 1, nx // 2, ny // 2, vid, ux, uy, uz FROM un WHERE nx % 2 = 0 AND ny % 2 = 0) SELECT lod, nx, ny, count(*) AS vertices, CAST(sum(ux) AS BIGINT) AS ux, CAST(sum(uy) AS BIGINT) AS uy, CAST(sum(uz) AS BIGINT) AS uz FROM a GROUP BY ALL")
def multigrid_update(spark, d):
    """One cell replaced and a further level appended."""
    at = _store(spark, d)
    v = _unit(spark, d)[1]
    multigrid.update({"vertices": v.filter("nx = 2 AND ny = 1").withColumn("ux", F.col("ux") + 1)}, at)
    multigrid.update({"vertices": v.filter("nx % 2 = 0 AND ny % 2 = 0").selectExpr("1 AS lod", "cast(nx div 2 as int) nx", "cast(ny div 2 as int) ny", "vid", "ux", "uy", "uz", "shift_z", "scale_z")}, at)
    return multigrid.read(spark, at, "vertices").groupBy("lod", "nx", "ny").agg(F.count("*").alias("vertices"), *[F.sum(c).alias(c) for c in ("ux", "uy", "uz")])


@query("tile_transforms", f"WITH {A.TILES}, t AS (SELECT DISTINCT tile_x, tile_y FROM tiles), w AS (SELECT tile_x, tile_y, 1 / (3.0::DOUBLE + tile_x) AS scale, tile_x * 1000.13::DOUBLE AS shift_xy, -1234.5678::DOUBLE * (tile_y + 1) AS shift_z FROM t) SELECT CAST(tile_x AS INTEGER) AS tile_x, CAST(tile_y AS INTEGER) AS tile_y, CAST(printf('%.5e', scale) AS DOUBLE) AS scale, CAST(printf('%.5e', shift_xy) AS DOUBLE) AS shift_xy, CAST(printf('%.5e', shift_z) AS DOUBLE) AS shift_z FROM w")
def tile_transforms(spark, d):
    t = A.tiles(spark, d).select("tile_x", "tile_y").distinct()
    t = t.select("tile_x", "tile_y", (F.lit(1.0) / (F.lit(3.0) + F.col("tile_x"))).alias("scale"), (F.col("tile_x") * F.lit(1000.13)).alias("shift_xy"), (F.lit(-1234.5678) * (F.col("tile_y") + 1)).alias("shift_z"))
    at = _folder(spark, "transforms")
    catalogue.write_transforms(t, at)
    return catalogue.read_transforms(spark, at)


_NAMES = f"{A.TILES}, nm AS (SELECT tile_x, tile_y, concat('http://tiles/FXX_', lpad(CAST(tile_x AS VARCHAR), 4, '0'), '_', lpad(CAST(tile_y AS VARCHAR), 4, '0'), '_', area, '.laz') AS url FROM tiles)"


def _catalogue(spark, d):
    at = _folder(spark, "catalogue")
    A.tiles(spark, d).select(F.format_string("http://tiles/FXX_%04d_%04d_%s.laz", F.col("tile_x").cast("int"), F.col("tile_y").cast("int"), F.col("area"))).write.text(at)
    return catalogue.read(spark, at, r"FXX_(\d{4})_(\d{4})")


@query("tile_catalogue", f"WITH {_NAMES} SELECT CAST(tile_x AS INTEGER) AS tile_x, CAST(tile_y AS INTEGER) AS tile_y, url FROM nm")
def tile_catalogue(spark, d):
    return _catalogue(spark, d)


@query("tiles_missing", f"WITH {_NAMES} SELECT CAST(tile_x AS INTEGER) AS tile_x, CAST(tile_y AS INTEGER) AS tile_y, url FROM nm WHERE NOT (tile_x < 2 AND tile_y > 0)")
def tiles_missing(spark, d):
    return catalogue.missing(_catalogue(spark, d), A.tiles(spark, d).filter("tile_x < 2 AND tile_y > 0")).select("tile_x", "tile_y", "url")


@query("tiles_on_line", f"WITH {A.TILES}, k AS (SELECT DISTINCT tile_x, tile_y FROM tiles), n AS (SELECT tile_x, tile_y, concat(tile_x, '_', tile_y, CASE WHEN tile_x % 2 = 0 THEN '.final.ply' ELSE '.ply' END) AS name FROM k) SELECT tile_x, CAST(tile_y AS INTEGER) AS tile_y, name FROM n WHERE tile_y - tile_x = 1 AND contains(name, 'final.ply')")
def tiles_on_line(spark, d):
    t = A.tiles(spark, d).select("tile_x", "tile_y").distinct()
    return catalogue.on_line(t.withColumn("name", F.concat_ws("_", "tile_x", "tile_y")).withColumn("name", F.concat("name", F.when(F.col("tile_x") % 2 == 0, ".final.ply").otherwise(".ply"))), 1)


@query("stage_cache", f"WITH {A.PTS} SELECT classification, count(*) AS n FROM pts GROUP BY 1")
def stage_cache(spark, d):
    """The second call finds the first one's table and runs nothing."""
    at = _folder(spark, "stage")
    catalogue.staged(spark, at, lambda: A.pts(spark, d).groupBy("classification").agg(F.count("*").alias("n")))

    def again():
        raise AssertionError("the stage ran twice")

    return catalogue.staged(spark, at, again)


@query("lod_mesh_counts", f"""WITH {A.VTX}, {A.TRI}, lv AS (SELECT unnest([0, 1, 2, 3]) AS lod), zv AS (SELECT vid, x, y, round(z / 1000) / 64 AS z FROM vtx),
 cell AS (SELECT lod, tid, floor(((a.x + b.x + c.x) / 3 + 0.5) / (16 * power(2, lod))) AS cx, floor(((a.y + b.y + c.y) / 3 + 0.5) / (16 * power(2, lod))) AS cy, floor(((a.z + b.z + c.z) / 3 - 4) / (16 * power(2, lod))) AS cz, i0, i1, i2 FROM tri JOIN zv a ON i0 = a.vid JOIN zv b ON i1 = b.vid JOIN zv c ON i2 = c.vid, lv),
 m AS (SELECT lod, cx, cy, cz, count(*) AS triangles FROM cell GROUP BY ALL), u AS (SELECT lod, cx, cy, cz, count(DISTINCT vid) AS vertices FROM (SELECT lod, cx, cy, cz, unnest([i0, i1, i2]) AS vid FROM cell) GROUP BY ALL)
 SELECT lod, count(*) AS cells, CAST(sum(triangles) AS BIGINT) AS triangles, CAST(sum(vertices) AS BIGINT) AS vertices FROM m JOIN u USING (lod, cx, cy, cz) GROUP BY 1""")
def lod_mesh_counts(spark, d):
    """Triangles and vertices of each level of a grid whose cells double; border vertices count in each of their cells."""
    v, t = A.vertices(spark, d).withColumn("z", F.round(F.col("z") / 1000) / 64), A.triangles(spark, d)
    out = None
    for lod in range(4):
        stats = grid.cell_stats(v, t, grid.partition(v, t, (-0.5, -0.5, 4.0), 16.0 * 2**lod)).select(F.lit(lod).alias("lod"), "triangles", "vertices")
        out = stats if out is None else out.unionByName(stats)
    return grid.level_counts(out)


def _float(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


_E = "CASE WHEN a >= power({two}, floor(log2(a)) + 1) THEN floor(log2(a)) + 1 WHEN a < power({two}, floor(log2(a))) THEN floor(log2(a)) - 1 ELSE floor(log2(a)) END".format(two=_float(2.0))
_SINGLE = f"{A.V}, g AS (SELECT pid, x * m AS x, abs(x * m) AS a, m FROM v, (SELECT unnest([{_float(1.0)}, {_float(1000.0)}, {_float(1e-5)}, {_float(3e5)}]) AS m)), e AS (SELECT *, {_E} AS e FROM g WHERE a > 0)"


@query("short_floats", f"WITH {_SINGLE} SELECT pid, m, CAST(CASE WHEN a < {_float(2.0**-14)} THEN 0 WHEN a >= 65536 THEN 31744 ELSE (e + 15) * 1024 + floor(a * power({_float(2.0)}, 10 - e) + 0.5) - 1024 END + CASE WHEN x < 0 THEN 32768 ELSE 0 END AS INTEGER) AS half, floor(a / power({_float(2.0)}, e - 9) + 0.5) * power({_float(2.0)}, e - 9) * CASE WHEN x < 0 THEN -1 ELSE 1 END AS nine FROM e")
def short_floats(spark, d):
    g = A.v(spark, d).withColumn("m", F.explode(F.array(*map(F.lit, (1.0, 1000.0, 1e-5, 3e5))))).withColumn("x", F.col("x") * F.col("m")).filter("x <> 0")
    return g.select("pid", "m", grid.half(F.col("x")).alias("half"), grid.short_mantissa(F.col("x"), 9).alias("nine"))


@query("pass_all", f"WITH {A.PTS} SELECT pid, x, z FROM pts")
def pass_all(spark, d):
    from ..operators import points

    return points.pass_all(A.pts(spark, d)).select("pid", "x", "z")




def _obj_files(spark, d):
    """An OBJ file with groups and materials, and its material file, for each 2000 vertices."""
    at = _folder(spark, "obj")

    def put(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        m, out = int(key[0]), [f"mtllib {int(key[0])}.mtl"]
        rows = rows.sort_values("tid")
        low = int(rows["i0"].min())
        out += [f"v {v % 100} {v // 100} 0" for v in range(low, int(rows[["i0", "i1", "i2"]].to_numpy().max()) + 1)]
        last = None
        for t, a, b, c in zip(rows["tid"], rows["i0"], rows["i1"], rows["i2"], strict=True):
            if (a // 500, t % 2) != last:
                last = a // 500, t % 2
                out += [f"g row {a // 500}", f"usemtl m{t % 2}"]
            out.append(f"f {a - low + 1} {b - low + 1} {c - low + 1}")
        stem = f"{at}/{m}-{TaskContext.get().taskAttemptId()}"
        files.write(f"{stem}.obj", "\n".join(out).encode())
        files.write(f"{stem}.mtl", "".join(f"newmtl m{k}\n# a colour\nKd 0.{k + 1} 0.5 {m}\nNs {10 * m + k}\nTr 0.25\nmap_Kd -s 1 1 1 t{m}_{k}.png\n" for k in (0, 1)).encode())
        return pd.DataFrame({"obj": [f"{stem}.obj"], "mtl": [f"{stem}.mtl"]})

    made = A.triangles(spark, d).withColumn("mesh_id", F.expr("i0 div 2000")).groupBy("mesh_id").applyInPandas(put, "obj string, mtl string").collect()
    return [r["obj"] for r in made], [r["mtl"] for r in made]


_FILE = r"/(\d+)-\d+\.\w+$"


@query("obj_groups", f"WITH {A.TRI} SELECT i0 // 2000 AS mesh_id, concat('row ', i0 // 500) AS \"group\", concat('m', tid % 2) AS material, count(*) AS triangles FROM tri GROUP BY ALL")
def obj_groups(spark, d):
    parts = meshes.read_obj_parts(spark, _obj_files(spark, d)[0])
    return parts.groupBy(F.regexp_extract("path", _FILE, 1).cast("long").alias("mesh_id"), "group", "material").agg(F.count("*").alias("triangles"))


@query("obj_materials", f"WITH {A.TRI}, m AS (SELECT DISTINCT i0 // 2000 AS m FROM tri), k AS (SELECT unnest([0, 1]) AS k) SELECT m AS mesh_id, concat('m', k) AS name, (k + 1) / 10.0::DOUBLE AS red, CAST(m AS DOUBLE) AS blue, CAST(10 * m + k AS DOUBLE) AS shine, 0.75::DOUBLE AS opaque, concat('t', m, '_', k, '.png') AS picture FROM m, k")
def obj_materials(spark, d):
    m = meshes.read_materials(spark, _obj_files(spark, d)[1])
    return m.select(F.regexp_extract("path", _FILE, 1).cast("long").alias("mesh_id"), "name", F.col("colours")["Kd"][0].alias("red"), F.col("colours")["Kd"][2].alias("blue"), F.col("numbers")["Ns"].alias("shine"), F.col("numbers")["d"].alias("opaque"), F.col("textures")["map_Kd"].alias("picture"))
