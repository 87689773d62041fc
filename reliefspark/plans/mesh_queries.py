"""Mesh topology, identity, cleaning and grid queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapters as A
from ..operators import clean, grid, mesh, remap
from .registry import query

M = f"WITH {A.VTX}, {A.TRI}, {A.HE}"


def _v(spark, d):
    return A.vertices(spark, d)


def _t(spark, d):
    return A.triangles(spark, d)


@query("half_edges", f"{M} SELECT * FROM he")
def half_edges(spark, d):
    return mesh.half_edges(_t(spark, d))


@query("edge_lookup", f"{M} SELECT src, dst, max(eid) AS eid FROM he GROUP BY 1, 2")
def edge_lookup(spark, d):
    return mesh.edge_lookup(mesh.half_edges(_t(spark, d)))


@query("has_edge", f"{M} SELECT vid AS src, vid + 1 AS dst FROM vtx WHERE EXISTS (SELECT 1 FROM he WHERE src = vid AND dst = vid + 1)")
def has_edge(spark, d):
    pairs = _v(spark, d).select(F.col("vid").alias("src"), (F.col("vid") + 1).alias("dst"))
    return mesh.has_edge(pairs, mesh.half_edges(_t(spark, d)))


_D = "d2 AS (SELECT eid, least(src, dst) AS src, greatest(src, dst) AS dst FROM he)"


@query("next_edge", f"{M}, {_D} SELECT eid, src, dst, lag(eid) OVER (PARTITION BY src, dst ORDER BY eid) AS next_eid FROM d2")
def next_edge(spark, d):
    e = mesh.half_edges(_t(spark, d)).select("eid", F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return mesh.next_edge(e)


_ADJ = "adj AS (SELECT a.eid, a.tid, b.eid AS opposite FROM he a LEFT JOIN (SELECT src, dst, max(eid) AS eid FROM he GROUP BY 1, 2) b ON a.src = b.dst AND a.dst = b.src)"


@query("tri_adjacency", f"{M}, {_ADJ} SELECT * FROM adj")
def tri_adjacency(spark, d):
    return mesh.adjacency(_t(spark, d))


_BE = "be AS (SELECT * FROM he a WHERE NOT EXISTS (SELECT 1 FROM he b WHERE b.src = a.dst AND b.dst = a.src))"


@query("boundary_edges", f"{M}, {_BE} SELECT * FROM be")
def boundary_edges(spark, d):
    return mesh.boundary_edges(_t(spark, d)).select("eid", "tid", "src", "dst")


@query("boundary_vertices", f"{M}, {_BE} SELECT DISTINCT src AS vid FROM be")
def boundary_vertices(spark, d):
    return mesh.boundary_vertices(_t(spark, d))


@query("boundary_vertices_both", f"{M}, {_BE} SELECT src AS vid FROM be UNION SELECT dst FROM be")
def boundary_vertices_both(spark, d):
    return mesh.boundary_vertices(_t(spark, d), both_ends=True)


# The recursion keeps one row a triangle, its lowest root so far, and goes on with those that fell.
_CC = f"""WITH RECURSIVE {A.VTX}, {A.TRI},
 e AS (SELECT tid, least(i0, i1) AS a, greatest(i0, i1) AS b FROM tri UNION ALL SELECT tid, least(i1, i2), greatest(i1, i2) FROM tri UNION ALL SELECT tid, least(i2, i0), greatest(i2, i0) FROM tri),
 n AS MATERIALIZED (SELECT p.tid AS a, q.tid AS b FROM e p JOIN e q ON p.a = q.a AND p.b = q.b AND p.tid <> q.tid),
 reach(tid, root) USING KEY (tid) AS (SELECT tid, tid FROM tri UNION SELECT n.b, min(reach.root) FROM reach JOIN n ON n.a = reach.tid JOIN recurring.reach k ON k.tid = n.b WHERE reach.root < k.root GROUP BY n.b),
 parts AS (SELECT tid, dense_rank() OVER (ORDER BY root) - 1 AS component FROM reach)"""


@query("full_mesh_components", f"{_CC} SELECT tid, component FROM parts")
def full_mesh_components(spark, d):
    return mesh.components(_t(spark, d))


@query("component_sizes", f"{_CC} SELECT component, count(*) AS size FROM parts GROUP BY 1")
def component_sizes(spark, d):
    return mesh.component_sizes(mesh.components(_t(spark, d)))


@query("principal_component", f"{_CC}, s AS (SELECT component FROM parts GROUP BY 1 ORDER BY count(*) DESC, component LIMIT 1) SELECT tri.* FROM tri JOIN parts USING (tid) JOIN s USING (component)")
def principal_component(spark, d):
    t = _t(spark, d)
    return mesh.principal_component(t, mesh.components(t))


# Vertices with equal positions: x and y folded, z dropped to the fold.
_FV = "fv AS (SELECT vid, CAST(vid % 100 // 3 AS DOUBLE) AS x, CAST(vid // 100 // 2 AS DOUBLE) AS y, CAST(vid % 2 AS DOUBLE) AS z FROM vtx)"


def _fv(spark, d):
    return _v(spark, d).selectExpr("vid", "cast(vid % 100 div 3 as double) x", "cast(vid div 100 div 2 as double) y", "cast(vid % 2 as double) z")


@query("vertex_dedup", f"{M}, {_FV} SELECT vid, min(vid) OVER (PARTITION BY x, y, z) AS remap FROM fv")
def vertex_dedup(spark, d):
    return remap.dedup(_fv(spark, d))


_IDX = "idx AS (SELECT 3 * tid AS position, i0 AS vid FROM tri UNION ALL SELECT 3 * tid + 1, i1 FROM tri UNION ALL SELECT 3 * tid + 2, i2 FROM tri)"
_DENSE = f"{_FV}, {_IDX}, used AS (SELECT vid, min(position) AS position FROM idx GROUP BY 1), num AS (SELECT x, y, z, row_number() OVER (ORDER BY min(position)) - 1 AS remap FROM fv JOIN used USING (vid) GROUP BY x, y, z), dn AS (SELECT vid, CASE WHEN position IS NOT NULL THEN num.remap END AS remap FROM fv LEFT JOIN used USING (vid) LEFT JOIN num USING (x, y, z))"


@query("dense_remap", f"{M}, {_DENSE} SELECT * FROM dn")
def dense_remap(spark, d):
    return remap.dense(_fv(spark, d), _t(spark, d))


_APPLY = "ap AS (SELECT tid, a.remap AS i0, b.remap AS i1, c.remap AS i2 FROM tri JOIN dn a ON i0 = a.vid JOIN dn b ON i1 = b.vid JOIN dn c ON i2 = c.vid)"


@query("apply_remap", f"{M}, {_DENSE}, {_APPLY} SELECT * FROM ap")
def apply_remap(spark, d):
    t = _t(spark, d)
    return remap.apply(t, remap.dense(_fv(spark, d), t).filter("remap is not null"))


@query("mesh_concat", f"{M}, o AS (SELECT max(vid) + 1 AS dv FROM vtx), o2 AS (SELECT max(tid) + 1 AS dt FROM tri) SELECT * FROM tri UNION ALL SELECT tid + dt, i0 + dv, i1 + dv, i2 + dv FROM tri, o, o2")
def mesh_concat(spark, d):
    m = _v(spark, d), _t(spark, d)
    return remap.concat(m, m)[1]


@query("mesh_join_referenced", f"{M}, {_DENSE} SELECT DISTINCT remap AS vid, x, y, z FROM dn JOIN fv USING (vid) WHERE remap IS NOT NULL")
def mesh_join_referenced(spark, d):
    return remap.join_referenced(_fv(spark, d), _t(spark, d))[0]


@query("mesh_join_all", f"{M}, {_FV} SELECT row_number() OVER (ORDER BY min(vid)) - 1 AS vid, x, y, z FROM fv GROUP BY x, y, z")
def mesh_join_all(spark, d):
    return remap.join_all(_fv(spark, d), _t(spark, d))[0]


@query("child_parent_map", f"{M}, {_FV}, r AS (SELECT vid, min(vid) OVER (PARTITION BY x, y, z) AS remap FROM fv) SELECT a.vid, b.remap // 2 AS remap FROM r a JOIN r b ON a.remap = b.vid")
def child_parent_map(spark, d):
    r = remap.dedup(_fv(spark, d))
    return remap.compose(r, r.withColumn("remap", F.expr("remap div 2")))


@query("compact_mesh", f"{M}, {_DENSE}, {_APPLY} SELECT * FROM ap WHERE i0 <> i1 AND i1 <> i2 AND i2 <> i0")
def compact_mesh(spark, d):
    return clean.compact(_fv(spark, d), _t(spark, d))[1]


@query("skip_degenerate", f"{M}, {_FV}, r AS (SELECT vid, min(vid) OVER (PARTITION BY x, y, z) AS remap FROM fv) SELECT tri.* FROM tri JOIN r a ON i0 = a.vid JOIN r b ON i1 = b.vid JOIN r c ON i2 = c.vid WHERE a.remap <> b.remap AND b.remap <> c.remap AND c.remap <> a.remap")
def skip_degenerate(spark, d):
    return clean.drop_degenerate_positions(_fv(spark, d), _t(spark, d))


_P3 = "p3 AS (SELECT tid, a.x AS x0, a.y AS y0, a.z AS z0, b.x AS x1, b.y AS y1, b.z AS z1, c.x AS x2, c.y AS y2, c.z AS z2 FROM tri JOIN {v} a ON i0 = a.vid JOIN {v} b ON i1 = b.vid JOIN {v} c ON i2 = c.vid)"
_UV = "uv AS (SELECT vid, x / 100 AS x, (y % 100) / 100 AS y, z FROM vtx)"


def _uv(spark, d):
    return _v(spark, d).selectExpr("vid", "x / 100 x", "(y % 100) / 100 y", "z")


@query("recut_mesh", f"{M}, {_UV}, {_P3.format(v='uv')} SELECT tri.* FROM tri JOIN p3 USING (tid) WHERE (x0 + x1 + x2) / 3 BETWEEN CAST(0.125 AS DOUBLE) AND CAST(0.875 AS DOUBLE) AND (y0 + y1 + y2) / 3 BETWEEN CAST(0.125 AS DOUBLE) AND CAST(0.875 AS DOUBLE)")
def recut_mesh(spark, d):
    return clean.recut(_uv(spark, d), _t(spark, d), 0.125, 0.125)


_SV = "sv AS (SELECT vid, x + (vid % 7) / CAST(250 AS DOUBLE) AS x, y + (vid % 5) / CAST(200 AS DOUBLE) AS y, z FROM vtx)"


@query("snap_boundary", f"{M}, {_BE}, {_SV}, b AS (SELECT src AS vid FROM be UNION SELECT dst FROM be), e AS (SELECT sv.*, b.vid IS NOT NULL AND least(abs(x - round(x)), abs(y - round(y))) <= CAST(0.01 AS DOUBLE) AS near, abs(x - round(x)) AS ex, abs(y - round(y)) AS ey FROM sv LEFT JOIN b USING (vid)) SELECT vid, CASE WHEN near AND ex <= ey THEN round(x) ELSE x END AS x, CASE WHEN near AND ey < ex THEN round(y) ELSE y END AS y, z FROM e")
def snap_boundary(spark, d):
    v = _v(spark, d).selectExpr("vid", "x + (vid % 7) / 250D x", "y + (vid % 5) / 200D y", "z")
    return clean.snap_boundary(v, _t(spark, d))


@query("mesh_bounds", f"{M} SELECT min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z FROM vtx")
def mesh_bounds(spark, d):
    return clean.bounds(_v(spark, d))


_ZV = "zv AS (SELECT vid, x, y, round(z / 1000) / 64 AS z FROM vtx)"


@query("vertex_normals", f"""{M}, {_ZV}, {_P3.format(v='zv')}, w AS (SELECT *, (y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0) AS sx, (z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0) AS sy, (x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0) AS sz FROM p3),
 c AS (SELECT x0 AS x, y0 AS y, z0 AS z, sx, sy, sz FROM w UNION ALL SELECT x1, y1, z1, sx, sy, sz FROM w UNION ALL SELECT x2, y2, z2, sx, sy, sz FROM w),
 s AS (SELECT x, y, z, sum(sx) AS sx, sum(sy) AS sy, sum(sz) AS sz FROM c GROUP BY 1, 2, 3) SELECT vid, round(sx / sqrt(sx * sx + sy * sy + sz * sz), 9) AS nx, round(sy / sqrt(sx * sx + sy * sy + sz * sz), 9) AS ny, round(sz / sqrt(sx * sx + sy * sy + sz * sz), 9) AS nz FROM zv JOIN s USING (x, y, z)""")
def vertex_normals(spark, d):
    n = clean.vertex_normals(_v(spark, d).withColumn("z", F.round(F.col("z") / 1000) / 64), _t(spark, d))
    return n.select("vid", *[F.round(c, 9).alias(c) for c in ("nx", "ny", "nz")])


_CELL = f"{_ZV}, {_P3.format(v='zv')}, cell AS (SELECT tid, CAST(floor(((x0 + x1 + x2) / 3 + 0.5) / 16) AS BIGINT) AS cx, CAST(floor(((y0 + y1 + y2) / 3 + 0.5) / 16) AS BIGINT) AS cy, CAST(floor(((z0 + z1 + z2) / 3 - 4) / 16) AS BIGINT) AS cz FROM p3)"


def _cells(spark, d):
    return grid.partition(_v(spark, d).withColumn("z", F.round(F.col("z") / 1000) / 64), _t(spark, d), (-0.5, -0.5, 4.0), 16.0)


@query("grid_partition", f"{M}, {_CELL} SELECT * FROM cell")
def grid_partition(spark, d):
    return _cells(spark, d)


@query("grid_cell_meshes", f"{M}, {_CELL}, u AS (SELECT cx, cy, cz, vid, row_number() OVER (PARTITION BY cx, cy, cz ORDER BY min(p)) - 1 AS local FROM (SELECT cx, cy, cz, 3 * tid AS p, i0 AS vid FROM tri JOIN cell USING (tid) UNION ALL SELECT cx, cy, cz, 3 * tid + 1, i1 FROM tri JOIN cell USING (tid) UNION ALL SELECT cx, cy, cz, 3 * tid + 2, i2 FROM tri JOIN cell USING (tid)) GROUP BY 1, 2, 3, 4), m AS (SELECT * FROM tri JOIN cell USING (tid)), f AS (SELECT m.cx, m.cy, m.cz, tid, k, local FROM (SELECT cx, cy, cz, tid, 0 AS k, i0 AS vid FROM m UNION ALL SELECT cx, cy, cz, tid, 1, i1 FROM m UNION ALL SELECT cx, cy, cz, tid, 2, i2 FROM m) m JOIN u ON m.cx = u.cx AND m.cy = u.cy AND m.cz = u.cz AND m.vid = u.vid) SELECT cx, cy, cz, tid, max(local) FILTER (k = 0) AS i0, max(local) FILTER (k = 1) AS i1, max(local) FILTER (k = 2) AS i2 FROM f GROUP BY 1, 2, 3, 4")
def grid_cell_meshes(spark, d):
    return grid.cell_meshes(_t(spark, d), _cells(spark, d))


@query("cell_stats", f"{M}, {_CELL}, w AS (SELECT cx, cy, cz, tid, unnest([i0, i1, i2]) AS vid FROM tri JOIN cell USING (tid)) SELECT cx, cy, cz, count(DISTINCT tid) AS triangles, count(DISTINCT vid) AS vertices, min(z) AS min_z, max(z) AS max_z FROM w JOIN zv USING (vid) GROUP BY 1, 2, 3")
def cell_stats(spark, d):
    return grid.cell_stats(_v(spark, d).withColumn("z", F.round(F.col("z") / 1000) / 64), _t(spark, d), _cells(spark, d))


_SC = f"{A.PTS}, sc AS (SELECT DISTINCT CAST(floor(x / CAST(2500 AS DOUBLE)) AS BIGINT) AS cx, CAST(floor(y / CAST(2500 AS DOUBLE)) AS BIGINT) AS cy, CAST(floor(z / CAST(20000 AS DOUBLE)) AS BIGINT) AS cz FROM pts)"


def _sc(spark, d):
    return A.pts(spark, d).select(F.floor(F.col("x") / 2500).alias("cx"), F.floor(F.col("y") / 2500).alias("cy"), F.floor(F.col("z") / 20000).alias("cz")).distinct()


@query("lod_parents", f"WITH {_SC} SELECT cx, cy, cz, CAST(floor(cx / 2) AS BIGINT) AS pcx, CAST(floor(cy / 2) AS BIGINT) AS pcy, CAST(floor(cz / 2) AS BIGINT) AS pcz, CAST(2 * floor((cx + 1) / 2) - 1 AS BIGINT) AS bcx FROM sc")
def lod_parents(spark, d):
    return _sc(spark, d).select("cx", "cy", "cz", *grid.parent("cx", "cy", "cz"), *grid.block_base("cx"))


_LEVELS = f"{_SC}, l0 AS (SELECT 0 AS lod, * FROM sc), " + ", ".join(f"l{k} AS (SELECT DISTINCT {k} AS lod, CAST(floor(cx / 2) AS BIGINT) AS cx, CAST(floor(cy / 2) AS BIGINT) AS cy, CAST(floor(cz / 2) AS BIGINT) AS cz FROM l{k - 1})" for k in (1, 2, 3)) + ", lv AS (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3)"


def _levels(spark, d):
    level = _sc(spark, d).select(F.lit(0).alias("lod"), "cx", "cy", "cz")
    out = level
    for k in (1, 2, 3):
        level = level.select(F.lit(k).alias("lod"), *[F.floor(F.col(c) / 2).alias(c) for c in ("cx", "cy", "cz")]).distinct()
        out = out.unionByName(level)
    return out


_W = "(power(CAST(2 AS DOUBLE), lod) * 2500)"
_RATIO = f"greatest(0, cx - 20000 / {_W}, 20000 / {_W} - cx - 1, cy - 30000 / {_W}, 30000 / {_W} - cy - 1, cz - 5000 / {_W}, 5000 / {_W} - cz - 1)"


@query("cell_view_ratio", f"WITH {_LEVELS} SELECT *, {_RATIO} AS ratio FROM lv")
def cell_view_ratio(spark, d):
    return grid.view_ratio(_levels(spark, d), (20000.0, 30000.0, 5000.0), 2500.0)


@query("lod_select", f"""WITH {_LEVELS}, s AS (SELECT *, {_RATIO} AS ratio FROM lv), o AS (SELECT *, lod = 0 OR ratio > 1.5 AS own FROM s)
 SELECT lod, cx, cy, cz, ratio FROM o a WHERE own AND NOT EXISTS (SELECT 1 FROM o b WHERE b.own AND b.lod > a.lod AND b.cx = floor(a.cx / power(2, b.lod - a.lod)) AND b.cy = floor(a.cy / power(2, b.lod - a.lod)) AND b.cz = floor(a.cz / power(2, b.lod - a.lod)))""")
def lod_select(spark, d):
    return grid.select_levels(_levels(spark, d), (20000.0, 30000.0, 5000.0), 2500.0, 1.5, 3)


@query("frustum_visibility", f"WITH {_LEVELS}, b AS (SELECT lod, cx, cy, cz, cx * {_W} AS min_x, (cx + 1) * {_W} AS max_x, cy * {_W} AS min_y, (cy + 1) * {_W} AS max_y, cz * {_W} AS min_z, (cz + 1) * {_W} AS max_z FROM lv) SELECT lod, cx, cy, cz FROM b WHERE 1.0 * max_x + 0 * max_y + 0 * max_z - 10000 >= 0 AND 0.0 * max_x - 1.0 * min_y + 0 * max_z + 60000 >= 0 AND 1.0 * max_x + 1.0 * max_y + 0 * max_z - 40000 >= 0")
def frustum_visibility(spark, d):
    w = F.pow(F.lit(2.0), F.col("lod")) * 2500
    b = _levels(spark, d).withColumns({f"{n}_{c[1]}": (F.col(c) + k) * w for c in ("cx", "cy", "cz") for n, k in (("min", 0), ("max", 1))})
    return grid.visible(b, [(1.0, 0.0, 0.0, -10000.0), (0.0, -1.0, 0.0, 60000.0), (1.0, 1.0, 0.0, -40000.0)]).select("lod", "cx", "cy", "cz")


@query("octree_children", f"WITH {_SC}, k AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS k) SELECT cx, cy, cz, k, 1 AS level, 2 * cx + (k & 1) AS x, 2 * cy + ((k >> 1) & 1) AS y, 2 * cz + ((k >> 2) & 1) AS z FROM sc, k")
def octree_children(spark, d):
    kids = F.array(*[F.struct(F.lit(k).alias("k"), *[e.alias(n) for e, n in zip(grid.child(F.lit(0), F.col("cx"), F.col("cy"), F.col("cz"), k), ("level", "x", "y", "z"), strict=True)]) for k in range(8)])
    return _sc(spark, d).select("cx", "cy", "cz", F.inline(kids))


@query("pyramid_rank", f"WITH {_SC}, g AS (SELECT cx, cy, cz, CAST(16 AS BIGINT) AS n FROM sc) SELECT cx, cy, cz, CASE WHEN cx >= 0 AND cx < n AND cy >= 0 AND cy < n THEN (n * n - 1) // 3 + cy * n + cx ELSE -1 END AS rank FROM g")
def pyramid_rank(spark, d):
    return _sc(spark, d).select("cx", "cy", "cz", grid.pyramid_rank(F.col("cx"), F.col("cy"), F.lit(16)).alias("rank"))


@query("box_algebra", f"WITH {_LEVELS}, b AS (SELECT lod, min(cx) AS min_x, max(cx) AS max_x, min(cy) AS min_y, max(cy) AS max_y, min(cz) AS min_z, max(cz) AS max_z FROM lv GROUP BY 1) SELECT a.lod AS lod_a, c.lod AS lod_b, least(a.min_x, c.min_x) AS min_x, least(a.min_y, c.min_y) AS min_y, greatest(a.max_z, c.max_z) AS max_z, greatest(a.min_x, c.min_x) > least(a.max_x, c.max_x) AS apart FROM b a JOIN b c ON a.lod < c.lod")
def box_algebra(spark, d):
    b = _levels(spark, d).groupBy("lod").agg(*[f(c).alias(f"{n}_{c[1]}") for c in ("cx", "cy", "cz") for n, f in (("min", F.min), ("max", F.max))])
    j = b.alias("a").join(b.alias("b"), F.col("a.lod") < F.col("b.lod"))
    u = j.select(F.col("a.lod").alias("lod_a"), F.col("b.lod").alias("lod_b"), F.struct(*grid.box_union("a", "b")).alias("u"), F.struct(*grid.box_intersection("a", "b")).alias("i"))
    return u.selectExpr("lod_a", "lod_b", "u.min_x", "u.min_y", "u.max_z", "i.min_x > i.max_x AS apart")


@query("adjacency_indices", f"{M}, {_ADJ}, o AS (SELECT adj.tid, adj.eid % 3 AS k, CASE adj.opposite % 3 WHEN 0 THEN t.i2 WHEN 1 THEN t.i0 ELSE t.i1 END AS o FROM adj JOIN tri t ON adj.opposite // 3 = t.tid), w AS (SELECT tid, max(o) FILTER (k = 0) AS o0, max(o) FILTER (k = 1) AS o1, max(o) FILTER (k = 2) AS o2 FROM o GROUP BY 1) SELECT tid, i0, coalesce(o0, i0) AS o0, i1, coalesce(o1, i1) AS o1, i2, coalesce(o2, i2) AS o2 FROM tri LEFT JOIN w USING (tid)")
def adjacency_indices(spark, d):
    return mesh.adjacency_indices(_t(spark, d))


@query("shadow_indices", f"{M}, {_FV}, r AS (SELECT vid, min(vid) OVER (PARTITION BY x, y) AS remap FROM fv) SELECT tid, a.remap AS i0, b.remap AS i1, c.remap AS i2 FROM tri JOIN r a ON i0 = a.vid JOIN r b ON i1 = b.vid JOIN r c ON i2 = c.vid")
def shadow_indices(spark, d):
    return mesh.shadow_indices(_fv(spark, d), _t(spark, d), "x", "y")
