"""Searches by other metrics, changing and saved indexes, vector helpers, number codecs and per-mesh orders."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .. import adapters as A
from ..functions import hashing, vec
from ..operators import grid, knn, order, points, remap, simplify
from .cloud_queries import _PAIR, _pair
from .file_queries import _folder
from .mesh_queries import _SC, _sc
from .registry import query

_ANG = f"{A.PTS}, an AS (SELECT pid, ((x + y + 62830) % 6283) / 1000.0::DOUBLE - 3.1415::DOUBLE AS angle FROM pts WHERE pid % 5 = 0)"


@query("within_turn", f"WITH {_ANG}, p AS (SELECT a.pid, b.pid AS nbr, abs(a.angle - b.angle) AS t FROM an a, an b) SELECT pid, nbr, least(t, 6.283185307179586::DOUBLE - t) AS d FROM p WHERE least(t, 6.283185307179586::DOUBLE - t) < 0.01")
def within_turn(spark, d):
    a = A.pts(spark, d).filter("pid % 5 = 0").select("pid", (F.expr("(x + y + 62830) % 6283") / F.lit(1000.0) - F.lit(3.1415)).alias("angle"))
    return knn.within_turn(a, a, 0.01)


_ROT = f"{A.V}, n AS (SELECT pid, x, y, z, sqrt(x * x + y * y + z * z + 0.01) AS n FROM v), ro AS (SELECT pid, x / n AS x, y / n AS y, z / n AS z, 0.1 / n AS w FROM n)"


@query("within_rotation", f"WITH {_ROT} SELECT a.pid, b.pid AS nbr, round((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) + (a.w - b.w) * (a.w - b.w), 9) AS d FROM ro a, ro b WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) + (a.w - b.w) * (a.w - b.w) < 0.2::DOUBLE * 0.2::DOUBLE")
def within_rotation(spark, d):
    v = A.v(spark, d)
    n = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z") + F.lit(0.01))
    q = v.select("pid", *[(F.col(c) / n).alias(c) for c in "xyz"], (F.lit(0.1) / n).alias("w"))
    return knn.within_rotation(q, q, 0.2).withColumn("d", F.round("d", 9))


_CH = f"{A.V}, ch AS (SELECT * FROM v WHERE pid % 3 <> 0 UNION ALL SELECT pid + 1000000, x + 0.01, y, z FROM v WHERE pid % 7 = 0)"
_NEAR = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)"


@query("radius_changed", f"WITH {_CH} SELECT a.pid, b.pid AS nbr, round({_NEAR}, 9) AS d FROM v a, ch b WHERE {_NEAR} < 0.05::DOUBLE * 0.05::DOUBLE")
def radius_changed(spark, d):
    """The index after removing every third point and adding shifted copies of every seventh."""
    v = A.v(spark, d)
    added = v.filter("pid % 7 = 0").select((F.col("pid") + 1000000).alias("pid"), (F.col("x") + F.lit(0.01)).alias("x"), "y", "z")
    return knn.within(v, knn.changed(v, added, v.filter("pid % 3 = 0")), 0.05).withColumn("d", F.round("d", 9))


@query("radius_saved", f"WITH {A.V} SELECT a.pid, b.pid AS nbr, round({_NEAR}, 9) AS d FROM v a, v b WHERE {_NEAR} < 0.05::DOUBLE * 0.05::DOUBLE")
def radius_saved(spark, d):
    at, v = _folder(spark, "index"), A.v(spark, d)
    knn.save_cells(v, 0.05, at)
    return knn.within_saved(v, at, 0.05).withColumn("d", F.round("d", 9))


_UP = "up AS (SELECT DISTINCT 1 AS lod, CAST(floor(cx / 2) AS BIGINT) AS cx, CAST(floor(cy / 2) AS BIGINT) AS cy, CAST(floor(cz / 2) AS BIGINT) AS cz FROM sc WHERE cx > 3)"


@query("octree_lookup", f"WITH {_SC}, {_UP} SELECT up.*, sc.cx AS vx, sc.cy AS vy, sc.cz AS vz, CAST((sc.cx & 1) + 2 * (sc.cy & 1) + 4 * (sc.cz & 1) AS INTEGER) AS k FROM up JOIN sc ON floor(sc.cx / 2) = up.cx AND floor(sc.cy / 2) = up.cy AND floor(sc.cz / 2) = up.cz")
def octree_lookup(spark, d):
    """The cells that exist below some of the parents."""
    sc = _sc(spark, d)
    up = sc.filter("cx > 3").select(F.lit(1).alias("lod"), *[F.floor(F.col(c) / 2).alias(c) for c in ("cx", "cy", "cz")]).distinct()
    return grid.children(up, sc.withColumn("lod", F.lit(0)))


_WANT = "wt AS (SELECT o_orderkey AS vid, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders WHERE o_orderkey % 3 = 0), fv AS (SELECT vid, CAST(vid % 100 // 3 AS DOUBLE) AS x, CAST(vid // 100 // 2 AS DOUBLE) AS y, CAST(vid % 2 AS DOUBLE) AS z FROM vtx)"


@query("copy_unique_vertices", f"WITH {A.VTX}, {_WANT}, f AS (SELECT x, y, z, min(place) AS place FROM wt JOIN fv USING (vid) GROUP BY 1, 2, 3), n AS (SELECT *, row_number() OVER (ORDER BY place) - 1 AS remap FROM f) SELECT vid, remap, x, y, z FROM wt JOIN fv USING (vid) JOIN n USING (x, y, z)")
def copy_unique_vertices(spark, d):
    v = A.vertices(spark, d)
    folded = v.selectExpr("vid", "cast(vid % 100 div 3 as double) x", "cast(vid div 100 div 2 as double) y", "cast(vid % 2 as double) z")
    wanted = v.filter("vid % 3 = 0").select("vid", (100000000 * F.lit(1).cast("long") - F.round(F.col("z") * 100).cast("long")).alias("cents"))
    # Places by falling price, then id: any ascending numbers do.
    ranked = wanted.select("vid", (F.col("cents") * 10_000_000 + F.col("vid")).alias("place"))
    copies, to = remap.copy_unique(folded, ranked)
    return to.join(copies.select(F.col("vid").alias("remap"), "x", "y", "z"), "remap").select("vid", "remap", "x", "y", "z")


@query("dedup_streams", f"WITH {A.VTX}, s AS (SELECT vid, vid % 100 // 3 AS x, vid // 100 // 2 AS y, vid % 4 AS r, vid % 3 AS g FROM vtx) SELECT vid, min(vid) OVER (PARTITION BY x, y, r, g) AS remap FROM s")
def dedup_streams(spark, d):
    """Vertices equal in both of two streams, positions and colours."""
    v = A.vertices(spark, d)
    return remap.dedup_streams(v.selectExpr("vid", "vid % 100 div 3 AS x", "vid div 100 div 2 AS y"), v.selectExpr("vid", "vid % 4 AS r", "vid % 3 AS g"))


@query("clusterize_radius", f"WITH RECURSIVE {A.VTX}, m AS (SELECT vid // 500 AS mesh_id, vid, x, y, round(z / 100000) AS z FROM vtx), n AS (SELECT a.mesh_id, a.vid, b.vid AS nbr, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 AS d2 FROM m a JOIN m b ON a.mesh_id = b.mesh_id), k AS (SELECT mesh_id, vid, list(nbr) AS near FROM (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY vid ORDER BY d2, nbr) <= 10) WHERE d2 <= 1.5::DOUBLE * 1.5::DOUBLE GROUP BY 1, 2), o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY mesh_id ORDER BY vid) AS i FROM k), r(mesh_id, i, vid, taken, near) AS (SELECT mesh_id, 0, -1, []::BIGINT[], []::BIGINT[] FROM o WHERE i = 1 UNION ALL SELECT o.mesh_id, o.i, CASE WHEN list_contains(r.taken, o.vid) THEN -1 ELSE o.vid END, CASE WHEN list_contains(r.taken, o.vid) THEN r.taken ELSE list_concat(r.taken, o.near) END, o.near FROM r JOIN o ON o.mesh_id = r.mesh_id AND o.i = r.i + 1), f AS (SELECT mesh_id, vid AS remap, unnest(list_append(near, vid)) AS vid FROM r WHERE vid >= 0) SELECT mesh_id, vid, max(remap) AS remap FROM f GROUP BY 1, 2")
def clusterize_radius(spark, d):
    v = A.vertices(spark, d).select(F.expr("vid div 500").alias("mesh_id"), "vid", "x", "y", F.round(F.col("z") / 100000).alias("z"))
    return simplify.clusterize(v, 1.5)


@query("vec2_ops", f"WITH {A.V}, {_PAIR} SELECT pid, ax * bx + ay * by_ AS dot, ax * by_ - ay * bx AS crossed, sqrt(ax * ax + ay * ay) AS norm, ax + bx AS add_x, ay - by_ AS sub_y, -ax AS neg_x, ay * 1.5 AS scale_y, ax / 4 AS div_x, ax = bx AND ay = by_ AS same FROM p")
def vec2_ops(spark, d):
    p, a, b = _pair(spark, d)
    a, b = a[:2], b[:2]
    return p.select("pid", vec.dot(a, b).alias("dot"), vec.cross2(a, b).alias("crossed"), vec.norm(a).alias("norm"), vec.add(a, b)[0].alias("add_x"), vec.sub(a, b)[1].alias("sub_y"), vec.neg(a)[0].alias("neg_x"), vec.scale(a, 1.5)[1].alias("scale_y"), vec.divide(a, 4)[0].alias("div_x"), vec.equal(a, b).alias("same"))


@query("vec4_ops", f"WITH {A.V}, {_PAIR}, q AS (SELECT *, ax + by_ AS aw, bx - az AS bw FROM p) SELECT pid, ax * bx + ay * by_ + az * bz + aw * bw AS dot, sqrt(ax * ax + ay * ay + az * az + aw * aw) AS norm, aw + bw AS add_w, az - bz AS sub_z, -aw AS neg_w, aw * 2.5 AS scale_w, az / 8 AS div_z, greatest(aw, bw) AS max_w, least(az, bz) AS min_z, abs(bw) AS abs_w, ax = bx AND ay = by_ AND az = bz AND aw = bw AS same FROM q")
def vec4_ops(spark, d):
    p, a, b = _pair(spark, d)
    a, b = (*a, a[0] + b[1]), (*b, b[0] - a[2])
    return p.select("pid", vec.dot(a, b).alias("dot"), vec.norm(a).alias("norm"), vec.add(a, b)[3].alias("add_w"), vec.sub(a, b)[2].alias("sub_z"), vec.neg(a)[3].alias("neg_w"), vec.scale(a, 2.5)[3].alias("scale_w"), vec.divide(a, 8)[2].alias("div_z"), vec.vmax(a, b)[3].alias("max_w"), vec.vmin(a, b)[2].alias("min_z"), vec.vabs(b)[3].alias("abs_w"), vec.equal(a, b).alias("same"))


@query("math_helpers", f"WITH {A.V} SELECT pid, x * x AS two, x * x * x AS three, greatest(-0.05::DOUBLE, least(0.1::DOUBLE, y)) AS held, round(radians(z * 360), 12) AS turned, abs(x - y) < 0.01::DOUBLE AS near FROM v")
def math_helpers(spark, d):
    x, y, z = (F.col(c) for c in "xyz")
    return A.v(spark, d).select("pid", vec.pow2(x).alias("two"), vec.pow3(x).alias("three"), vec.clamp(y, -0.05, 0.1).alias("held"), F.round(F.radians(z * 360), 12).alias("turned"), vec.approx_equal(x, y, 0.01).alias("near"))


_TM = f"WITH {A.VTX}, {A.TRI}, tc AS (SELECT tid, (a.x + b.x + c.x) / 3 AS x, (a.y + b.y + c.y) / 3 AS y, (a.z + b.z + c.z) / 3 AS z FROM tri JOIN vtx a ON i0 = a.vid JOIN vtx b ON i1 = b.vid JOIN vtx c ON i2 = c.vid), tb AS (SELECT min(x) AS lx, min(y) AS ly, min(z) AS lz, greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS side FROM tc)"
_BITS = " + ".join(f"(((floor((c.{a} - l{a}) * (1 / side) * 1023 + 0.5)::BIGINT >> {i}) & 1) << {3 * i + k})" for i in range(10) for k, a in enumerate("xyz"))


@query("triangle_morton", f"{_TM} SELECT tid, {_BITS} AS code FROM tc c, tb")
def triangle_morton(spark, d):
    return points.triangle_morton(A.vertices(spark, d), A.triangles(spark, d))


def _meshes(spark, d):
    return A.triangles(spark, d).withColumn("mesh_id", F.expr("i0 div 500"))


_MESHES = f"WITH {A.TRI}, mt AS (SELECT i0 // 500 AS mesh_id, * FROM tri)"


@query("mesh_order_checks", f"{_MESHES}, u AS (SELECT mesh_id, unnest([i0, i1, i2]) AS vid FROM mt), v AS (SELECT mesh_id, count(DISTINCT vid) AS n FROM u GROUP BY 1) SELECT mesh_id, count(*) AS places, CAST(sum(hash) AS BIGINT) AS triangles, true AS better, min(v.n) AS vertices, min(v.n) AS fetched FROM (SELECT mesh_id, i0 * 7 + i1 * 11 + i2 * 13 AS hash FROM mt) JOIN v USING (mesh_id) GROUP BY 1")
def mesh_order_checks(spark, d):
    """Of each mesh in cache order, then fetch order: places once each, the same triangles, fewer cache misses, vertices numbered by first use."""

    def f(t: np.ndarray) -> pd.DataFrame:
        made, place, old = order.optimize(t)
        first = pd.unique(made.ravel())
        better = order.cache_misses(made)["acmr"] <= order.cache_misses(t)["acmr"] + 1e-9 and (first == np.arange(len(first))).all() and (old[made] == t[place]).all()
        return pd.DataFrame({"places": [len(np.unique(place))], "triangles": [int((old[made] * [7, 11, 13]).sum())], "better": [bool(better)], "vertices": [len(np.unique(t))], "fetched": [len(first)]})

    return order.per_mesh(_meshes(spark, d), f, "places long, triangles long, better boolean, vertices long, fetched long")


@query("vertex_codec", f"{_MESHES}, {A.VTX}, u AS (SELECT DISTINCT mesh_id, unnest([i0, i1, i2]) AS vid FROM mt) SELECT mesh_id, vid, CAST(CAST(x AS FLOAT) AS DOUBLE) AS x, CAST(CAST(z AS FLOAT) AS DOUBLE) AS z FROM u JOIN vtx USING (vid)")
def vertex_codec(spark, d):
    """Each mesh's vertices as bytes and back."""
    used = _meshes(spark, d).select("mesh_id", F.explode(F.array("i0", "i1", "i2")).alias("vid")).distinct().join(A.vertices(spark, d), "vid")

    def trip(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vid")
        back = order.decode_vertices(order.encode_vertices(rows[["x", "y", "z"]].to_numpy(np.float32)))
        return pd.DataFrame({"mesh_id": key[0], "vid": rows["vid"], "x": back[:, 0].astype(float), "z": back[:, 2].astype(float)})

    return used.groupBy("mesh_id").applyInPandas(trip, "mesh_id long, vid long, x double, z double")


@query("sequence_codec", f"{_MESHES}, {A.VTX}, u AS (SELECT DISTINCT mesh_id, unnest([i0, i1, i2]) AS vid FROM mt) SELECT mesh_id, CAST(sum(vid) AS BIGINT) AS total, count(*) AS n, max(vid) AS last FROM u GROUP BY 1")
def sequence_codec(spark, d):
    """Vertex lists (any lengths) as bytes and back."""

    def f(t: np.ndarray) -> pd.DataFrame:
        back = order.decode_sequence(order.encode_sequence(np.unique(t)))
        return pd.DataFrame({"total": [int(back.sum())], "n": [len(back)], "last": [int(back[-1])]})

    return order.per_mesh(_meshes(spark, d), f, "total long, n long, last long")


@query("exponent_codec", f"WITH {A.V}, e AS (SELECT pid, x, CASE WHEN x = 0 THEN 0 ELSE floor(log2(abs(x))) - 13 END AS e FROM v) SELECT pid, CAST(e AS INTEGER) AS exponent, CAST(round(x / power(2.0::DOUBLE, e)) AS INTEGER) AS mantissa FROM e")
def exponent_codec(spark, d):
    m, e = hashing.encode_exponent(F.col("x"))
    return A.v(spark, d).select("pid", e.cast("int").alias("exponent"), m.alias("mantissa"))


_QC = f"{_ROT}, t AS (SELECT *, greatest(abs(x), abs(y), abs(z), abs(w)) AS top FROM ro), k AS (SELECT *, CASE WHEN abs(x) = top THEN 0 WHEN abs(y) = top THEN 1 WHEN abs(z) = top THEN 2 ELSE 3 END AS k, [x, y, z, w] AS q FROM t), s AS (SELECT *, CASE WHEN q[k + 1] < 0 THEN -1 ELSE 1 END * 2047.0::DOUBLE * sqrt(2.0::DOUBLE) AS f FROM k)"


@query("quaternion_codec", f"WITH {_QC} SELECT pid, k AS largest, CAST(round(q[(k + 1) % 4 + 1] * f) AS INTEGER) AS a, CAST(round(q[(k + 2) % 4 + 1] * f) AS INTEGER) AS b, CAST(round(q[(k + 3) % 4 + 1] * f) AS INTEGER) AS c FROM s")
def quaternion_codec(spark, d):
    v = A.v(spark, d)
    n = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z") + F.lit(0.01))
    q = v.select("pid", *[(F.col(c) / n).alias(c) for c in "xyz"], (F.lit(0.1) / n).alias("w"))
    at, a, b, c = hashing.encode_quaternion(tuple(F.col(x) for x in "xyzw"))
    return q.select("pid", at.alias("largest"), a.alias("a"), b.alias("b"), c.alias("c"))


_OC = f"{A.V}, n AS (SELECT pid, x / sqrt(x * x + y * y + z * z) AS x, y / sqrt(x * x + y * y + z * z) AS y, z / sqrt(x * x + y * y + z * z) AS z FROM v), s AS (SELECT *, abs(x) + abs(y) + abs(z) AS s FROM n), p AS (SELECT pid, z, x / s AS px, y / s AS py FROM s), f AS (SELECT pid, CASE WHEN z >= 0 THEN px ELSE (1 - abs(py)) * CASE WHEN px >= 0 THEN 1 ELSE -1 END END AS u, CASE WHEN z >= 0 THEN py ELSE (1 - abs(px)) * CASE WHEN py >= 0 THEN 1 ELSE -1 END END AS v FROM p)"


def _signed(c: str) -> str:
    return f"CAST(trunc(greatest(-1, least(1, {c})) * 2047 + CASE WHEN {c} >= 0 THEN 0.5 ELSE -0.5 END) AS INTEGER)"


@query("octahedral_codec", f"WITH {_OC} SELECT pid, {_signed('u')} AS u, {_signed('v')} AS v FROM f")
def octahedral_codec(spark, d):
    n = vec.normalized(vec.vec("x", "y", "z"))
    b = A.v(spark, d).select("pid", *[e.alias(c) for e, c in zip(n, ("a", "b", "c"), strict=True)])
    u, w = grid.octahedral(F.col("a"), F.col("b"), F.col("c"), 12)
    return b.select("pid", u.alias("u"), w.alias("v"))
