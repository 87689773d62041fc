"""Vertex identity: deduplication, dense renumbering, and unions of meshes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..lineage import numbered


def dedup(vertices: DataFrame, *attributes: str) -> DataFrame:
    """(vid, remap): the first vertex with equal attributes (x, y, z by default)."""
    keys = attributes or ("x", "y", "z")
    return vertices.select("vid", F.min("vid").over(Window.partitionBy(*keys)).alias("remap"))


def dedup_streams(*streams: DataFrame) -> DataFrame:
    """(vid, remap) over several streams (vid, attributes...): the first vertex that is equal in all of them."""
    whole, names = streams[0].select("vid"), []
    for k, s in enumerate(streams):
        own = [c for c in s.columns if c != "vid"]
        whole = whole.join(s.select("vid", *[F.col(c).alias(f"s{k}_{c}") for c in own]), "vid")
        names += [f"s{k}_{c}" for c in own]
    return dedup(whole, *names)


def corners(triangles: DataFrame) -> DataFrame:
    """(position, vid): the index buffer, three rows a triangle."""
    return triangles.selectExpr("stack(3, 3*tid, i0, 3*tid+1, i1, 3*tid+2, i2) AS (position, vid)")


def dense(vertices: DataFrame, triangles: DataFrame, *attributes: str) -> DataFrame:
    """(vid, remap): new ids by first appearance of equal vertices in the index buffer; unreferenced null."""
    keys = list(attributes or ("x", "y", "z"))
    used = corners(triangles).groupBy("vid").agg(F.min("position").alias("position"))
    seen = vertices.join(used, "vid").groupBy(*keys).agg(F.min("position").alias("position"))
    number = numbered(seen, "position", "remap").drop("position")
    named = vertices.join(used.select("vid"), "vid", "left_semi").select("vid", *keys).join(number, keys)
    return vertices.select("vid").join(named.select("vid", "remap"), "vid", "left")


def apply(triangles: DataFrame, remap: DataFrame) -> DataFrame:
    """Triangles with every index replaced: one join over unpivoted corners instead of three."""
    c = triangles.select("tid", F.posexplode(F.array("i0", "i1", "i2")).alias("k", "vid"))
    return c.join(remap, "vid").groupBy("tid").agg(*[F.max(F.when(F.col("k") == k, F.col("remap"))).alias(f"i{k}") for k in range(3)])


def concat(a: tuple[DataFrame, DataFrame], b: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """UNION ALL of two meshes (vertices, triangles): the second's ids come behind the first's."""
    off = a[0].agg(F.coalesce(F.max("vid") + 1, F.lit(0)).alias("dv")).join(a[1].agg(F.coalesce(F.max("tid") + 1, F.lit(0)).alias("dt")))
    off = F.broadcast(off)  # one row
    v = b[0].join(off).select((F.col("vid") + F.col("dv")).alias("vid"), *[c for c in b[0].columns if c != "vid"])
    t = b[1].join(off).select((F.col("tid") + F.col("dt")).alias("tid"), *[(F.col(i) + F.col("dv")).alias(i) for i in ("i0", "i1", "i2")])
    return a[0].unionByName(v), a[1].unionByName(t)


def join_referenced(vertices: DataFrame, triangles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """UNION DISTINCT by index: equal vertices once, in order of first use; unreferenced ones go."""
    remap = dense(vertices, triangles).filter("remap is not null")
    v = vertices.join(remap, "vid").groupBy("remap").agg(*[F.min(c).alias(c) for c in ("x", "y", "z")]).withColumnRenamed("remap", "vid")
    return v, apply(triangles, remap)


def join_all(vertices: DataFrame, triangles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """UNION DISTINCT by vertex: ids by first appearance among the vertices, unreferenced ones too."""
    first = vertices.groupBy("x", "y", "z").agg(F.min("vid").alias("first"))
    first = numbered(first, "first", "remap")
    remap = vertices.join(first, ["x", "y", "z"]).select("vid", "remap")
    return first.select(F.col("remap").alias("vid"), "x", "y", "z"), apply(triangles, remap)


def compose(first: DataFrame, second: DataFrame) -> DataFrame:
    """(vid, remap) of one remap after another: child vertex to parent vertex."""
    return first.join(second.select(F.col("vid").alias("remap"), F.col("remap").alias("__to")), "remap").select("vid", F.col("__to").alias("remap"))


def copy_unique(vertices: DataFrame, wanted: DataFrame, *attributes: str) -> tuple[DataFrame, DataFrame]:
    """(copies (vid, attributes...), remap (vid, remap)) of the vertices that `wanted` (place, vid) lists: equal ones once, numbered by first place."""
    keys = list(attributes or ("x", "y", "z"))
    taken = wanted.groupBy("vid").agg(F.min("place").alias("place")).join(vertices.select("vid", *keys), "vid")
    first = numbered(taken.groupBy(*keys).agg(F.min("place").alias("place")), "place", "remap")
    return first.select(F.col("remap").alias("vid"), *keys), taken.select("vid", *keys).join(first.select("remap", *keys), keys).select("vid", "remap")
