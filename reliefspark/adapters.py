"""Lidar-like views over the star-schema tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PTS = """pts AS (SELECT event_id AS pid, user_id AS source_id, (event_id * 7919) % 120000 - 10000 AS x,
  (event_id * 104729) % 120000 - 10000 AS y, CAST(round(value * 100) AS BIGINT) AS z,
  CAST((event_id * 31) % 61 - 30 AS INTEGER) AS scan_angle,
  CAST(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS DOUBLE) / CAST(1000000 AS DOUBLE) AS gps_time,
  CASE WHEN event_type IN ('click', 'view') THEN 2 WHEN event_type = 'error' THEN 9 ELSE 1 END AS classification
  FROM events)"""


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in tile-local centimetres from `events`."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("pid"),
        F.col("user_id").alias("source_id"),
        F.expr("(event_id * 7919) % 120000 - 10000").alias("x"),
        F.expr("(event_id * 104729) % 120000 - 10000").alias("y"),
        F.round(F.col("value") * 100).cast("long").alias("z"),
        F.expr("cast((event_id * 31) % 61 - 30 as int)").alias("scan_angle"),
        (F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)").cast("double") / F.lit(1000000.0)).alias("gps_time"),
        F.when(F.col("event_type").isin("click", "view"), 2).when(F.col("event_type") == "error", 9).otherwise(1).alias("classification"),
    )


V = "v AS (SELECT vec_id AS pid, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings)"


def v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the unit cube's scale from `embeddings`."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pid"), *[F.col("embedding")[k].cast("double").alias(c) for k, c in enumerate("xyz")])


VTX = "vtx AS (SELECT o_orderkey AS vid, CAST(o_orderkey % 100 AS DOUBLE) AS x, CAST(o_orderkey // 100 AS DOUBLE) AS y, o_totalprice AS z FROM orders)"
TRI = """quad AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 100 < 99
    AND o_orderkey < (SELECT max(o_orderkey) FROM orders) - 100),
  tri AS (SELECT 2 * k AS tid, k AS i0, k + 1 AS i1, k + 100 AS i2 FROM quad
    UNION ALL SELECT 2 * k + 1, k + 1, k + 101, k + 100 FROM quad)"""
HE = """he AS (SELECT 3 * tid AS eid, tid, i0 AS src, i1 AS dst FROM tri UNION ALL SELECT 3 * tid + 1, tid, i1, i2 FROM tri
    UNION ALL SELECT 3 * tid + 2, tid, i2, i0 FROM tri)"""


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of vertices, 100 to a row, from `orders`."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("vid"), F.expr("cast(o_orderkey % 100 as double)").alias("x"), F.expr("cast(o_orderkey div 100 as double)").alias("y"), F.col("o_totalprice").alias("z")
    )


def triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two triangles a grid quad; quads of status P are holes."""
    o = table(spark, sf_dir, "orders")
    top = o.agg(F.max("o_orderkey").alias("top"))
    quad = o.filter("o_orderstatus <> 'P' AND o_orderkey % 100 < 99").join(F.broadcast(top), F.col("o_orderkey") < F.col("top") - 100).select(F.col("o_orderkey").alias("k"))
    return quad.selectExpr("stack(2, 2*k, k, k+1, k+100, 2*k+1, k+1, k+101, k+100) AS (tid, i0, i1, i2)")


RASTER = "raster AS (SELECT CAST(p_partkey % 50 AS INTEGER) AS px, CAST(p_partkey // 50 AS INTEGER) AS py, CASE WHEN p_size = 1 THEN CAST(-9999 AS DOUBLE) ELSE p_retailprice END AS alt FROM part)"
RASTER_NX, RASTER_NY = 50, 400


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of a 50 x 400 raster from `part`; size 1 is nodata."""
    return table(spark, sf_dir, "part").selectExpr("cast(p_partkey % 50 as int) px", "cast(p_partkey div 50 as int) py", "case when p_size = 1 then -9999D else p_retailprice end alt")


TILES = "tiles AS (SELECT n_nationkey % 5 AS tile_x, n_nationkey // 5 AS tile_y, r_name AS area FROM nation JOIN region ON n_regionkey = r_regionkey)"


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 5 x 5 tile catalogue from `nation` and `region`."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).selectExpr("n_nationkey % 5 tile_x", "n_nationkey div 5 tile_y", "r_name area").withColumn("tile_y", F.col("tile_y").cast("int"))
