"""Altitude rasters against point density: pixels to points, hole filling and the boundary ring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import HALO_CM, NODATA_BELOW, RING_CM, TILE_CM


def raster_points(raster: DataFrame, nx: int, ny: int) -> DataFrame:
    """(px, py, x, y, z) in tile-local centimetres of all pixels with data; pixel centres by integer division."""
    return raster.filter(F.col("alt") >= NODATA_BELOW).select(
        "px", "py", F.expr(f"((2 * px + 1) * 50000L) div {nx}").alias("x"), F.expr(f"((2 * ({ny} - py) - 1) * 50000L) div {ny}").alias("y"), (F.col("alt") * 100).cast("long").alias("z")
    )


def pixel(axis: Column, n: int, halo: int = HALO_CM) -> Column:
    """Density pixel of a coordinate, clamped to the grid."""
    width = TILE_CM + 2 * halo
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), ((axis + halo) * F.lit(float(n)) / F.lit(float(width)) - F.lit(0.5)).cast("int")))


def density(points: DataFrame, n: int = 600, halo: int = HALO_CM) -> DataFrame:
    """(gx, gy, count) of the non-empty pixels of an n x n grid over tile and halo."""
    return points.groupBy(pixel(F.col("x"), n, halo).alias("gx"), pixel(F.col("y"), n, halo).alias("gy")).agg(F.count("*").alias("count"))


def empty_pixels(grid: DataFrame, n: int = 600) -> DataFrame:
    return grid.agg((F.lit(n * n).cast("long") - F.count("*")).alias("empty"))


def hole_fill(candidates: DataFrame, grid: DataFrame, n: int = 600, halo: int = HALO_CM) -> DataFrame:
    """Raster points inside the halo (inclusive) whose density pixel holds no point."""
    inside = candidates.filter(F.col("x").between(-halo, TILE_CM + halo) & F.col("y").between(-halo, TILE_CM + halo))
    keyed = inside.withColumns({"gx": pixel(F.col("x"), n, halo), "gy": pixel(F.col("y"), n, halo)})
    return keyed.join(grid.select("gx", "gy"), ["gx", "gy"], "left_anti").select(*candidates.columns)


def boundary_ring(candidates: DataFrame, extent: DataFrame, halo: int = HALO_CM, ring: int = RING_CM) -> DataFrame:
    """Points of the ring outside the halo, their z clamped into the existing points' range (one row min_z, max_z)."""
    out = F.col("x").between(-halo, TILE_CM + halo) & F.col("y").between(-halo, TILE_CM + halo)
    strictly = (F.col("x") > -ring) & (F.col("x") < TILE_CM + ring) & (F.col("y") > -ring) & (F.col("y") < TILE_CM + ring)
    j = candidates.filter(strictly & ~out).join(F.broadcast(extent.select("min_z", "max_z")))
    return j.withColumn("z", F.greatest(F.least("z", "max_z"), "min_z")).select(*candidates.columns)
