"""Surfaces from points.

The original's reconstruction is an outside program; these are the built-in stand-ins, approximations by
nature: a height field over the density grid as a DataFrame plan, and the outside program itself where
it is installed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def height_field(points: DataFrame, cell: float) -> tuple[DataFrame, DataFrame]:
    """(vertices, triangles): one vertex a filled cell at its points' mean height, two triangles a square of four.

    Ids are cell numbers, 2^31 to a row, so no numbering pass is needed; one aggregation and two joins.
    """
    g = points.select(F.floor(F.col("x") / cell).alias("gx"), F.floor(F.col("y") / cell).alias("gy"), "z")
    v = g.groupBy("gx", "gy").agg(F.avg("z").alias("z"), F.count("*").alias("n"))
    vid = F.col("gy") * F.lit(1 << 31) + F.col("gx")
    v = v.select(vid.alias("vid"), "gx", "gy", ((F.col("gx") + 0.5) * cell).alias("x"), ((F.col("gy") + 0.5) * cell).alias("y"), "z", "n")
    c = v.select(F.col("vid").alias("a"), F.explode(F.array(F.col("vid"), F.col("vid") - 1, F.col("vid") - (1 << 31), F.col("vid") - (1 << 31) - 1)).alias("corner"))
    quad = c.groupBy("corner").agg(F.count("*").alias("n")).filter("n = 4").select(F.col("corner").alias("k"))
    up = 1 << 31
    t = quad.selectExpr(f"stack(2, 2*k, k, k+1, k+{up}, 2*k+1, k+1, k+{up}+1, k+{up}) AS (tid, i0, i1, i2)")
    return v.drop("gx", "gy"), t


def command(points_ply: str, out_ply: str, depth: int = 10, weight: float = 4.0, threads: int = 8) -> list[str]:
    """The outside program's command line, for tiles written with meshes.write."""
    return ["poissonrecon", "--in", points_ply, "--out", out_ply, "--depth", str(depth), "--pointWeight", str(weight), "--confidence", "1", "--scale", "1.0", "--threads", str(threads)]
