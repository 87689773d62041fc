"""A store of quantized cells by level: Parquet partitioned by level and 4 x 4 block, loaded by block and rewritten in part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lineage import cut

CELL = ("lod", "nx", "ny")
BLOCK = 4


def _with_blocks(df: DataFrame) -> DataFrame:
    return df.withColumns({"bx": F.floor(F.col("nx") / BLOCK).cast("int"), "by": F.floor(F.col("ny") / BLOCK).cast("int")})


def write(tables: dict[str, DataFrame], folder: str) -> None:
    """Tables by name (vertices, triangles, parents, ...), each with lod, nx, ny: a new store below `folder`.

    A partition is a 4 x 4 block of cells, so that there are fewer, fuller files than cells.
    """
    for name, df in tables.items():
        rows = _with_blocks(df)
        rows.repartition("lod", "bx", "by").write.partitionBy("lod", "bx", "by").parquet(f"{folder}/{name}")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A whole table; a filter on lod, bx, by reads the partitions it names only."""
    return spark.read.parquet(f"{folder}/{name}")


def cells(spark: SparkSession, folder: str, name: str, lod: int, nx: tuple[int, int], ny: tuple[int, int]) -> DataFrame:
    """The rows of the cells in the ranges (ends included); other partitions are not opened."""
    df = read(spark, folder, name).filter(F.col("lod") == lod)
    for c, b, (low, high) in (("nx", "bx", nx), ("ny", "by", ny)):
        df = df.filter(F.col(b).between(low // BLOCK, high // BLOCK) & F.col(c).between(low, high))
    return df.drop("bx", "by")


def load_block(spark: SparkSession, folder: str, lod: int, nx0: int, ny0: int) -> tuple[DataFrame, DataFrame]:
    """(vertices (nx, ny, vid, x, y, z), triangles (nx, ny, tid, i0, i1, i2)) of the 4 x 4 cells about the corner (nx0, ny0).

    x and y are in widths of the parent level's cells from that corner, z in the same unit; a cell is 2^15 steps
    wide behind a margin of 2^14, and z is shift_z + scale_z * uz in 10^-5 of a tile.
    """
    span = (nx0 - 2, nx0 + 1), (ny0 - 2, ny0 + 1)
    v = cells(spark, folder, "vertices", lod, *span)
    at = [((F.col(u) - (1 << 14) + (F.col(n) - n0) * (1 << 15)) / F.lit(float(1 << 16))).alias(c) for u, n, n0, c in (("ux", "nx", nx0, "x"), ("uy", "ny", ny0, "y"))]
    z = (F.col("uz") * F.col("scale_z") + F.col("shift_z")) / F.lit(100000.0 * (1 << (lod + 1)))
    return v.select("nx", "ny", "vid", *at, z.alias("z")), cells(spark, folder, "triangles", lod, *span).select("nx", "ny", "tid", "i0", "i1", "i2")


def update(tables: dict[str, DataFrame], folder: str) -> None:
    """Replaces the cells that the tables hold, or appends new ones: only the blocks that hold them are rewritten."""
    for name, df in tables.items():
        spark = df.sparkSession
        new = cut(_with_blocks(df))
        blocks = new.select("lod", "bx", "by").distinct()
        old = read(spark, folder, name).join(blocks, ["lod", "bx", "by"], "left_semi").join(new.select(*CELL).distinct(), list(CELL), "left_anti")
        whole = cut(new.unionByName(old.select(*new.columns)))
        whole.repartition("lod", "bx", "by").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lod", "bx", "by").parquet(f"{folder}/{name}")
