"""Tile catalogues and transform side-cars in text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(url, tile_x, tile_y): one URL a line; the pattern's two groups are the tile's numbers."""
    lines = spark.read.text(path).select(F.trim("value").alias("url")).filter("url <> ''")
    found = [F.regexp_extract("url", pattern, k) for k in (1, 2)]
    return lines.select("url", *[F.when(f != "", f).cast("int").alias(n) for f, n in zip(found, ("tile_x", "tile_y"), strict=True)])


def missing(tiles: DataFrame, done: DataFrame) -> DataFrame:
    """Tiles with no result yet: finished stages are skipped by an anti-join."""
    return tiles.join(done.select("tile_x", "tile_y"), ["tile_x", "tile_y"], "left_anti")


def on_line(tiles: DataFrame, delta: int, suffix: str = "final.ply") -> DataFrame:
    """Tiles (tile_x, tile_y, name) of finished meshes on the diagonal tile_y - tile_x = delta."""
    return tiles.filter((F.col("tile_y") - F.col("tile_x") == delta) & F.col("name").contains(suffix))


def staged(spark: SparkSession, folder: str, stage: Callable[[], DataFrame]) -> DataFrame:
    """The table below `folder` if a finished one is there, else stage()'s rows, written there first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        stage().write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def write_transforms(transforms: DataFrame, folder: str) -> None:
    """A side-car a tile (tile_x, tile_y, scale, shift_xy, shift_z): two lines of text with six significant digits each."""

    def six(c: str):
        return F.format_string("%.5e", F.col(c).cast("double"))

    text = F.concat(F.lit("Scale "), six("scale"), F.lit("\nOffset "), six("shift_xy"), F.lit(" "), six("shift_xy"), F.lit(" "), six("shift_z"), F.lit("\n"))
    transforms.select(text.alias("value"), F.format_string("%d_%d", F.col("tile_x").cast("int"), F.col("tile_y").cast("int")).alias("tile")).write.partitionBy("tile").text(folder)


def read_transforms(spark: SparkSession, folder: str) -> DataFrame:
    """(tile_x, tile_y, scale, shift_xy, shift_z) of the side-cars of write_transforms()."""
    lines = spark.read.text(folder).select("tile", F.split("value", " ").alias("w"))
    one = lines.groupBy("tile").agg(F.max(F.when(F.col("w")[0] == "Scale", F.col("w")[1].cast("double"))).alias("scale"), *[F.max(F.when(F.col("w")[0] == "Offset", F.get("w", F.lit(k)).cast("double"))).alias(n) for k, n in ((1, "shift_xy"), (3, "shift_z"))])
    return one.select(*[F.split("tile", "_")[k].cast("int").alias(n) for k, n in ((0, "tile_x"), (1, "tile_y"))], "scale", "shift_xy", "shift_z")


def rounded(transform: DataFrame) -> DataFrame:
    """scale and shifts as a text side-car would keep them: six significant digits."""

    def six(c: str):
        return F.when(F.col(c) == 0, 0.0).otherwise(F.format_string("%.5e", c).cast("double"))

    return transform.withColumns({c: six(c) for c in ("scale", "shift_xy", "shift_z")})
