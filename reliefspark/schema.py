"""Schemas, units and enumerations shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

#: Fixed values of the data model: centimetres in a kilometre tile, its halo and its wider ring.
TILE_CM, HALO_CM, RING_CM = 100_000, 10_000, 48_000
#: Raster altitudes below this (metres) hold no data.
NODATA_BELOW = -500.0

#: Orientation states, in their order.
DEAD, NONE, TMP_PLAGUE, ORIENTED, PLAGUE, POSITIVE_Z, SCANLINE = range(7)

POINTS = T.StructType(
    [
        T.StructField("tile_x", T.IntegerType()),
        T.StructField("tile_y", T.IntegerType()),
        T.StructField("pid", T.LongType()),
        T.StructField("x", T.LongType()),
        T.StructField("y", T.LongType()),
        T.StructField("z", T.LongType()),
        T.StructField("intensity", T.IntegerType()),
        T.StructField("return_number", T.ShortType()),
        T.StructField("number_of_returns", T.ShortType()),
        T.StructField("classification", T.IntegerType()),
        T.StructField("scan_angle", T.ByteType()),
        T.StructField("source_id", T.IntegerType()),
        T.StructField("gps_time", T.DoubleType()),
    ]
)
VERTICES = "mesh_id int, vid long, x double, y double, z double"
TRIANGLES = "mesh_id int, tid long, i0 long, i1 long, i2 long"
