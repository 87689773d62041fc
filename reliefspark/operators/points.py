"""Point filters, projections and per-tile transforms: Column expressions over DataFrames of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schema import HALO_CM, NONE, ORIENTED, TILE_CM


def world(axis: str, scale: float = 0.01, offset: float = 0.0) -> Column:
    return F.col(axis) * F.lit(float(scale)) + F.lit(float(offset))


def in_box(box: tuple[float, float, float, float], scale: float = 0.01, offset: float = 0.0) -> Column:
    """Inclusive test of world x and y against (min x, max x, min y, max y), in metres."""
    return world("x", scale, offset).between(box[0], box[1]) & world("y", scale, offset).between(box[2], box[3])


def pass_all(points: DataFrame) -> DataFrame:
    """Every point: the filter of readers that take all."""
    return points


def filter_ground(points: DataFrame, box: tuple[float, float, float, float], scale: float = 0.01, offset: float = 0.0, high: float = 2200.0) -> DataFrame:
    """Points in the box: ground and water below `high` metres, any class up to 9 above it."""
    z = world("z", scale, offset)
    return points.filter(in_box(box, scale, offset) & F.when(z < high, F.col("classification").isin(2, 9)).otherwise(F.col("classification") <= 9))


def filter_local(points: DataFrame, halo: int = HALO_CM) -> DataFrame:
    """Ground points strictly inside the tile and its halo, in tile-local centimetres."""
    inside = [(F.col(c) > -halo) & (F.col(c) < TILE_CM + halo) for c in "xy"]
    return points.filter(inside[0] & inside[1] & (F.col("classification") == 2))


def rebase(points: DataFrame, dx: Column | str = "dx", dy: Column | str = "dy") -> DataFrame:
    """Neighbour-tile points moved into the frame of the target tile, dx and dy tiles away."""
    at = [F.col(c) if isinstance(c, str) else c for c in (dx, dy)]
    return points.withColumns({"x": F.col("x") + at[0] * TILE_CM, "y": F.col("y") + at[1] * TILE_CM})


def neighbours(tiles: DataFrame) -> DataFrame:
    """(tile_x, tile_y, dx, dy, other columns of the neighbour): the up to 9 existing tiles around each tile."""
    around = tiles.select("tile_x", "tile_y").withColumn("dy", F.explode(F.array(*map(F.lit, (-1, 0, 1))))).withColumn("dx", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
    other = tiles.withColumnsRenamed({"tile_x": "ox", "tile_y": "oy"})
    return around.join(other, (F.col("tile_x") + F.col("dx") == F.col("ox")) & (F.col("tile_y") + F.col("dy") == F.col("oy"))).drop("ox", "oy")


def tile_box(tiles: DataFrame, halo_m: int = 100) -> DataFrame:
    """World box in metres of tiles named by their upper-left kilometre corner."""
    x, y = F.col("tile_x") * 1000, F.col("tile_y") * 1000
    return tiles.withColumns({"min_x": x - halo_m, "max_x": x + 1000 + halo_m, "min_y": y - 1000 - halo_m, "max_y": y + halo_m, "min_z": F.lit(-1000), "max_z": F.lit(9000)})


def source_index(points: DataFrame) -> DataFrame:
    """source_id -> source_idx, numbered by first appearance (smallest pid)."""
    first = points.groupBy("source_id").agg(F.min("pid").alias("first_pid"))
    return first.withColumn("source_idx", F.row_number().over(Window.orderBy("first_pid")) - 1)


def z_extent(points: DataFrame, *keys: str) -> DataFrame:
    return points.groupBy(*keys).agg(F.min("z").alias("min_z"), F.max("z").alias("max_z"))


def unit_cube_transform(points: DataFrame, *keys: str) -> DataFrame:
    """(keys..., n, scale, shift_xy, shift_z) of each tile; a span of 1875 m or more has n null: no transform."""
    e = z_extent(points, *keys)
    span = (F.col("max_z") - F.col("min_z")) * F.lit(0.01)
    e = e.withColumn("n", F.when(span < 1250, 6).when(span < 1875, 2)).withColumn("scale", F.col("n") / (F.col("n") + F.lit(2.0))).withColumn("shift_xy", F.lit(1.0) / (F.col("n") + F.lit(2.0)))
    mean = F.lit(0.5) * (F.col("min_z") + F.col("max_z")) * F.lit(1e-5) * F.col("scale")
    return e.withColumn("shift_z", F.lit(0.5) - F.round(mean * 16) / F.lit(16.0)).select(*keys, "n", "scale", "shift_xy", "shift_z")


def to_unit_cube(points: DataFrame, transform: DataFrame, *keys: str) -> DataFrame:
    """Points with px, py, pz in the unit cube; tiles without a transform are dropped."""
    t = transform.filter("n is not null")
    joined = points.join(t, list(keys)) if keys else points.join(F.broadcast(t))  # one row without keys
    return joined.withColumns({p: F.col(c) * F.lit(1e-5) * F.col("scale") + F.col(s) for p, c, s in (("px", "x", "shift_xy"), ("py", "y", "shift_xy"), ("pz", "z", "shift_z"))})


def from_unit_cube(points: DataFrame) -> DataFrame:
    """px, py, pz -> kx, ky, kz in kilometres."""
    return points.withColumns({k: (F.col(p) - F.col(s)) / F.col("scale") for k, p, s in (("kx", "px", "shift_xy"), ("ky", "py", "shift_xy"), ("kz", "pz", "shift_z"))})


def metric(points: DataFrame, scale: float = 0.01) -> DataFrame:
    return points.withColumns({f"m{c}": F.col(c) * F.lit(float(scale)) for c in "xyz"})


def weight_normals(points: DataFrame, mode: str = "oriented") -> DataFrame:
    """Normals times quality; `oriented`: zero below ORIENTED, `reached`: zero for NONE only (dead points keep theirs)."""
    keep = F.col("orient") >= ORIENTED if mode == "oriented" else F.col("orient") != NONE
    w = F.when(keep, F.col("qual")).otherwise(F.lit(0.0))
    return points.withColumns({c: F.col(c) * w for c in ("nx", "ny", "nz")})


def drop_unoriented(points: DataFrame) -> DataFrame:
    return points.filter(F.col("orient") >= ORIENTED)


def quality_rgb(points: DataFrame, qual: str = "qual") -> DataFrame:
    """Red to blue to green by quality."""
    q = F.col(qual)
    b = F.lit(1.0) - 2 * F.abs(q - F.lit(0.5))
    part = {"cr": F.when(q < 0.5, 1 - b).otherwise(F.lit(0.0)), "cg": F.when(q > 0.5, 1 - b).otherwise(F.lit(0.0)), "cb": b}
    return points.withColumns({c: F.floor(255 * e + F.lit(0.5)).cast("int") for c, e in part.items()})


def add_corners(points: DataFrame) -> DataFrame:
    """The two unit-cube corners with zero normals and quality; other columns null."""
    spark = points.sparkSession
    corners = spark.range(2).select(*[F.col("id").cast("double").alias(c) for c in ("px", "py", "pz")], *[F.lit(0.0).alias(c) for c in ("nx", "ny", "nz", "qual")])
    return points.unionByName(corners, allowMissingColumns=True)


def translate(df: DataFrame, dx: float, dy: float) -> DataFrame:
    return df.withColumns({"x": F.col("x") + F.lit(float(dx)), "y": F.col("y") + F.lit(float(dy))})


def corner_required(vertices: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """required: on a side x or y in {0, 1} and within the tolerance of one of its corners."""

    def near(c: str) -> Column:
        return (F.abs(F.col(c)) < tolerance) | (F.abs(F.col(c) - 1) < tolerance)

    on_x, on_y = F.col("x").isin(0.0, 1.0), F.col("y").isin(0.0, 1.0)
    return vertices.withColumn("required", (on_x & near("y")) | (on_y & near("x")))


def counting_sort(points: DataFrame) -> DataFrame:
    """position of every point when sorted by source, file order kept: starts of the sources plus rank within."""
    counts = points.groupBy("source_id").agg(F.count("*").alias("n"))
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("source_id", "start")
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy("pid")) - 1
    return points.withColumn("rank", rank).join(starts, "source_id").withColumn("position", F.col("start") + F.col("rank")).drop("rank", "start")


def morton(x: Column, y: Column, z: Column) -> Column:
    """10 bits of each axis interleaved, x lowest; arguments in 0..1."""
    out: Column = F.lit(0).cast("long")
    for k, axis in enumerate((x, y, z)):
        v = F.floor(axis * 1023 + F.lit(0.5)).cast("long")
        for b in range(10):
            out = out + F.shiftleft(F.shiftright(v, b).bitwiseAND(F.lit(1).cast("long")), 3 * b + k)
    return out


def spatial_order(points: DataFrame, x: str = "x", y: str = "y", z: str = "z") -> DataFrame:
    """points with their Morton code over the box scaled by its largest extent; order by it for locality."""
    box = points.agg(*[f(c).alias(f"__{n}_{a}") for a, c in zip("xyz", (x, y, z), strict=True) for n, f in (("lo", F.min), ("hi", F.max))])
    extent = F.greatest(*[F.col(f"__hi_{a}") - F.col(f"__lo_{a}") for a in "xyz"])
    scale = F.when(extent > 0, F.lit(1.0) / extent).otherwise(F.lit(0.0))
    j = points.join(F.broadcast(box))  # one row
    return j.withColumn("code", morton(*[(F.col(c) - F.col(f"__lo_{a}")) * scale for a, c in zip("xyz", (x, y, z), strict=True)])).select(*points.columns, "code")


def triangle_morton(vertices: DataFrame, triangles: DataFrame) -> DataFrame:
    """(tid, code): triangles by the Morton code of their centroids, ten bits an axis over the centroids' box scaled by its largest side."""
    from . import clean

    c = clean.with_corners(vertices, triangles).select("tid", *[((F.col(f"p0.{a}") + F.col(f"p1.{a}") + F.col(f"p2.{a}")) / F.lit(3.0)).alias(a) for a in "xyz"])
    return spatial_order(c).select("tid", "code")
