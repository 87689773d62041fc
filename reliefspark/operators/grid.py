"""Grid cells, quantization and level-of-detail pyramids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import clean


def partition(vertices: DataFrame, triangles: DataFrame, base: tuple[float, float, float], step: float) -> DataFrame:
    """(tid, cx, cy, cz): the cell that holds each triangle's barycentre."""
    c = clean.with_corners(vertices, triangles)
    return c.select("tid", *[F.floor(((F.col(f"p0.{a}") + F.col(f"p1.{a}") + F.col(f"p2.{a}")) / F.lit(3.0) - F.lit(o)) / F.lit(step)).alias(f"c{a}") for a, o in zip("xyz", base, strict=True)])


def cell_meshes(triangles: DataFrame, cells: DataFrame) -> DataFrame:
    """(cx, cy, cz, tid, i0, i1, i2): vertices renumbered within each cell by first use; shared ones are doubled."""
    keys = ["cx", "cy", "cz"]
    t = triangles.join(cells, "tid")
    c = t.select(*keys, "tid", F.posexplode(F.array("i0", "i1", "i2")).alias("k", "vid"))
    first = c.groupBy(*keys, "vid").agg(F.min(F.col("tid") * 3 + F.col("k")).alias("first"))
    own = first.withColumn("local", F.row_number().over(Window.partitionBy(*keys).orderBy("first")) - 1).drop("first")
    return c.join(own, [*keys, "vid"]).groupBy(*keys, "tid").agg(*[F.max(F.when(F.col("k") == k, F.col("local"))).alias(f"i{k}") for k in range(3)])


def cell_stats(vertices: DataFrame, triangles: DataFrame, cells: DataFrame) -> DataFrame:
    """Per cell: triangles, distinct vertices and range of z."""
    keys = ["cx", "cy", "cz"]
    c = triangles.join(cells, "tid").select(*keys, "tid", F.explode(F.array("i0", "i1", "i2")).alias("vid"))
    one = c.groupBy(*keys, "vid").agg(F.count("*").alias("uses")).join(vertices.select("vid", "z"), "vid")
    return one.groupBy(*keys).agg((F.sum("uses") / 3).cast("long").alias("triangles"), F.count("*").alias("vertices"), F.min("z").alias("min_z"), F.max("z").alias("max_z"))


def parent(*coords: str) -> list[Column]:
    """Parent cell coordinates: halves rounded down, also below zero."""
    return [F.floor(F.col(c) / 2).alias(f"p{c}") for c in coords]


def block_base(*coords: str) -> list[Column]:
    """Odd-aligned base of the two-wide block that a parent coordinate falls in."""
    return [(2 * F.floor((F.col(c) + 1) / 2) - 1).alias(f"b{c}") for c in coords]


def child(level: Column, x: Column, y: Column, z: Column, k: int) -> tuple[Column, ...]:
    """Octree child k: x from bit 0, y from bit 1, z from bit 2."""
    return level + 1, 2 * x + (k & 1), 2 * y + (k >> 1 & 1), 2 * z + (k >> 2 & 1)


def pyramid_rank(di: Column, dj: Column, n: Column) -> Column:
    """Position of cell (di, dj) of an n x n level behind all smaller levels; -1 outside."""
    inside = (di >= 0) & (di < n) & (dj >= 0) & (dj < n)
    return F.when(inside, F.floor((n * n - 1) / 3) + dj * n + di).otherwise(-1).cast("long")


def quantize_step(c: Column, h: float) -> Column:
    return F.round(c / F.lit(h)) * F.lit(h)


def quantize_u16(x: Column, y: Column, z: Column) -> tuple[Column, ...]:
    """Tile positions in sixteen bits: a quarter of the range as margin in x and y."""
    xy = [(c * 32768 + 16384).cast("int").bitwiseAND(F.lit(0xFFFF)) for c in (x, y)]
    return *xy, (z * 16384).cast("int").bitwiseAND(F.lit(0xFFFF))


def quantize_cell(c: Column, shift: Column, div: int) -> Column:
    """A horizontal coordinate within its cell: 2^15 steps a cell behind a quarter's margin."""
    return ((c - shift) * F.lit(32768.0 * div) + 16384).cast("int")


def dequantize_cell(q: Column, shift: Column, div: int) -> Column:
    return (q - 16384) / F.lit(32768.0 * div) + shift


#: Steps of z in a tile's width, and of quantized z.
Z_STEPS, SCALE_Z = 100_000, 2


def cells2d(vertices: DataFrame, triangles: DataFrame, sublevels: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A tile of the unit square in 2^sublevels x 2^sublevels cells: (cells, vertices, triangles), each with lod 0, nx, ny.

    A triangle goes to the cell of its barycentre (those outside to the nearest). Vertices are quantized in their
    cell, equal ones are one, numbered by first use; triangles that degenerate go. cells: counts, shift_z and scale_z
    and the box of the quantized vertices. Every cell has its own shift_z.
    """
    n = 1 << sublevels
    corner = clean.with_corners(vertices, triangles)

    def cell(a: str) -> Column:
        mid = (F.col(f"p0.{a}") + F.col(f"p1.{a}") + F.col(f"p2.{a}")) / F.lit(3.0)
        return F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor(mid * n))).cast("int")

    key = ["nx", "ny"]
    c = corner.select("tid", cell("x").alias("nx"), cell("y").alias("ny"), F.posexplode(F.array("p0", "p1", "p2")).alias("k", "p")).select("tid", "k", *key, "p.x", "p.y", "p.z")
    shift = c.groupBy(*key).agg((SCALE_Z * F.floor(Z_STEPS * F.min("z") / SCALE_Z)).cast("long").alias("shift_z"))
    c = c.join(shift, key)
    q = c.select("tid", "k", *key, "shift_z", *[quantize_cell(F.col(a), F.col(m) / F.lit(float(n)), n).alias(f"u{a}") for a, m in (("x", "nx"), ("y", "ny"))], F.floor((Z_STEPS * F.col("z") - F.col("shift_z")) / SCALE_Z).cast("int").alias("uz"))
    place = ["ux", "uy", "uz"]
    first = q.groupBy(*key, "shift_z", *place).agg(F.min(F.col("tid") * 3 + F.col("k")).alias("first"))
    own = first.withColumn("vid", F.row_number().over(Window.partitionBy(*key).orderBy("first")).cast("long") - 1)
    v = own.select(F.lit(0).alias("lod"), *key, "vid", *place, "shift_z", F.lit(SCALE_Z).alias("scale_z"))
    t = q.join(own.select(*key, *place, "vid"), [*key, *place]).groupBy(*key, "tid").agg(*[F.max(F.when(F.col("k") == k, F.col("vid"))).alias(f"i{k}") for k in range(3)])
    t = clean.skip_degenerate(t).select(F.lit(0).alias("lod"), *key, "tid", "i0", "i1", "i2")
    box = v.groupBy("lod", *key, "shift_z", "scale_z").agg(F.count("*").alias("vtx_count"), *[f(u).alias(f"{m}_{u}") for u in place for m, f in (("min", F.min), ("max", F.max))])
    count = t.groupBy(*key).agg((3 * F.count("*")).alias("idx_count"))
    return box.join(count, key, "left").withColumn("idx_count", F.coalesce("idx_count", F.lit(0).cast("long"))), v, t


def level_counts(cells: DataFrame) -> DataFrame:
    """(lod, cells, triangles, vertices) of cells (lod, triangles, vertices)."""
    return cells.groupBy("lod").agg(F.count("*").alias("cells"), F.sum("triangles").alias("triangles"), F.sum("vertices").alias("vertices"))


def children(parents: DataFrame, cells: DataFrame) -> DataFrame:
    """(lod, cx, cy, cz of the parent, k, vx, vy, vz of the child): the up to eight cells below each parent, by an equi-join on the child's own half coordinates."""
    kid = cells.select((F.col("lod") + 1).alias("lod"), *[F.floor(F.col(f"c{a}") / 2).alias(f"c{a}") for a in "xyz"], *[F.col(f"c{a}").alias(f"v{a}") for a in "xyz"])
    k = sum((F.pmod(F.col(f"v{a}"), F.lit(2)) * (1 << i) for i, a in enumerate("xyz")), F.lit(0)).cast("int")
    return parents.select("lod", "cx", "cy", "cz").join(kid, ["lod", "cx", "cy", "cz"]).withColumn("k", k)


def _exponent(c: Column) -> Column:
    """The binary exponent of a positive number, exact where log2 rounds across a power of two."""
    e = F.floor(F.log2(c))
    two = F.lit(2.0)
    return F.when(c >= F.pow(two, e + 1), e + 1).when(c < F.pow(two, e), e - 1).otherwise(e)


def half(c: Column) -> Column:
    """The bits of the nearest half-precision number (halves away from zero; below 2^-14 zero, from 2^16 on infinity)."""
    a = F.abs(c)
    e = _exponent(a)
    bits = (e + 15) * 1024 + F.floor(a * F.pow(F.lit(2.0), 10 - e) + F.lit(0.5)) - 1024
    size = F.when(F.isnan(c), 0x7E00).when(a < F.lit(2.0**-14), 0).when(a >= F.lit(2.0**16), 0x7C00).otherwise(bits)
    return (size + F.when(c < 0, 0x8000).otherwise(0)).cast("int")


def short_mantissa(c: Column, bits: int) -> Column:
    """The nearest number with `bits` bits of mantissa (halves away from zero); below the least normal single 0."""
    a = F.abs(c)
    step = F.pow(F.lit(2.0), _exponent(a) - bits)
    return F.when(a < F.lit(2.0**-126), F.lit(0.0)).otherwise(F.floor(a / step + F.lit(0.5)) * step * F.when(c < 0, -1.0).otherwise(1.0))


def unorm(c: Column, bits: int) -> Column:
    top = (1 << bits) - 1
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)) * top + F.lit(0.5)).cast("int")


def snorm(c: Column, bits: int) -> Column:
    top = float((1 << (bits - 1)) - 1)
    v = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))
    return (v * F.lit(top) + F.when(v >= 0, F.lit(0.5)).otherwise(F.lit(-0.5))).cast("int")


def octahedral(x: Column, y: Column, z: Column, bits: int) -> tuple[Column, Column]:
    """A unit vector as two signed numbers: folded onto an octahedron's upper half."""
    s = F.abs(x) + F.abs(y) + F.abs(z)
    px, py = F.when(s > 0, x / s).otherwise(F.lit(0.0)), F.when(s > 0, y / s).otherwise(F.lit(0.0))

    def sign(c: Column) -> Column:
        return F.when(c >= 0, F.lit(1.0)).otherwise(F.lit(-1.0))

    u = F.when(z >= 0, px).otherwise((1 - F.abs(py)) * sign(px))
    v = F.when(z >= 0, py).otherwise((1 - F.abs(px)) * sign(py))
    return snorm(u, bits), snorm(v, bits)


def decode_octahedral(u: Column, v: Column, bits: int) -> tuple[Column, Column, Column]:
    top = float((1 << (bits - 1)) - 1)
    a, b = u / F.lit(top), v / F.lit(top)
    z = 1 - F.abs(a) - F.abs(b)
    t = F.least(z, F.lit(0.0))
    x, y = a + F.when(a >= 0, t).otherwise(-t), b + F.when(b >= 0, t).otherwise(-t)
    n = F.sqrt(x * x + y * y + z * z)
    return x / n, y / n, z / n


def view_ratio(cells: DataFrame, eye: tuple[float, float, float], step: float) -> DataFrame:
    """ratio: the largest distance over the axes from the eye to the cell, in cell widths of its level; 0 inside."""
    w = F.pow(F.lit(2.0), F.col("lod")) * step
    out = F.lit(0.0)
    for c, e in zip(("cx", "cy", "cz"), eye, strict=True):
        out = F.greatest(out, F.col(c) - F.lit(e) / w, F.lit(e) / w - F.col(c) - 1)
    return cells.withColumn("ratio", out)


def select_levels(cells: DataFrame, eye: tuple[float, float, float], step: float, kappa: float, top: int) -> DataFrame:
    """Cells (lod, cx, cy, cz) to draw: at level 0 or far enough, with no ancestor that already is.

    A chain of at most `top` equi-joins with the level above, each level against the drawn-or-covered above.
    """
    seen = view_ratio(cells, eye, step).withColumn("own", (F.col("lod") == 0) | (F.col("ratio") > kappa))
    level = seen.filter(F.col("lod") == top).withColumn("covered", F.lit(False))
    out = level
    for lod in range(top - 1, -1, -1):
        above = level.select(F.col("cx").alias("pcx"), F.col("cy").alias("pcy"), F.col("cz").alias("pcz"), (F.col("own") | F.col("covered")).alias("covered"))
        here = seen.filter(F.col("lod") == lod).select("*", *parent("cx", "cy", "cz"))
        level = here.join(above, ["pcx", "pcy", "pcz"], "left").select(*seen.columns, F.coalesce("covered", F.lit(False)).alias("covered"))
        out = out.unionByName(level)
    return out.filter("own AND NOT covered").select("lod", "cx", "cy", "cz", "ratio")


def visible(boxes: DataFrame, planes: list[tuple[float, float, float, float]]) -> DataFrame:
    """Boxes (min_x.. max_z) not wholly outside any plane (n, d), n.p + d >= 0 being inside."""
    ok = F.lit(True)
    for a, b, c, d in planes:
        far = [F.lit(k) * F.col(f"{'max' if k >= 0 else 'min'}_{axis}") for k, axis in zip((a, b, c), "xyz", strict=True)]
        ok = ok & (far[0] + far[1] + far[2] + F.lit(d) >= 0)
    return boxes.filter(ok)


def box_union(a: str, b: str) -> list[Column]:
    return [f(f"{a}.{n}_{c}", f"{b}.{n}_{c}").alias(f"{n}_{c}") for n, f in (("min", F.least), ("max", F.greatest)) for c in "xyz"]


def box_intersection(a: str, b: str) -> list[Column]:
    return [f(f"{a}.{n}_{c}", f"{b}.{n}_{c}").alias(f"{n}_{c}") for n, f in (("min", F.greatest), ("max", F.least)) for c in "xyz"]
