"""The composed work flows: oriented points, finished meshes and level-of-detail pyramids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import cut, numbered
from ..operators import clean, flightlines, grid, knn, mesh, normals, points, simplify, surface
from ..schema import HALO_CM, NONE, TILE_CM


def _oriented(p: DataFrame, lines: DataFrame, k: int, tolerance: float, use_scan: bool, most: int) -> DataFrame:
    """Written points (tile, pid, x, y, z, source_id, scan_angle, ...) with nx, ny, nz, qual, orient.

    A task searches and another propagates in a whole tile; beyond normals.MOST_ROWS points a tile, both are joins.
    """
    state = normals.planes(p, k, "tile")
    whole = state is not None
    if not whole:
        near = knn.knn(p, p, k, key="tile")
        state = p.join(normals.fit_planes(normals.covariance(near, p), p), "pid")
    columns = state.columns
    state = state.withColumn("orient", F.lit(NONE)).join(lines.drop("n"), "source_id", "left")
    if use_scan:
        state = normals.orient_by_beam(state)
    state = normals.orient_up(state).select(*columns, "orient")
    return normals.propagate_lists(state, "tile", tolerance, most) if whole else normals.propagate(state, near, tolerance, most)


def oriented_points(raw: DataFrame, k: int = 15, tolerance: float = 0.85, use_scan: bool = True, most: int = 99) -> DataFrame:
    """Points (pid, x, y, z in cm, source_id, scan_angle, gps_time) of one tile with normals, quality, state and colour.

    Flight lines, unit cube, neighbours, plane fits, orientation by beam and by height, then propagation.
    """
    lines = flightlines.flight_lines(raw)
    cube = points.to_unit_cube(raw, points.unit_cube_transform(raw))
    p = cut(cube.select("pid", F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z"), "source_id", "scan_angle"))
    state = _oriented(p.withColumn("tile", F.lit(0)), lines, k, tolerance, use_scan, most).drop("tile", "source_id", "scan_angle")
    return points.quality_rgb(points.weight_normals(state))


#: Ids of a tile's points and sources are counted on from these multiples of the tile's number.
POINTS_A_TILE, SOURCES_A_TILE = 1 << 40, 1 << 40


def with_halo(points_: DataFrame) -> DataFrame:
    """Points (tile_x, tile_y, x, y, ...) of each tile, and those of its up to 8 neighbours that lie in its halo, in its frame; `own` tells them apart."""
    tiles = points_.select("tile_x", "tile_y").distinct()
    steps = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    moved = points_.withColumn("d", F.explode(steps)).withColumns({"dx": F.col("d.dx"), "dy": F.col("d.dy")})
    moved = points.rebase(moved).withColumns({"tile_x": F.col("tile_x") - F.col("dx"), "tile_y": F.col("tile_y") - F.col("dy"), "own": (F.col("dx") == 0) & (F.col("dy") == 0)})
    near = F.lit(True)
    for c in "xy":
        near = near & (F.col(c) > -HALO_CM) & (F.col(c) < TILE_CM + HALO_CM)
    return moved.filter(F.col("own") | near).drop("d", "dx", "dy").join(tiles, ["tile_x", "tile_y"], "left_semi")


def region_points(raw: DataFrame, k: int = 15, tolerance: float = 0.85, use_scan: bool = True, most: int = 99) -> DataFrame:
    """oriented_points() of all tiles at once: points (tile_x, tile_y, pid, x, y, z, source_id, scan_angle, gps_time, classification).

    Ground points of a tile and its neighbours' halo are worked on in the tile's unit cube; undecided points go, and
    each tile gets its two corner points (pid null). Rows: tile_x, tile_y, pid, source of the result as in
    oriented_points(), own (false in the halo, null for corners). Pids are unique in their tile and below POINTS_A_TILE.
    """
    around = points.filter_local(with_halo(raw))
    number = numbered(raw.select("tile_x", "tile_y").distinct().withColumn("place", F.col("tile_x").cast("long") * (1 << 31) + F.col("tile_y")), "place", "tile").drop("place")
    # A halo point may have the pid of one of the tile's own: its home tile's number parts them.
    home = around.withColumns({"hx": F.col("tile_x") + F.floor(F.col("x") / TILE_CM), "hy": F.col("tile_y") + F.floor(F.col("y") / TILE_CM)})
    p = home.join(number, ["tile_x", "tile_y"])
    side = (F.col("hx") - F.col("tile_x") + 1) * 3 + F.col("hy") - F.col("tile_y") + 1
    p = p.withColumns({"id": (F.col("tile") * 9 + side) * F.lit(POINTS_A_TILE // 16) + F.col("pid"), "source": F.col("tile") * SOURCES_A_TILE + F.col("source_id")}).drop("hx", "hy")
    p = cut(p)
    flat = p.select("tile", F.col("id").alias("pid"), "x", "y", "z", F.col("source").alias("source_id"), "scan_angle", "gps_time", F.col("pid").alias("point"), "own")
    lines = flightlines.flight_lines(flat)
    cube = points.to_unit_cube(flat, points.unit_cube_transform(flat, "tile"), "tile")
    c = cut(cube.select("tile", "pid", F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z"), "source_id", "scan_angle", "point", "own"))
    done = _oriented(c, lines, k, tolerance, use_scan, most).select("tile", "pid", "x", "y", "z", "nx", "ny", "nz", "qual", "orient", "point", "own")
    done = points.weight_normals(points.drop_unoriented(done))
    ends = number.select("tile").withColumn("e", F.explode(F.array(F.lit(0.0), F.lit(1.0)))).select("tile", *[F.col("e").alias(a) for a in "xyz"], *[F.lit(0.0).alias(n) for n in ("nx", "ny", "nz", "qual")])
    rows = done.drop("pid").withColumnRenamed("point", "pid").unionByName(ends, allowMissingColumns=True)
    return points.quality_rgb(rows).join(number, "tile").drop("tile")


def finished_mesh(raw: DataFrame, cell: float) -> tuple[DataFrame, DataFrame]:
    """A tile's surface: reconstructed, largest component, compacted, boundary snapped."""
    v, t = surface.height_field(raw, cell)
    t = cut(t)
    t = mesh.principal_component(t, mesh.components(t))
    v, t = clean.compact(v.select("vid", "x", "y", "z"), t)
    return clean.snap_boundary(v, t), t


def build_pyramid(vertices: DataFrame, triangles: DataFrame, base: tuple[float, float, float], step: float, levels: int, ratio: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """Triangles (lod, cx, cy, cz, i0, i1, i2) and parent maps (lod, bcx, bcy, bcz, vid, parent).

    Level 0 by grid cells, each further level simplified in blocks of 2 x 2 x 2 parents. Blocks have odd bases, so that
    the borders kept by one level lie inside the blocks of the next but one; a triangle goes to the parent that holds its
    barycentre. A parent map of level `lod` tells what each vertex of a block of the level below became.
    """
    cells = grid.partition(vertices, triangles, base, step)
    now = cut(triangles.join(cells, "tid").select(F.lit(0).alias("lod"), "cx", "cy", "cz", "tid", "i0", "i1", "i2"))
    out, maps = now.drop("tid"), None
    key = ["bcx", "bcy", "bcz"]
    for lod in range(1, levels + 1):
        parents = now.select(*grid.parent("cx", "cy", "cz"), "tid", "i0", "i1", "i2").withColumnsRenamed({"pcx": "cx", "pcy": "cy", "pcz": "cz"})
        blocks = parents.select(*grid.block_base("cx", "cy", "cz"), "tid", "i0", "i1", "i2")
        made = cut(simplify.collapse_blocks(vertices, blocks, key, ratio, both=True))
        # Ids of their own, fixed by the written table: blocks may hold equal triangles.
        small = cut(made.filter("i0 IS NOT NULL").select("i0", "i1", "i2").withColumn("tid", F.monotonically_increasing_id()))
        moves = made.filter("vid IS NOT NULL").select(F.lit(lod).alias("lod"), *key, "vid", F.col("remap").alias("parent"))
        maps = moves if maps is None else maps.unionByName(moves)
        cells = grid.partition(vertices, small, base, step * 2**lod)
        now = cut(small.join(cells, "tid").select(F.lit(lod).alias("lod"), "cx", "cy", "cz", "tid", "i0", "i1", "i2"))
        out = out.unionByName(now.drop("tid"))
    return out, maps
