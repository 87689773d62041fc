"""Registered queries against their SQL on the smallest tables, and shapes with known answers."""

import math
import os
import struct

import numpy as np
import pytest

DATA = "/root/testdata/sf0.001"


def norm(x):
    if isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, bool) or x is None:
        return x
    try:
        return float(x)
    except (TypeError, ValueError):
        return str(x)


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no tables here")
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return c


def registered():
    from reliefspark.plans import load
    from reliefspark.plans.registry import ORACLES

    load()
    return sorted(ORACLES)


@pytest.mark.parametrize("name", registered())
def test_query_equals_sql(spark, duck, name):
    from reliefspark.plans.registry import ORACLES, QUERIES

    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.execute(ORACLES[name])
    names = [x[0] for x in rel.description]
    assert sorted(names) == cols
    want = sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in rel.fetchall()), key=repr)
    assert got == want


def mesh(spark, pos, tri):
    v = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pos)], "vid long, x double, y double, z double")
    return v, spark.createDataFrame([(i, *t) for i, t in enumerate(tri)], "tid long, i0 long, i1 long, i2 long")


def test_two_quads_components(spark):
    from reliefspark.operators import mesh as m

    _, t = mesh(spark, [], [(0, 1, 2), (2, 1, 3), (10, 11, 12), (12, 11, 13)])
    parts = {r["tid"]: r["component"] for r in m.components(t).collect()}
    assert parts == {0: 0, 1: 0, 2: 1, 3: 1}
    assert {r["tid"] for r in m.principal_component(t, m.components(t)).collect()} == {0, 1}


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """Orders of 180 grid rows, beyond the bounds of the queries that have SQL twins."""
    rng, at = np.random.default_rng(4), str(tmp_path_factory.mktemp("wide"))
    rows = [(i, "FOP"[k], round(float(p), 2)) for i, (k, p) in enumerate(zip(rng.choice(3, 18000, p=[0.4, 0.3, 0.3]), rng.random(18000) * 400000, strict=True))]
    spark.createDataFrame(rows, "o_orderkey long, o_orderstatus string, o_totalprice double").write.parquet(f"{at}/orders.parquet")
    return at, rows


def test_whole_mesh_components(spark, wide):
    from reliefspark.plans.registry import QUERIES

    at, rows = wide
    tri = {}
    for k, status, _ in rows:
        if status != "P" and k % 100 < 99 and k < len(rows) - 1 - 100:
            tri[2 * k], tri[2 * k + 1] = (k, k + 1, k + 100), (k + 1, k + 101, k + 100)
    edge, root = {}, {}
    for t, c in tri.items():
        for j in range(3):
            edge.setdefault(frozenset((c[j], c[j - 1])), []).append(t)
    near = {}
    for ts in edge.values():
        for a in ts:
            near.setdefault(a, []).extend(ts)
    for t in sorted(tri):
        todo = [t] if t not in root else []
        while todo:
            u = todo.pop()
            if u not in root:
                root[u] = t
                todo += near[u]
    number = {r: n for n, r in enumerate(sorted(set(root.values())))}
    size = [0] * len(number)
    for r in root.values():
        size[number[r]] += 1
    assert {r["component"]: r["size"] for r in QUERIES["component_sizes"](spark, at).collect()} == dict(enumerate(size))
    best = size.index(max(size))
    want = {(t, *tri[t]) for t, r in root.items() if number[r] == best}
    assert {(r["tid"], r["i0"], r["i1"], r["i2"]) for r in QUERIES["principal_component"](spark, at).collect()} == want


def test_whole_stitch(spark, wide):
    from reliefspark.plans.registry import QUERIES

    at, rows = wide
    a = [(k, float(k // 100), z / 100000) for k, _, z in rows if k % 100 == 99]
    b = [(k, k // 100 + 0.37, z / 100000) for k, _, z in rows if k % 100 == 0 and k % 300]

    def nearest(p, others):
        return min(others, key=lambda q: ((p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2, q[0]))

    to0 = {q[0]: nearest(q, a) for q in b}
    hit = {p[0] for p in to0.values()}
    want = {(1, k): p[1:] for k, p in to0.items()} | {(0, p[0]): (p if p[0] in hit else to0[nearest(p, b)[0]])[1:] for p in a}
    got = {(r["mesh"], r["vid"]): (r["y"], r["z"]) for r in QUERIES["nearest_stitch"](spark, at).collect()}
    assert got == want and max(vid for _, vid in got) > 15000


def test_empty_mesh(spark):
    from reliefspark.operators import mesh as m

    _, t = mesh(spark, [], [])
    assert m.components(t).collect() == [] and m.boundary_vertices(t).collect() == []


def test_plane_and_sphere_normals(spark):
    from reliefspark.operators import knn, normals

    rng = np.random.default_rng(0)
    xy = rng.random((400, 2))
    plane = np.column_stack([xy, 0.3 * xy[:, 0] - 0.2 * xy[:, 1]])
    p = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(plane)], "pid long, x double, y double, z double")
    n = knn.knn(p, p, 12)
    fit = normals.fit_planes(normals.covariance(n, p), p).collect()
    want = np.array([-0.3, 0.2, 1]) / np.linalg.norm([-0.3, 0.2, 1])
    assert all(abs(abs(np.dot([r["nx"], r["ny"], r["nz"]], want)) - 1) < 1e-9 and r["qual"] > 0.99 for r in fit)
    det = normals.fit_determinant(normals.covariance(n, p)).collect()
    assert all(abs(abs(np.dot([r["nx"], r["ny"], r["nz"]], want)) - 1) < 1e-6 for r in det)


def test_knn_is_exact_on_ties(spark):
    from reliefspark.operators import knn

    grid = [(i, float(i % 6), float(i // 6 % 6), float(i // 36)) for i in range(144)]
    p = spark.createDataFrame(grid, "pid long, x double, y double, z double")
    got = {}
    for r in knn.knn(p, p, 7).collect():
        got.setdefault(r["pid"], []).append((r["d2"], r["nbr"]))
    for i, x, y, z in grid:
        want = sorted(((x - a) ** 2 + (y - b) ** 2 + (z - c) ** 2, j) for j, a, b, c in grid)[:7]
        assert sorted(got[i]) == want


def test_unit_cube_cases(spark):
    from reliefspark.operators import points

    rows = [(t, 0, 0, z) for t, top in ((0, 124_900), (1, 125_100), (2, 187_600)) for z in (0, top)]
    df = spark.createDataFrame(rows, "tile int, x long, y long, z long")
    assert {r["tile"]: r["n"] for r in points.unit_cube_transform(df, "tile").collect()} == {0: 6, 1: 2, 2: None}


def test_source_with_equal_times_is_invalid(spark):
    from reliefspark.operators import flightlines

    df = spark.createDataFrame([(i, 1, i, i, 0, 5.0) for i in range(5)] + [(9, 2, 0, 0, 3, 1.0)], "pid long, source_id long, x long, y long, scan_angle int, gps_time double")
    assert not any(r["is_valid"] for r in flightlines.flight_lines(df).collect())


def test_floor_parents(spark):
    from reliefspark.operators import grid

    df = spark.createDataFrame([(c,) for c in (-3, -2, -1, 0, 1, 5)], "c long")
    assert [r[0] for r in df.select(*grid.parent("c")).collect()] == [-2, -1, -1, 0, 0, 2]


def test_las_new_format_record():
    from reliefspark.sources import las

    rec = bytearray(30)
    struct.pack_into("<3iH", rec, 0, 1, -2, 3, 7)
    rec[14], rec[15], rec[16] = 0x21, 0x30, 9
    struct.pack_into("<hHd", rec, 18, -2500, 5, 1.5)
    c = las.decode(bytes(rec), 6, 30)
    assert (c["x"][0], c["y"][0], c["return_number"][0], c["number_of_returns"][0], c["classification"][0], c["scan_angle"][0], c["source_id"][0], c["gps_time"][0]) == (1, -2, 1, 2, 9, -15, 3 << 14 | 5, 1.5)
    with pytest.raises(ValueError):
        las.parse_header(b"nope" + bytes(600))


@pytest.mark.parametrize("fmt", [1, 3, 6])
def test_las_source_ids_over_16_bits(spark, tmp_path, fmt):
    """Formats 1 and 3 keep source ids that need more than the record's 16 bits; files without such ids stay as they were."""
    from reliefspark.sources import las

    ids = [0, 65535, 65536, 90000, 2**31 - 1]
    p = spark.range(50).selectExpr("id x", "-id y", "id z", "2 classification", "cast(id % 7 - 3 as int) scan_angle", f"array({', '.join(map(str, ids))})[cast(id % 5 as int)] source_id", "cast(id as double) gps_time")
    at = f"file://{tmp_path}/wide"
    made = [r["uri"] for r in las.write(p.coalesce(1), at, fmt, records=20).collect()]
    mask = 0xFFFF if fmt == 6 else -1
    want = [(k, ids[k % 5] & mask, -k) for k in range(50)]
    spark.dataSource.register(las.LasSource)
    for rows in (las.read(spark, made, records=6), spark.read.format("las").option("records", 6).load(at)):
        assert sorted((r["x"], r["source_id"], r["y"]) for r in rows.collect()) == want
    one = {c: np.zeros(2, int) for c in ("x", "y", "z", "classification", "scan_angle", "gps_time")}
    assert len(las.encode(one | {"source_id": np.array([0, 65535])}, fmt=1)) == 227 + 2 * 28
    if fmt < 6:
        with pytest.raises(ValueError):
            las.encode(one | {"source_id": np.array([0, 2**31])}, fmt=fmt)


def test_las_roundtrip_of_large_source_ids(spark, tmp_path):
    """The query on events whose user ids need more than 16 bits."""
    from pyspark.sql import functions as F

    from reliefspark import adapters as A
    from reliefspark.plans.registry import QUERIES

    A.table(spark, DATA, "events").limit(500).withColumn("user_id", F.col("event_id") * 200).write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["las_roundtrip"](spark, str(tmp_path))
    want = A.pts(spark, str(tmp_path)).select(*got.columns)
    assert want.agg(F.max("source_id")).first()[0] > 65535 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("step", [2**31, 10**15, -(10**15)])
def test_las_roundtrip_of_source_ids_over_32_bits(spark, tmp_path, step):
    """The query, and the data source, on events whose user ids need more than 32 bits."""
    from pyspark.sql import functions as F

    from reliefspark import adapters as A
    from reliefspark.plans.registry import QUERIES
    from reliefspark.sources import las

    A.table(spark, DATA, "events").limit(500).withColumn("user_id", F.col("event_id") * step).write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["las_roundtrip"](spark, str(tmp_path))
    points = A.pts(spark, str(tmp_path))
    want = sorted(map(tuple, points.select(*got.columns).collect()))
    assert dict(got.dtypes)["source_id"] == "bigint" and sorted(map(tuple, got.collect())) == want
    las.write(points.coalesce(1), f"file://{tmp_path}/las", 3, records=100).collect()
    spark.dataSource.register(las.LasSource)
    rows = spark.read.format("las").option("records", 30).load(f"file://{tmp_path}/las")
    assert sorted(map(tuple, rows.select(*got.columns).collect())) == want


@pytest.mark.parametrize("kind", ["ply", "obj", "mesh"])
def test_mesh_files(kind):
    from reliefspark.sources import meshes

    pos = {c: np.array(v, float) for c, v in zip("xyz", ([0, 1, 0, 1], [0, 0, 1, 1], [0, 0.5, 0.25, 2]), strict=True)}
    tri = np.array([[0, 1, 2], [2, 1, 3]])
    parse, form = meshes.FORMATS[kind]
    attrs, back = parse(form(pos, tri))
    for t in range(2):
        for c in "xyz":
            assert attrs[c][back[t]].tolist() == pos[c][tri[t]].tolist()


def test_ply_variants():
    from reliefspark.sources import meshes

    head = "ply\nformat ascii 1.0\nelement vertex 4\nproperty float x\nproperty float y\nproperty float z\nproperty uchar red\nelement face 1\nproperty list uchar int vertex_index\nend_header\n"
    attrs, tri = meshes.parse_ply((head + "0 0 0 1\n1 0 0 2\n1 1 0 3\n0 1 0 4\n4 0 1 2 3\n").encode())
    assert attrs["r"].tolist() == [1, 2, 3, 4] and tri.tolist() == [[0, 1, 2], [0, 2, 3]]
    assert "r" not in meshes.parse_ply((head + "0 0 0 1\n1 0 0 2\n1 1 0 3\n0 1 0 4\n3 0 1 2\n").encode(), positions_only=True)[0]


def test_tiff():
    from reliefspark.sources import tiff

    a = np.arange(12, dtype="<f4").reshape(3, 4)
    import zlib

    for how, data in ((1, a.tobytes()), (8, zlib.compress(a.tobytes()))):
        tags = [(256, 3, 4), (257, 3, 3), (258, 3, 32), (259, 3, how), (273, 4, 8), (278, 3, 3), (279, 4, len(data)), (339, 3, 3)]
        out = b"II*\0" + struct.pack("<I", 8 + len(data)) + data + struct.pack("<H", len(tags))
        out += b"".join(struct.pack("<HHI", t, k, 1) + struct.pack("<I", v) for t, k, v in tags) + bytes(4)
        assert (tiff.parse(out) == a).all()


def test_orders_and_codecs():
    from reliefspark.operators import order, simplify

    n = 12
    tri = np.array([t for j in range(n - 1) for i in range(n - 1) for k in [j * n + i] for t in ((k, k + 1, k + n), (k + 1, k + n + 1, k + n))])
    canon = lambda t: sorted(min((tuple(np.roll(x, -r)) for r in range(3))) for x in t)
    assert canon(order.unstripify(order.stripify(tri))) == canon(tri)
    assert sorted(order.cache_order(tri)) == list(range(len(tri)))
    shuffled = tri[np.random.default_rng(0).permutation(len(tri))]
    assert order.cache_misses(shuffled[order.cache_order(shuffled)])["acmr"] < order.cache_misses(shuffled)["acmr"]
    assert (order.decode_indices(order.encode_indices(tri)) == tri).all()
    v = np.random.default_rng(1).normal(size=(50, 3)).astype("<f4")
    assert (order.decode_vertices(order.encode_vertices(v)) == v).all()
    pos = np.column_stack([np.arange(n * n) % n, np.arange(n * n) // n, np.zeros(n * n)]).astype(float)
    out, remap = simplify.collapse(pos, tri, 60, 1e9)
    assert len(out) < len(tri) and set(out.ravel()) <= set(remap)
    area = lambda t: np.cross(pos[t[:, 1]] - pos[t[:, 0]], pos[t[:, 2]] - pos[t[:, 0]])[:, 2]
    assert (area(out) > 0).all() and area(out).sum() == pytest.approx(area(tri).sum())


def test_streaming_stats(spark, tmp_path):
    from reliefspark.streaming import tiles

    df = spark.createDataFrame([(1, 3, 0.5), (1, -4, 1.5), (2, 0, 9.0)], "source_id int, scan_angle int, gps_time double")
    df.write.parquet(str(tmp_path / "in"))
    q = tiles.running_stats(tiles.stream(spark, str(tmp_path / "in"), df.schema)).writeStream.outputMode("complete").format("memory").queryName("stats").start()
    q.processAllAvailable()
    q.stop()
    assert {r["source_id"]: (r["n"], r["min_angle"], r["max_angle"]) for r in spark.table("stats").collect()} == {1: (2, -4, 3), 2: (1, 0, 0)}


def test_copc_hierarchy(spark, tmp_path):
    from reliefspark.sources import las

    head = bytearray(375)
    head[:4], head[24], head[25] = b"LASF", 1, 4
    struct.pack_into("<HII", head, 94, 375, 589, 1)
    struct.pack_into("<BHI", head, 104, 7 | 0x80, 36, 0)
    struct.pack_into("<Q", head, 247, 30)
    vlr = bytearray(54)
    vlr[2:6] = b"copc"
    struct.pack_into("<HH", vlr, 18, 1, 160)
    page1 = struct.pack("<4iQIi", 0, 0, 0, 0, 1000, 50, 10) + struct.pack("<4iQIi", 1, 1, 0, 0, 589 + 64, 32, -1)
    page2 = struct.pack("<4iQIi", 1, 1, 0, 0, 2000, 60, 20)
    info = bytearray(160)
    struct.pack_into("<5d2Q2d", info, 0, 50.0, 50.0, 50.0, 50.0, 1.0, 589, 64, 0.0, 1.0)
    path = str(tmp_path / "a.copc.laz")
    with open(path, "wb") as f:
        f.write(bytes(head) + bytes(vlr) + bytes(info) + page1 + page2)
    h = las.parse_header(open(path, "rb").read())
    assert h.copc and h.compressed and h.format == 7 and h.count == 30
    cube, rows = las.copc_cells(path)
    assert cube == (50.0, 50.0, 50.0, 50.0)
    assert sorted(r[:4] + r[6:] for r in rows) == [(0, 0, 0, 0, 10), (1, 1, 0, 0, 20)]
    cells = spark.createDataFrame([r[:4] for r in rows], "level int, x int, y int, z int")
    inside = las.cells_inside(cells, cube[:3], cube[3], (0, 0, 0, 40, 10, 10)).collect()
    assert [r["level"] for r in inside] == [0]
    assert len(las.cells_inside(cells, cube[:3], cube[3], (0, 0, 0, 50, 10, 10)).collect()) == 2


def test_catalogue_and_transform_text(spark, tmp_path):
    from reliefspark.sources import catalogue

    (tmp_path / "c.csv").write_text("http://h/tile_FXX_0650_6536_x.laz\n\nhttp://h/none.laz\n")
    rows = catalogue.read(spark, str(tmp_path / "c.csv"), r"FXX_(\d{4})_(\d{4})").collect()
    assert [(r["tile_x"], r["tile_y"]) for r in rows] == [(650, 6536), (None, None)]
    done = spark.createDataFrame([(650, 6536)], "tile_x int, tile_y int")
    left = catalogue.missing(spark.createDataFrame([(650, 6536), (651, 6536)], "tile_x int, tile_y int"), done)
    assert [tuple(r) for r in left.collect()] == [(651, 6536)]
    t = spark.createDataFrame([(0.123456789, 0.0, -12345.678)], "scale double, shift_xy double, shift_z double")
    assert tuple(catalogue.rounded(t).first()) == (0.123457, 0.0, -12345.7)


def point_records(rng, n, kind):
    """Points of every field's whole range (2), of four channels with jumping times (1), or of one steady scanner (0)."""
    from reliefspark.sources import laz

    r = np.zeros(n, laz._RECORD)
    r["x"], r["y"], r["z"] = np.cumsum(rng.integers(-50, 50, n)), np.cumsum(rng.integers(-50, 50, n)), rng.integers(0, 5000, n)
    r["intensity"], r["classification"], r["source"] = rng.integers(0, 3000, n), rng.integers(0, 20, n), 60000 + rng.integers(0, 5, n)
    r["returns"] = rng.integers(1, 6, n) << 4 | rng.integers(1, 6, n)
    r["flags"] = rng.integers(0, 2, n) * 5 | (rng.integers(0, 4, n) if kind else 0) << 4 | rng.integers(0, 4, n) << 6
    r["angle"] = rng.integers(-5000, 5000, n) if kind else np.arange(n) // 100 - 50
    r["time"] = 1e8 + (np.arange(n) // 3 * 1e-5 if kind == 0 else np.cumsum(rng.choice([0, 1e-5, 2e-5, 1e-3, 5, -1e-5, -1], n)))
    if kind == 2:
        r["time"] = rng.choice([1e8, -5.0, 3e3, 7e9], n) + rng.random(n) * rng.choice([0, 1e-6, 1e-3], n)
        for c, bits in (("x", 32), ("y", 32), ("z", 32), ("angle", 16)):
            r[c] = rng.integers(-(2 ** (bits - 1)), 2 ** (bits - 1), n)
        for c in ("intensity", "source"):
            r[c] = rng.integers(0, 65536, n)
        r["returns"], r["classification"] = rng.integers(0, 256, n), rng.integers(0, 256, n)
    return r


@pytest.mark.parametrize("kind", [0, 1, 2])
def test_compressed_chunks(kind):
    from reliefspark.sources import laz

    rng = np.random.default_rng(kind)
    for n in (1, 2, 3, 50, 3000):
        r = point_records(rng, n, kind)
        packed = laz.write_chunk(r)
        assert (laz.read_chunk(packed, 6, 30, n) == r).all()
        # A layer of a format with colours and an extra byte is skipped.
        if n > 1:
            head, sizes, rest = packed[:30], struct.unpack_from("<10I", packed, 30), packed[70:]
            wide = head + bytes(7) + struct.pack("<12I", *sizes, 5, 3) + rest + bytes(8)
            assert (laz.read_chunk(wide, 7, 37, n) == r).all()
    assert len(laz.write_chunk(point_records(rng, 3000, 0))) < 3000 * 30 / 3


def test_chunk_tables():
    from reliefspark.sources import laz

    chunks = [(50000, 1234), (50000, 99999), (17, 2**31), (3, 20)]
    assert laz.chunk_table(laz.write_table(chunks, True), 0, laz.VARYING) == chunks
    fixed = [(50000, 1234), (50000, 99999), (3, 20)]
    assert laz.chunk_table(laz.write_table(fixed, False), 100003, 50000) == fixed


def test_return_contexts():
    """The contexts of return counts: symmetric, the published first rows, six values."""
    from reliefspark.sources import laz

    table = [[laz._return_class(n, r) for r in range(16)] for n in range(16)]
    assert table == [list(c) for c in zip(*table, strict=True)]
    assert table[0][:9] == [0, 1, 2, 3, 4, 5, 3, 4, 4] and table[1][:4] == [1, 0, 1, 3] and table[2][:4] == [2, 1, 2, 4]
    assert {v for row in table for v in row} == set(range(6)) and all(table[k][k] == 5 for k in range(3, 16))


def test_plans_of_large_inputs(spark):
    """No window over all rows, no sorting aggregation."""
    from reliefspark.plans.registry import QUERIES

    for name in ("dense_remap", "mesh_join_all", "full_mesh_components", "flight_lines", "vertex_normals", "recut_mesh", "voxel_simplify", "cell_stats"):
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan, name
        assert "Window" not in plan or "SinglePartition" not in plan, name


def test_numbering_by_ranges(spark):
    from reliefspark.lineage import numbered

    df = spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 100003 AS place")
    got = sorted((r["place"], r["n"]) for r in numbered(df, "place", "n").collect())
    assert [n for _, n in got] == list(range(5000)) and len({p for p, _ in got}) == 5000


def test_components_across_tasks(spark):
    """A long chain and a star, cut over all tasks."""
    from reliefspark.operators.mesh import label_components

    edges = [(k, k + 1) for k in range(999)] + [(2000, 2000 + k) for k in range(1, 300)] + [(5000, 5001)]
    rng = np.random.default_rng(2)
    rng.shuffle(edges)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in edges], "a long, b long").repartition(6)
    got = {r["node"]: r["component"] for r in label_components(df).collect()}
    assert got == {**{k: 0 for k in range(1000)}, **{2000 + k: 2000 for k in range(300)}, 5000: 5000, 5001: 5000}


def test_overdraw_order_and_analysis(spark):
    from reliefspark.operators import order
    from reliefspark.plans.registry import QUERIES

    # Two parallel squares facing up: seen from above the lower one drawn first shades every pixel twice.
    pos = np.array([[x, y, z] for z in (0.0, 5.0) for y in (0.0, 9.0) for x in (0.0, 9.0)])
    low, high = [[0, 1, 2], [1, 3, 2]], [[4, 5, 6], [5, 7, 6]]
    first, last = order.overdraw(pos, np.array(high + low)), order.overdraw(pos, np.array(low + high))
    assert first < last and abs(last - 2) < 0.1 and abs(first - 1) < 0.1
    o = order.overdraw_order(pos, np.array(low + high), np.array([0, 0, 1, 1]))
    assert o.tolist() == [2, 3, 0, 1]
    rows = QUERIES["overdraw_clusters"](spark, DATA).collect()
    by = {}
    for r in rows:
        by.setdefault(r["mesh_id"], []).append((r["place"], r["cluster"]))
        assert r["before"] >= 1 and r["after"] >= 1
    assert all(sorted(c for _, c in v) == list(range(len(v))) for v in by.values())


def test_propagation_and_pyramid(spark):
    """All passes against plain loops; every level's triangles are real and fewer."""
    from reliefspark.plans.cloud_queries import _nbrs, _st
    from reliefspark.plans.registry import QUERIES

    near = {}
    for r in _nbrs(spark, DATA).collect():
        near.setdefault(r["pid"], []).append(r["nbr"])
    state = {r["pid"]: [np.array([r["nx"], r["ny"], r["nz"]]), r["qual"], r["orient"]] for r in _st(spark, DATA).collect()}
    before = -1
    for _ in range(99):
        unset = sum(s[2] < 3 for s in state.values())
        if unset in (0, before):
            break
        before, won = unset, {}
        for p, (n, q, o) in state.items():
            if o in (1, 2):
                d = [(n @ state[k][0]) for k in near[p] if state[k][2] >= 3 and abs(n @ state[k][0]) > 0.85 + 0.15 * (1 - q * state[k][1])]
                major = sum(np.sign(d))
                if major and abs(major) >= len(d) // 2:
                    won[p] = major
        seen = {k for p in won for k in near[p]}
        for p, s in state.items():
            if p in won:
                s[0], s[2] = (-s[0] if won[p] < 0 else s[0]), 4
            elif s[2] < 2:
                s[2] = 1 if p in seen else 0
    got = {r["pid"]: (round(r["nx"], 9), r["orient"]) for r in QUERIES["orient_propagate"](spark, DATA).collect()}
    assert got == {p: (round(float(n[0]), 9), o) for p, (n, _, o) in state.items()}
    levels = {}
    for r in QUERIES["lod_pyramid"](spark, DATA).collect():
        assert len({r["i0"], r["i1"], r["i2"]}) == 3
        levels[r["lod"]] = levels.get(r["lod"], 0) + 1
    assert sorted(levels) == [0, 1, 2] and levels[0] > levels[1] > levels[2]


def test_rounding_orients_no_point_without_quality(spark):
    """Equal normals whose product is rounded above 1 give no vote where the quality asks for more than 1."""
    from reliefspark.operators import normals

    rng = np.random.default_rng(1)
    n = next(n.tolist() for v in rng.normal(size=(1000, 3)) if ((n := v / np.sqrt((v * v).sum())) * n)[0] + (n * n)[1] + (n * n)[2] > 1)
    state = spark.createDataFrame([(1, *n, 0.0, 1), (2, *n, 0.9, 6), (3, *n, 0.9, 1)], "pid long, nx double, ny double, nz double, qual double, orient int")
    near = spark.createDataFrame([(a, b) for a in (1, 2, 3) for b in (a, 2)], "pid long, nbr long")
    assert {r["pid"]: r["orient"] for r in normals.propagate(state, near).collect()} == {1: 0, 2: 6, 3: 4}


def test_rounding_of_equal_normals_is_the_sqls(spark, tmp_path):
    """Points without quality that share their neighbours with a good one follow it where the SQL's rounding has them do so, and nowhere else."""
    import duckdb

    from reliefspark.plans.registry import ORACLES, QUERIES

    rng = np.random.default_rng(7)
    ids = np.arange(100_000)
    x, y = ids * 7919 % 100000, ids * 104729 % 100000
    rows = []
    for a in range(6):
        for b in range(6):
            ax, ay = 5000 + 16000 * a, 5000 + 16000 * b
            own = ids[(abs(x - ax) < 2000) & (abs(y - ay) < 2000)]
            own = own[np.argsort((x[own] - ax) ** 2 + (y[own] - ay) ** 2, kind="stable")][:15]
            for n, i in enumerate(own.tolist()):
                # A flat cluster with its middle point far above it.
                z = -(int(x[i]) // 4 + int(y[i]) // 9) + int(rng.integers(0, 20)) + 400 * (n == 0)
                rows.append((i, [z / 3000.0, 0.0]))
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"file://{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = {r[0]: (r[-2], r[-1]) for r in con.execute(ORACLES["oriented_points"]).fetchall()}
    got = {r["pid"]: (r["qual"], r["orient"]) for r in QUERIES["oriented_points"](spark, str(tmp_path)).collect()}
    assert sum(q == 0 and o >= 3 for q, o in want.values()) > 0
    assert got == want


def test_region_is_its_tiles(spark):
    """All tiles at once give what each tile with its halo gives alone."""
    from pyspark.sql import functions as F

    from reliefspark.plans import pipelines

    rng = np.random.default_rng(5)
    rows = []
    for tx in (0, 1):
        for k in range(500):
            x, y = int(rng.integers(0, 100000)), int(rng.integers(0, 100000))
            rows.append((tx, 0, k, x, y, int(3000 + 2000 * math.sin((tx * 100000 + x) / 30000) + rng.integers(0, 40)), 1 + k % 2, int(rng.integers(-20, 20)), float(k), 2))
    raw = spark.createDataFrame(rows, "tile_x int, tile_y int, pid long, x long, y long, z long, source_id int, scan_angle int, gps_time double, classification int")
    got = pipelines.region_points(raw).collect()
    assert sum(r["own"] is None for r in got) == 4 and not any(r["own"] for r in got if r["pid"] is None)
    halo = pipelines.with_halo(raw).cache()
    for tx in (0, 1):
        alone = halo.filter(F.col("tile_x") == tx).withColumn("id", F.col("pid") + F.when(F.col("own"), 0).otherwise(100000))
        one = {r["pid"]: r for r in pipelines.oriented_points(alone.drop("pid").withColumnRenamed("id", "pid")).collect()}
        want = {p: (round(r["qual"], 6), r["orient"]) for p, r in one.items() if r["orient"] >= 3}
        mine = {r["pid"] + (0 if r["own"] else 100000): (round(r["qual"], 6), r["orient"]) for r in got if r["tile_x"] == tx and r["pid"] is not None}
        assert mine == want and len(mine) > 400


def test_passes_of_a_region_are_no_jobs(spark):
    """All passes of a tile are made in one task, so the jobs stay few; sources of large ids stay apart."""
    from reliefspark.plans import pipelines

    rng = np.random.default_rng(3)
    raw = spark.createDataFrame(
        [(t, 0, k, int(rng.integers(20000, 80000)), int(rng.integers(20000, 80000)), int(rng.integers(0, 9000)), 200_000 - 131_072 * t, int(rng.integers(-20, 20)), float(k), 2) for t in (0, 1) for k in range(600)],
        "tile_x int, tile_y int, pid long, x long, y long, z long, source_id int, scan_angle int, gps_time double, classification int",
    )
    spark.sparkContext.setJobGroup("region", "region")
    try:
        got = pipelines.region_points(raw).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("region")) < 60
    for t in (0, 1):
        one = pipelines.region_points(raw.filter(f"tile_x = {t}")).collect()
        assert sorted((r["pid"], r["orient"]) for r in one if r["own"]) == sorted((r["pid"], r["orient"]) for r in got if r["own"] and r["tile_x"] == t)


@pytest.mark.parametrize("n, m, k", [(500, 700, 15), (300, 5, 15), (1000, 1000, 1)])
def test_nearest_in_a_block(n, m, k):
    """The block's search is brute force's, equal distances by id."""
    from reliefspark.operators import knn

    rng = np.random.default_rng(n)
    at, to, ids = (np.round(rng.random((n, 3)) * (1, 1, 0.1), 2), np.round(rng.random((m, 3)) * (1, 1, 0.1), 2), rng.permutation(m))
    want = []
    for i in range(n):
        d = at[i] - to
        d2 = d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1] + d[:, 2] * d[:, 2]
        want += [(i, int(ids[j]), float(d2[j]), r + 1) for r, j in enumerate(np.lexsort((ids, d2))[:k])]
    assert sorted(zip(*(c.tolist() for c in knn.nearest(at, to, ids, k)), strict=True)) == sorted(want)


def test_cell_width_of_the_fullest_tile(spark):
    """With a key the width fits its points, not those of all tiles together."""
    from reliefspark.operators import knn

    p = spark.range(900).selectExpr("id pid", "id % 9 tile", "(id * 7 % 101) / 101D x", "(id * 31 % 103) / 103D y", "0D z")
    one = knn.cell_width(p.filter("tile = 0"), 15)[0]
    assert abs(knn.cell_width(p, 15, "tile")[0] / one - 1) < 0.1 and knn.cell_width(p, 15)[0] < one / 2


def test_stage_times_and_cleaning(spark, tmp_path):
    from reliefspark import lineage

    times = lineage.StageTimes()
    for name in ("read", "fit", "read"):
        with times.stage(name):
            sum(range(1000))
    rows = times.table(spark).collect()
    assert [r["stage"] for r in rows] == ["read", "fit"] and abs(sum(r["percent"] for r in rows) - 100) < 1e-6
    spark.range(3).write.parquet(f"file://{tmp_path}/stage")
    assert lineage.clean(spark, f"file://{tmp_path}/stage", f"file://{tmp_path}/none") == [f"file://{tmp_path}/stage"]
    assert not (tmp_path / "stage").exists()
