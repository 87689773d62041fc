"""Single-band float32 GeoTIFF rasters: uncompressed, LZW or deflate, in strips or tiles."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def _lzw(data: bytes) -> bytes:
    table: list[bytes] = []
    out, bits, value, pos, width, last = bytearray(), 0, 0, 0, 9, b""
    while True:
        while bits < width and pos < len(data):
            value, bits, pos = value << 8 | data[pos], bits + 8, pos + 1
        if bits < width:
            return bytes(out)
        code = value >> (bits - width) & ((1 << width) - 1)
        bits -= width
        value &= (1 << bits) - 1
        if code == 257:
            return bytes(out)
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out += entry
        if last:
            table.append(last + entry[:1])
        last = entry
        width = max(9, min(12, (len(table) + 1).bit_length()))


def _restored(raw: bytes, rows: int, w: int, e: str, predictor: int) -> np.ndarray:
    """A block's values; predictor 2: differences of the words along a row, 3: of its byte planes, the most significant first."""
    if predictor == 3:
        planes = np.cumsum(np.frombuffer(raw, np.uint8).reshape(rows, 4 * w), axis=1, dtype=np.uint8).reshape(rows, 4, w)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(">f4").reshape(rows, w)
    if predictor == 2:
        return np.cumsum(np.frombuffer(raw, e + "u4").reshape(rows, w), axis=1, dtype=np.uint32).astype(e + "u4").view(e + "f4")
    return np.frombuffer(raw, e + "f4").reshape(rows, w)


def encode(a: np.ndarray, predictor: int = 1, rows: int = 16) -> bytes:
    """A little-endian float32 raster in deflated strips of `rows` rows."""
    ny, nx = a.shape
    strips = []
    for y in range(0, ny, rows):
        part = np.ascontiguousarray(a[y : y + rows], "<f4")
        if predictor == 3:
            planes = part.astype(">f4").view(np.uint8).reshape(len(part), nx, 4).transpose(0, 2, 1).reshape(len(part), 4 * nx)
            raw = np.diff(planes, axis=1, prepend=np.uint8(0)).astype(np.uint8).tobytes()
        elif predictor == 2:
            raw = np.diff(part.view("<u4"), axis=1, prepend=np.uint32(0)).astype("<u4").tobytes()
        else:
            raw = part.tobytes()
        strips.append(zlib.compress(raw))
    n = len(strips)
    tags = [(256, 4, 1, nx), (257, 4, 1, ny), (258, 3, 1, 32), (259, 3, 1, 8), (262, 3, 1, 1), (273, 4, n, None), (277, 3, 1, 1), (278, 4, 1, rows), (279, 4, n, None), (317, 3, 1, predictor), (339, 3, 1, 3)]
    body = 8 + 2 + 12 * len(tags) + 4
    places = body + 8 * n + np.concatenate([[0], np.cumsum([len(s) for s in strips])])[:-1]
    lists = {273: places.tolist(), 279: [len(s) for s in strips]}
    out = bytearray(struct.pack("<2sHIH", b"II", 42, 8, len(tags)))
    for tag, kind, count, value in tags:
        if tag in lists:
            value = lists[tag][0] if n == 1 else body + (0 if tag == 273 else 4 * n)
        out += struct.pack("<HHII", tag, kind, count, value)
    return bytes(out) + struct.pack("<I", 0) + struct.pack(f"<{2 * n}I", *lists[273], *lists[279]) + b"".join(strips)


def parse(data: bytes) -> np.ndarray:
    """The first band as rows of float32."""
    e = "<" if data[:2] == b"II" else ">"
    at = struct.unpack_from(e + "I", data, 4)[0]
    tags: dict[int, tuple] = {}
    kinds = {1: "B", 3: "H", 4: "I", 12: "d", 11: "f"}
    for k in range(struct.unpack_from(e + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(e + "HHI", data, at + 2 + 12 * k)
        if kind not in kinds:
            continue
        form = f"{e}{n}{kinds[kind]}"
        place = at + 10 + 12 * k
        tags[tag] = struct.unpack_from(form, data, place if struct.calcsize(form) <= 4 else struct.unpack_from(e + "I", data, place)[0])
    nx, ny, how = tags[256][0], tags[257][0], tags.get(259, (1,))[0]
    if tags.get(258, (32,))[0] != 32 or tags.get(339, (3,))[0] != 3:
        raise ValueError("only float32 rasters are read")
    how_before = tags.get(317, (1,))[0]
    if how_before not in (1, 2, 3):
        raise ValueError(f"predictor {how_before} is not read")
    unpack = {1: bytes, 5: _lzw, 8: zlib.decompress, 32946: zlib.decompress}[how]
    out = np.zeros((ny, nx), np.float32)
    tiled = 322 in tags
    w, h = (tags[322][0], tags[323][0]) if tiled else (nx, min(ny, tags.get(278, (ny,))[0]))
    starts, sizes = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
    across = -(-nx // w)
    for k, (s, n) in enumerate(zip(starts, sizes, strict=True)):
        y, x = k // across * h, k % across * w
        rows = h if tiled else min(h, ny - y)
        block = _restored(unpack(data[s : s + n])[: 4 * rows * w], rows, w, e, how_before)
        out[y : y + rows, x : x + w] = block[: ny - y, : nx - x]
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """(path, nx, ny, px, py, alt) of all .tif files of a folder, a row a pixel."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, c in zip(b["path"], b["content"], strict=True):
                a = parse(bytes(c))
                ny, nx = a.shape
                for y in range(0, ny, 256):  # rows in parts, so that a batch stays small
                    part = a[y : y + 256]
                    yield pd.DataFrame({"path": p, "nx": nx, "ny": ny, "px": np.tile(np.arange(nx), len(part)), "py": np.repeat(np.arange(y, y + len(part)), nx), "alt": part.ravel().astype(float)})

    return raw.mapInPandas(run, "path string, nx int, ny int, px int, py int, alt double")
