"""Compressed point chunks (LAZ, layered, point formats 6 to 8) in columns.

A chunk holds its first point as it is and then one entropy-coded layer for each field.
The layers depend on one another in one direction only - returns, channels and changes come
first - so each is walked by itself, over all points, with what the earlier ones gave as
plain columns.  The same walk reads and writes: a coder's calls take the number to write and
give the number read.  Colours, near infrared, user data and extra bytes are not read; their
layers are skipped, which needs no decoding.
"""

from __future__ import annotations

import struct
from bisect import bisect_right, insort
from itertools import accumulate

import numpy as np

#: Fixed values of the format: interval bounds, precision of symbol and bit models.
TOP, BOTTOM, SYMBOL_BITS, BIT_BITS = 0xFFFFFFFF, 1 << 24, 15, 13
#: Codes of the time layer - the largest multiple, the least (negative) one, a whole number.
MULTIPLE, BACKWARD, WHOLE = 500, -10, 511
#: Fixed value: the record that names the compressor, and the size of varying chunks.
LASZIP, VARYING = ("laszip encoded", 22204), 0xFFFFFFFF
#: Bytes of a point of each format.
POINT_BYTES = {6: 30, 7: 36, 8: 38}
#: Layers of a point beside those of colour (1), infrared (1) and each extra byte (1).
LAYERS = 9


class Symbols:
    """Adaptive frequencies of n symbols: counts since the last rescaling and their scaled running sums."""

    __slots__ = ("counts", "total", "cycle", "left", "sums")

    def __init__(self, n: int) -> None:
        self.counts, self.total, self.cycle = [1] * n, 0, n
        self.rescale()
        self.left = self.cycle = (n + 6) >> 1

    def rescale(self) -> None:
        self.total += self.cycle
        if self.total > 1 << SYMBOL_BITS:
            self.counts = [(c + 1) >> 1 for c in self.counts]
            self.total = sum(self.counts)
        scale = (1 << 31) // self.total
        self.sums = [scale * s >> (31 - SYMBOL_BITS) for s in accumulate(self.counts[:-1], initial=0)]
        self.left = self.cycle = min(5 * self.cycle >> 2, (len(self.counts) + 6) << 3)

    def seen(self, k: int) -> None:
        self.counts[k] += 1
        self.left -= 1
        if not self.left:
            self.rescale()


class Bit:
    """The adaptive probability of a zero."""

    __slots__ = ("zeros", "total", "chance", "cycle", "left")

    def __init__(self) -> None:
        self.zeros, self.total, self.chance, self.cycle, self.left = 1, 2, 1 << (BIT_BITS - 1), 4, 4

    def seen(self, bit: int) -> None:
        self.zeros += not bit
        self.left -= 1
        if self.left:
            return
        self.total += self.cycle
        if self.total > 1 << BIT_BITS:
            self.total, self.zeros = (self.total + 1) >> 1, (self.zeros + 1) >> 1
            self.total += self.zeros == self.total
        self.chance = self.zeros * ((1 << 31) // self.total) >> (31 - BIT_BITS)
        self.cycle = self.left = min(5 * self.cycle >> 2, 64)


class Reader:
    """Numbers out of a layer's bytes; what a call is given as the number is ignored."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.width = data + bytes(8), 4, TOP
        self.value = int.from_bytes(self.data[:4], "big")

    def _widen(self) -> None:
        while self.width < BOTTOM:
            self.value = (self.value << 8 | self.data[self.at]) & TOP
            self.at += 1
            self.width <<= 8

    def symbol(self, m: Symbols, _=None) -> int:
        step = self.width >> SYMBOL_BITS
        k = bisect_right(m.sums, self.value // step) - 1
        low = m.sums[k] * step
        self.width = (m.sums[k + 1] * step if k + 1 < len(m.sums) else self.width) - low
        self.value -= low
        if self.width < BOTTOM:
            self._widen()
        m.seen(k)
        return k

    def bit(self, m: Bit, _=None) -> int:
        part = m.chance * (self.width >> BIT_BITS)
        one = int(self.value >= part)
        if one:
            self.value -= part
            self.width -= part
        else:
            self.width = part
        if self.width < BOTTOM:
            self._widen()
        m.seen(one)
        return one

    def bits(self, n: int, _=None) -> int:
        if n > 19:
            low = self.bits(16)
            return self.bits(n - 16) << 16 | low
        self.width >>= n
        k = self.value // self.width
        self.value -= k * self.width
        if self.width < BOTTOM:
            self._widen()
        return k


class Writer:
    """Numbers into a layer's bytes; `used` tells whether there was any."""

    def __init__(self) -> None:
        self.out, self.base, self.width, self.used = bytearray(), 0, TOP, False

    def _narrow(self, low: int, width: int) -> None:
        self.used = True
        self.base += low
        self.width = width
        if self.base > TOP:  # the carry runs into the bytes written
            self.base &= TOP
            k = len(self.out) - 1
            while self.out[k] == 255:
                self.out[k] = 0
                k -= 1
            self.out[k] += 1
        while self.width < BOTTOM:
            self.out.append(self.base >> 24)
            self.base = self.base << 8 & TOP
            self.width <<= 8

    def symbol(self, m: Symbols, k: int) -> int:
        step = self.width >> SYMBOL_BITS
        low = m.sums[k] * step
        self._narrow(low, (m.sums[k + 1] * step if k + 1 < len(m.sums) else self.width) - low)
        m.seen(k)
        return k

    def bit(self, m: Bit, one: int) -> int:
        part = m.chance * (self.width >> BIT_BITS)
        self._narrow(part if one else 0, self.width - part if one else part)
        m.seen(one)
        return one

    def bits(self, n: int, k: int) -> int:
        if n > 19:
            self.bits(16, k & 0xFFFF)
            self.bits(n - 16, k >> 16)
            return k
        self._narrow(k * (self.width >> n), self.width >> n)
        return k

    def data(self) -> bytes:
        return bytes(self.out) + self.base.to_bytes(4, "big") if self.used else b""


class Corrected:
    """Whole numbers of some bits as corrections of a prediction: the correction's size class, then its place in the class."""

    HIGH = 8

    def __init__(self, bits: int, contexts: int) -> None:
        self.span, self.classes = 1 << bits, [Symbols(bits + 1) for _ in range(contexts)]
        self.small, self.places = Bit(), [Symbols(1 << min(k, self.HIGH)) for k in range(1, bits + 1)]
        self.signed, self.k = bits == 32, 0

    def code(self, coder: Reader | Writer, guess: int, context: int, number: int = 0) -> int:
        """The number; k keeps its correction's size class."""
        half = self.span // 2
        c = (number - guess + half) % self.span - half
        size = c - 1 if c > 0 else -c
        self.k = k = coder.symbol(self.classes[context], size.bit_length())
        if not k:
            c = coder.bit(self.small, c & 1)
        elif k >= 32:
            c = -half
        else:
            place = c - 1 if c > 0 else c + (1 << k) - 1
            low = max(0, k - self.HIGH)
            found = coder.symbol(self.places[k - 1], place >> low)
            if low:
                found = found << low | coder.bits(low, place & ((1 << low) - 1))
            c = found + 1 if found >> (k - 1) else found - (1 << k) + 1
        out = guess + c
        return (out + half) % self.span - half if self.signed else out % self.span


class Median:
    """A running median of five: the largest and the smallest leave in turns, the turn changing when a number falls on their side."""

    __slots__ = ("five", "high")

    def __init__(self) -> None:
        self.five, self.high = [0] * 5, True

    def add(self, v: int) -> None:
        middle = self.five[2]
        del self.five[4 if self.high else 0]
        insort(self.five, v)
        if (v >= middle) if self.high else (v <= middle):
            self.high = not self.high


def _return_class(n: int, r: int) -> int:
    """One of six contexts of a pair of return counts (the order does not matter)."""
    a, b = min(n, r), max(n, r)
    if a == 0:
        return [0, 1, 2, 3, 4, 5, 3, 4, 4][b] if b < 9 else 5
    if a == 1:
        return [0, 1][b - 1] if b < 3 else 3
    if a == 2:
        return 2 if b == 2 else 4 if b < 11 else 3
    return 5 if b == a or (b - a == 1 and b > 11) else 4


class _Scanner:
    """A scanner channel's models, made when its first point comes."""

    def __init__(self) -> None:
        self.changes = [Symbols(128) for _ in range(8)]
        self.other, self.same_time = Symbols(3), Symbols(13)
        self.counts, self.returns = {}, {}
        self.dx, self.dy = Corrected(32, 2), Corrected(32, 22)
        self.x_steps, self.y_steps = [Median() for _ in range(12)], [Median() for _ in range(12)]


COLUMNS = ("x", "y", "z", "n", "r", "channel", "flags", "classification", "intensity", "angle", "source", "time")


def _walk(layers: list, count: int, first: dict[str, int], known: dict[str, list[int]] | None) -> dict[str, list[int]]:
    """All points' columns. layers: a coder each, or None where nothing was written; known: the columns when writing."""
    out = {c: [v] * count for c, v in first.items()}
    writing = known is not None
    if writing:
        out = known
    # 1. Changes, returns and positions. `like`: the point that each is compared with, the last of its channel.
    coder, scanners, last_of = layers[0], {}, {}
    like, time_new, angle_new, source_new, wide = ([0] * count for _ in range(5))
    channel, n_, r_, x_, y_ = (out[c] for c in ("channel", "n", "r", "x", "y"))
    last_of[channel[0]] = 0
    scanners[channel[0]] = _Scanner()
    fields = [(c, out[c]) for c in ("time", "source", "angle")]
    for i in range(1, count):
        before = scanners[channel[i - 1]]
        kind = int(r_[i - 1] == 1) | int(r_[i - 1] >= n_[i - 1]) << 1 | time_new[i - 1] << 2
        change, was = 0, channel[i - 1]
        if writing:
            j = last_of.get(channel[i], i - 1)
            up, down = (r_[i] - r_[j]) % 16 == 1, (r_[j] - r_[i]) % 16 == 1
            odd = r_[i] != r_[j] and not up and not down
            new = {c: v[i] != v[j] for c, v in fields}
            change = int(up or odd) | int(down or odd) << 1 | int(n_[i] != n_[j]) << 2 | new["angle"] << 3 | new["time"] << 4 | new["source"] << 5 | int(channel[i] != was) << 6
        change = coder.symbol(before.changes[kind], change)
        now = was
        if change & 64:
            now = (was + coder.symbol(before.other, (channel[i] - was - 1) % 4) + 1) % 4
        channel[i] = now
        j = like[i] = last_of.get(now, i - 1)
        s = scanners.get(now) or scanners.setdefault(now, _Scanner())
        last_of[now] = i
        time_new[i], source_new[i], angle_new[i] = change >> 4 & 1, change >> 5 & 1, change >> 3 & 1
        n, r = n_[j], r_[j]
        if change & 4:
            n = coder.symbol(s.counts.get(n) or s.counts.setdefault(n, Symbols(16)), n_[i])
        if change & 3 == 3:
            if time_new[i]:
                r = coder.symbol(s.returns.get(r) or s.returns.setdefault(r, Symbols(16)), r_[i])
            else:
                r = (r + coder.symbol(s.same_time, (r_[i] - r - 2) % 16) + 2) % 16
        elif change & 3:
            r = (r + (1 if change & 1 else 15)) % 16
        n_[i], r_[i] = n, r
        m = _return_class(n, r) << 1 | time_new[i]
        single = int(n == 1)
        step = s.dx.code(coder, s.x_steps[m].five[2], single, x_[i] - x_[j])
        s.x_steps[m].add(step)
        x_[i] = _int32(x_[j] + step)
        step = s.dy.code(coder, s.y_steps[m].five[2], single | min(s.dx.k, 20) & ~1, y_[i] - y_[j])
        s.y_steps[m].add(step)
        y_[i] = _int32(y_[j] + step)
        wide[i] = (s.dx.k + s.dy.k) // 2

    def walked(layer: int, make, take, changed: list[int] | None = None, column: str = "") -> None:
        """One field: take(state, i, j, number) gives it; where nothing changed or was written it is that of `like`."""
        values, state = out[column], {}
        for i in range(1, count):
            j, c = like[i], channel[i]
            if c not in state:
                # A new channel starts from the point before it, the first one from itself.
                state[c] = make(values[i - 1] if c != channel[0] else values[0])
            if layers[layer] is None or (changed is not None and not changed[i]):
                if not writing:
                    values[i] = values[j]
                continue
            values[i] = take(state[c], i, j, values[i])

    def memo(models: dict, key: int, n: int) -> Symbols:
        return models.get(key) or models.setdefault(key, Symbols(n))

    # 2. Heights, by how far the return is from the last one.
    def height(s, i, j, v):
        level = min(7, abs(n_[i] - r_[i]))
        s[1][level] = s[0].code(layers[1], s[1][level], int(n_[i] == 1) | min(wide[i], 18) & ~1, v)
        return s[1][level]

    walked(1, lambda v: (Corrected(32, 20), [v] * 8), height, None, "z")
    # 3. Classes and flags, by the point compared with.
    kinds = out["classification"]
    walked(2, lambda v: {}, lambda s, i, j, v: layers[2].symbol(memo(s, int(r_[i] == 1 and r_[i] >= n_[i]) | (kinds[j] & 31) << 1, 256), v), None, "classification")
    walked(3, lambda v: {}, lambda s, i, j, v: layers[3].symbol(memo(s, out["flags"][j], 64), v), None, "flags")

    # 4. Intensities, by time change and place of the return.
    def bright(s, i, j, v):
        m = time_new[i] | int(r_[i] >= n_[i]) << 1 | int(r_[i] == 1) << 2
        s[1][m] = s[0].code(layers[4], s[1][m], m >> 1, v)
        return s[1][m]

    walked(4, lambda v: (Corrected(16, 4), [v] * 8), bright, None, "intensity")
    # 5. Angles and sources, where they change.
    walked(5, lambda v: Corrected(16, 2), lambda s, i, j, v: _int16(s.code(layers[5], out["angle"][j], time_new[i], v)), angle_new, "angle")
    walked(7, lambda v: Corrected(16, 1), lambda s, i, j, v: s.code(layers[7], out["source"][j], 0, v), source_new, "source")
    # 6. Times (the bits of a double), where they change.
    walked(8, _Clock, lambda s, i, j, v: s.code(layers[8], v, writing), time_new, "time")
    return out


def _int32(v: int) -> int:
    return (v + (1 << 31)) % (1 << 32) - (1 << 31)


def _int16(v: int) -> int:
    return (v + (1 << 15)) % (1 << 16) - (1 << 15)


class _Clock:
    """Times of up to four interleaved pulse sequences, each with its last time and usual step."""

    def __init__(self, start: int) -> None:
        self.now, self.next = 0, 0
        self.last, self.step, self.odd = [start, 0, 0, 0], [0] * 4, [0] * 4
        self.multiple, self.fresh, self.gap = Symbols(515), Symbols(5), Corrected(32, 9)

    def _plan(self, time: int) -> tuple[int, int]:
        """(code, difference) by which to write a time: of the present sequence, else of another that reaches it, else whole."""
        diff, step = time - self.last[self.now], self.step[self.now]
        if -(1 << 31) <= diff < 1 << 31:
            if not step:
                return 0, diff
            times = round(diff / step)
            return (min(times, MULTIPLE) if times >= 0 else MULTIPLE - max(times, BACKWARD)), diff
        for k in (1, 2, 3):
            if -(1 << 31) <= time - self.last[(self.now + k) & 3] < 1 << 31:
                return (WHOLE + k if step else k + 1), 0
        return (WHOLE if step else 1), 0

    def code(self, coder: Reader | Writer, time: int, writing: bool) -> int:
        while True:
            k, step = self.now, self.step[self.now]
            code, diff = self._plan(time) if writing else (0, 0)
            code = coder.symbol(self.multiple if step else self.fresh, code)
            whole, moved = (WHOLE, code - WHOLE) if step else (1, code - 1)
            if code > whole:
                self.now = (k + moved) & 3
                continue
            if code == whole:
                self.next = (self.next + 1) & 3
                high = self.gap.code(coder, _int32(self.last[k] >> 32), 8, _int32(time >> 32))
                low = coder.bits(32, time & TOP)
                self.now = self.next
                self.last[self.now], self.step[self.now], self.odd[self.now] = (high & TOP) << 32 | low, 0, 0
                break
            if not step:
                diff = self.gap.code(coder, 0, 0, diff)
                self.step[k], self.odd[k] = diff, 0
            else:
                times = code if code <= MULTIPLE else MULTIPLE - code
                # The context tells none, one, few, many, most; backward, most backward.
                context = 7 if not times else 1 if times == 1 else 2 if 1 < times < 10 else 3 if 10 <= times < MULTIPLE else 4 if times == MULTIPLE else 5 if times > BACKWARD else 6
                diff = self.gap.code(coder, _int32(times * step), context, diff)
                if times == 1:
                    self.odd[k] = 0
                elif times in (0, MULTIPLE, BACKWARD):
                    self.odd[k] += 1
                    if self.odd[k] > 3:
                        self.odd[k], self.step[k] = 0, diff
            self.last[k] = (self.last[k] + diff) & ((1 << 64) - 1)
            break
        return self.last[self.now]


def _parts(raw: bytes) -> dict[str, int]:
    """The columns of one point of a format from 6 on."""
    x, y, z, intensity, returns, flags, kind, _, angle, source, time = struct.unpack_from("<3iHBBBBhHQ", raw)
    return {"x": x, "y": y, "z": z, "n": returns >> 4, "r": returns & 15, "channel": flags >> 4 & 3, "flags": flags & 15 | flags >> 6 << 4, "classification": kind, "intensity": intensity, "angle": angle, "source": source, "time": time}


def read_chunk(data: bytes, fmt: int, record: int, count: int) -> np.ndarray:
    """The points of one chunk as records of 30 bytes (what all these formats share; user data are 0 but for the first)."""
    out = np.zeros(count, _RECORD)
    if not count:
        return out
    first = _parts(data)
    at = record
    if struct.unpack_from("<I", data, at)[0] != count and count > 1:
        raise ValueError("a chunk's number of points differs from its table's")
    layers: list = [None] * LAYERS
    if count > 1:
        more = LAYERS + (fmt >= 7) + (fmt == 8) + record - POINT_BYTES[fmt]
        sizes = struct.unpack_from(f"<{more}I", data, at + 4)
        at += 4 + 4 * more
        for k in range(LAYERS):
            if sizes[k]:
                layers[k] = Reader(data[at : at + sizes[k]])
            at += sizes[k]
    c = _walk(layers, count, first, None)
    for name in ("x", "y", "z", "intensity", "classification", "angle", "source"):
        out[name] = c[name]
    flags = np.array(c["flags"])
    out["returns"] = np.array(c["n"]) << 4 | np.array(c["r"])
    out["flags"] = flags & 15 | np.array(c["channel"]) << 4 | flags >> 4 << 6
    out["time"] = np.array(c["time"], np.uint64).view(np.float64)
    return out


#: The record that formats 6 to 8 share.
_RECORD = np.dtype([("x", "<i4"), ("y", "<i4"), ("z", "<i4"), ("intensity", "<u2"), ("returns", "u1"), ("flags", "u1"), ("classification", "u1"), ("user", "u1"), ("angle", "<i2"), ("source", "<u2"), ("time", "<f8")])


def write_chunk(records: np.ndarray) -> bytes:
    """Points (records of 30 bytes, format 6) as one chunk."""
    flags = records["flags"].astype(int)
    known = {c: records[c].astype(int).tolist() for c in ("x", "y", "z", "intensity", "classification", "angle", "source")}
    known |= {"n": (records["returns"] >> 4).tolist(), "r": (records["returns"] & 15).tolist(), "channel": (flags >> 4 & 3).tolist(), "flags": (flags & 15 | flags >> 6 << 4).tolist(), "time": records["time"].copy().view(np.uint64).tolist()}
    layers: list = [Writer() for _ in range(LAYERS)]
    _walk(layers, len(records), {}, known)
    data = [w.data() for w in layers]
    return records[:1].tobytes() + struct.pack(f"<{1 + LAYERS}I", len(records), *map(len, data)) + b"".join(data)


def chunk_table(data: bytes, total: int, chunk_size: int) -> list[tuple[int, int]]:
    """(points, bytes) of each chunk from a file's chunk table."""
    version, n = struct.unpack_from("<II", data)
    if version:
        raise ValueError(f"chunk tables of version {version} are not read")
    coder, number, out = Reader(data[8:]), Corrected(32, 2), []
    points = size = 0
    for _ in range(n):
        points = number.code(coder, points, 0) if chunk_size == VARYING else min(chunk_size, total)
        size = number.code(coder, size, 1)
        total -= points
        out.append((points & TOP, size & TOP))
    return out


def write_table(chunks: list[tuple[int, int]], varying: bool) -> bytes:
    coder, number, before = Writer(), Corrected(32, 2), (0, 0)
    for points, size in chunks:
        if varying:
            number.code(coder, before[0], 0, points)
        number.code(coder, before[1], 1, size)
        before = points, size
    return struct.pack("<II", 0, len(chunks)) + coder.data()


def compressor_record(chunk_size: int) -> bytes:
    """What the compressor's record says: layered chunks of points of format 6."""
    return struct.pack("<HHBBHIIqqH3H", 3, 0, 3, 4, 3, 0, chunk_size, -1, -1, 1, 10, 30, 3)
