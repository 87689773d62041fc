"""32-bit mixing hashes as Column expressions over longs, and compact number encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the 32-bit mixing hash and of the position hash.
MIX_32, MIX_SHIFT = 0x5BD1E995, 24
POSITION_FACTORS = (73856093, 19349663, 83492791)


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def mix32(state: Column, key: Column) -> Column:
    """One round of the 32-bit hash; both arguments unsigned values in longs."""
    k = _low(_low(key) * MIX_32)
    k = _low(k.bitwiseXOR(F.shiftrightunsigned(k, MIX_SHIFT)) * MIX_32)
    return _low(_low(state) * MIX_32).bitwiseXOR(k)


def position_hash(bits: tuple[Column, Column, Column]) -> Column:
    """Hash of a position by its coordinates' float bit patterns (unsigned values in longs)."""
    out: Column | None = None
    for b, f in zip(bits, POSITION_FACTORS, strict=True):
        v = _low(b.bitwiseXOR(F.shiftrightunsigned(b, 17)) * f)
        out = v if out is None else out.bitwiseXOR(v)
    return out


def encode_exponent(c: Column, bits: int = 15) -> tuple[Column, Column]:
    """(mantissa, exponent) with c near mantissa * 2^exponent and a signed mantissa of `bits` bits."""
    e = F.when(c == 0, F.lit(0)).otherwise(F.floor(F.log2(F.abs(c))).cast("int") + 2 - bits)
    return F.round(c / F.pow(F.lit(2.0), e)).cast("int"), e


def decode_exponent(m: Column, e: Column) -> Column:
    return m * F.pow(F.lit(2.0), e)


def encode_quaternion(q: tuple[Column, ...], bits: int = 12) -> tuple[Column, Column, Column, Column]:
    """(index of the largest part, the three others as signed numbers), the largest made positive."""
    size = [F.abs(c) for c in q]
    top = F.greatest(*size)
    at = F.when(size[0] == top, 0).when(size[1] == top, 1).when(size[2] == top, 2).otherwise(3)
    large = F.element_at(F.array(*q), at + 1)
    sign = F.when(large < 0, -1.0).otherwise(1.0)
    scale = F.lit(float((1 << (bits - 1)) - 1) * 2**0.5)
    others = [F.round(F.element_at(F.array(*q), (at + k) % 4 + 1) * sign * scale).cast("int") for k in (1, 2, 3)]
    return at, *others


def decode_quaternion(at: Column, parts: tuple[Column, Column, Column], bits: int = 12) -> tuple[Column, ...]:
    scale = F.lit(float((1 << (bits - 1)) - 1) * 2**0.5)
    a, b, c = (p / scale for p in parts)
    w = F.sqrt(F.greatest(F.lit(0.0), 1 - a * a - b * b - c * c))
    ring = [w, a, b, c]
    return tuple(F.element_at(F.array(*ring), F.pmod(F.lit(k) - at, F.lit(4)) + 1) for k in range(4))
