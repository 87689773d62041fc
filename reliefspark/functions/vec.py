"""Vector, quaternion and plane helpers over tuples of Columns; all expressions, no UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, ...]

ZERO, X_AXIS, Y_AXIS, Z_AXIS = (0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0)


def vec(*names: str) -> Vec:
    return tuple(F.col(n) for n in names)


def lift(v) -> Vec:
    """Numbers as literals."""
    return tuple(F.lit(float(c)) if isinstance(c, (int, float)) else c for c in v)


def add(a: Vec, b: Vec) -> Vec:
    return tuple(p + q for p, q in zip(a, b, strict=True))


def sub(a: Vec, b: Vec) -> Vec:
    return tuple(p - q for p, q in zip(a, b, strict=True))


def neg(a: Vec) -> Vec:
    return tuple(-p for p in a)


def scale(a: Vec, t) -> Vec:
    return tuple(p * t for p in a)


def divide(a: Vec, t) -> Vec:
    return tuple(p / t for p in a)


def equal(a: Vec, b: Vec) -> Column:
    return reduce(lambda p, q: p & q, (p == q for p, q in zip(a, b, strict=True)))


def dot(a: Vec, b: Vec) -> Column:
    return reduce(lambda p, q: p + q, (p * q for p, q in zip(a, b, strict=True)))


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def cross(a: Vec, b: Vec) -> Vec:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def cross2(a: Vec, b: Vec) -> Column:
    return a[0] * b[1] - a[1] * b[0]


def normalized(a: Vec) -> Vec:
    """Unit vector; the zero vector stays."""
    n = norm(a)
    return tuple(F.when(n == 0, p).otherwise(p / n) for p in a)


def vmax(a: Vec, b: Vec) -> Vec:
    return tuple(F.greatest(p, q) for p, q in zip(a, b, strict=True))


def vmin(a: Vec, b: Vec) -> Vec:
    return tuple(F.least(p, q) for p, q in zip(a, b, strict=True))


def vabs(a: Vec) -> Vec:
    return tuple(F.abs(p) for p in a)


# Quaternions are (x, y, z, w).


def conj(q: Vec) -> Vec:
    return (-q[0], -q[1], -q[2], q[3])


def inv(q: Vec) -> Vec:
    return divide(conj(q), dot(q, q))


def qmul(a: Vec, b: Vec) -> Vec:
    c = cross(a[:3], b[:3])
    return (*(a[3] * b[k] + a[k] * b[3] + c[k] for k in range(3)), a[3] * b[3] - dot(a[:3], b[:3]))


def qpow(q: Vec, t: Column) -> Vec:
    omega = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q[3])))
    so = F.sin(omega)
    m = F.when(so != 0, F.sin(t * omega) / so).otherwise(t)
    return (m * q[0], m * q[1], m * q[2], F.cos(t * omega))


def slerp(a: Vec, b: Vec, t: Column) -> Vec:
    return qmul(a, qpow(qmul(inv(a), b), t))


def great_circle(a: Vec, b: Vec) -> Vec:
    """The rotation of unit vector a to b; half a turn about z for opposite ones."""
    c = dot(a, b)
    half = F.sqrt((1 + c) / 2)
    x = cross(a, b)
    opposite = F.abs(c + 1) < 1e-6
    return (*(F.when(opposite, F.lit(float(k == 2))).otherwise(x[k] * (F.lit(0.5) / half)) for k in range(3)), F.when(opposite, F.lit(0.0)).otherwise(half))


def plane(normal: Vec, point: Vec) -> Vec:
    """(normal, d) of the plane through a point."""
    return (*normal, -dot(normal, point))


def ray_plane(start: Vec, direction: Vec, p: Vec) -> Vec:
    """Homogeneous intersection of a ray and a plane; w = 0 for parallel ones."""
    alpha = dot(p[:3], direction)
    beta = -p[3] - dot(p[:3], start)
    return (*add(scale(start, alpha), scale(direction, beta)), alpha)


def triangle_normal(a: Vec, b: Vec, c: Vec) -> Vec:
    return normalized(cross(sub(b, a), sub(c, a)))


def pow2(x: Column) -> Column:
    return x * x


def pow3(x: Column) -> Column:
    return x * x * x


def clamp(x: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def approx_equal(a: Column, b, tolerance: float = 1e-6) -> Column:
    return F.abs(a - b) < tolerance
