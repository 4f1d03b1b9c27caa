"""Rotations as arrays of doubles, converted through matrices (nine components, row by row).

Quaternions have the real part first; a rotation of six numbers is the first two rows of its matrix. Euler angles are
intrinsic, in any order of the three axes. Closed forms on built-in expressions, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("quaternion", "rotation_6d", "axis_angle", "matrix", "euler")


def let(x: Column, f) -> Column:
    """f of x, with x worked out once however often f uses it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _at(v: Column, k: int) -> Column:
    return F.get(v, F.lit(k))


def _product(a: list, b: list) -> list:
    return [sum((a[3 * i + k] * b[3 * k + j] for k in range(1, 3)), a[3 * i] * b[j]) for i in range(3) for j in range(3)]


def quaternion_to_matrix(q: Column) -> Column:
    def of(q: Column) -> Column:
        w, x, y, z = (_at(q, k) for k in range(4))
        s = 2.0 / (w * w + x * x + y * y + z * z)
        return F.array(1 - s * (y * y + z * z), s * (x * y - z * w), s * (x * z + y * w), s * (x * y + z * w), 1 - s * (x * x + z * z), s * (y * z - x * w), s * (x * z - y * w), s * (y * z + x * w), 1 - s * (x * x + y * y))

    return let(q, of)


def matrix_to_quaternion(m: Column) -> Column:
    """The quaternion with a real part that isn't negative; the largest component is found first, for precision."""

    def of(m: Column) -> Column:
        a, b, c, d, e, f, g, h, i = (_at(m, k) for k in range(9))
        root = lambda x: F.sqrt(F.greatest(x, F.lit(0.0)))

        def by_largest(s: Column) -> Column:
            sw, sx, sy, sz = (_at(s, k) for k in range(4))
            by_w = F.array(sw / 2, (h - f) / (2 * sw), (c - g) / (2 * sw), (d - b) / (2 * sw))
            by_x = F.array((h - f) / (2 * sx), sx / 2, (b + d) / (2 * sx), (c + g) / (2 * sx))
            by_y = F.array((c - g) / (2 * sy), (b + d) / (2 * sy), sy / 2, (f + h) / (2 * sy))
            by_z = F.array((d - b) / (2 * sz), (c + g) / (2 * sz), (f + h) / (2 * sz), sz / 2)
            most = F.array_max(s)
            return F.when(sw == most, by_w).when(sx == most, by_x).when(sy == most, by_y).otherwise(by_z)

        q = let(F.array(root(1 + a + e + i), root(1 + a - e - i), root(1 - a + e - i), root(1 - a - e + i)), by_largest)
        return let(q, lambda q: F.when(_at(q, 0) < 0, F.transform(q, lambda v: -v)).otherwise(q))

    return let(m, of)


def axis_angle_to_matrix(v: Column) -> Column:
    def of(v: Column) -> Column:
        x, y, z = (_at(v, k) for k in range(3))
        angle = F.sqrt(x * x + y * y + z * z)
        part = F.when(angle < 1e-8, 0.5 - angle * angle / 48).otherwise(F.sin(angle / 2) / angle)
        return quaternion_to_matrix(F.array(F.cos(angle / 2), x * part, y * part, z * part))

    return let(v, of)


def matrix_to_axis_angle(m: Column) -> Column:
    def of(q: Column) -> Column:
        w, x, y, z = (_at(q, k) for k in range(4))
        n = F.sqrt(x * x + y * y + z * z)
        part = F.when(n < 1e-8, F.lit(2.0)).otherwise(2 * F.atan2(n, w) / n)
        return F.array(x * part, y * part, z * part)

    return let(matrix_to_quaternion(m), of)


def _unit(v: Column) -> Column:
    return let(v, lambda v: F.transform(v, lambda x: x / F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, y: s + y * y))))


def six_to_matrix(v: Column) -> Column:
    """Gram-Schmidt on the two rows; the third is their cross product."""

    def rows(a: Column, b: Column) -> Column:
        def third(b: Column) -> Column:
            (p, q, r), (x, y, z) = ([_at(w, k) for k in range(3)] for w in (a, b))
            return F.concat(a, b, F.array(q * z - r * y, r * x - p * z, p * y - q * x))

        dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        return let(_unit(F.zip_with(b, F.transform(a, lambda x: x * dot), lambda y, x: y - x)), third)

    return let(v, lambda v: let(_unit(F.slice(v, 1, 3)), lambda a: rows(a, F.slice(v, 4, 3))))


def matrix_to_six(m: Column) -> Column:
    return F.slice(m, 1, 6)


def _axis_matrix(axis: str, t: Column) -> list:
    c, s, one, nil = F.cos(t), F.sin(t), F.lit(1.0), F.lit(0.0)
    return {"X": [one, nil, nil, nil, c, -s, nil, s, c], "Y": [c, nil, s, nil, one, nil, -s, nil, c], "Z": [c, -s, nil, s, c, nil, nil, nil, one]}[axis]


def euler_to_matrix(v: Column, order: str = "XYZ") -> Column:
    def of(v: Column) -> Column:
        a, b, c = (_axis_matrix(axis, _at(v, k)) for k, axis in enumerate(order.upper()))
        return let(F.array(*_product(a, b)), lambda ab: F.array(*_product([_at(ab, k) for k in range(9)], c)))

    return let(v, of)


def matrix_to_euler(m: Column, order: str = "XYZ") -> Column:
    """Angles of three different axes; at the poles the first angle takes the whole turn."""
    i, j, k = ("XYZ".index(x) for x in order.upper())
    sign = 1.0 if (i, j, k) in ((0, 1, 2), (1, 2, 0), (2, 0, 1)) else -1.0

    def of(m: Column) -> Column:
        e = lambda r, c: _at(m, 3 * r + c)
        middle = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sign * e(i, k))))
        return F.array(F.atan2(-sign * e(j, k), e(k, k)), middle, F.atan2(-sign * e(i, j), e(i, i)))

    return let(m, of)


def convert(v: Column, source: str, target: str, order: str = "XYZ") -> Column:
    """From one kind to another, both of KINDS."""
    to = {"quaternion": quaternion_to_matrix, "rotation_6d": six_to_matrix, "axis_angle": axis_angle_to_matrix, "matrix": lambda m: m, "euler": lambda e: euler_to_matrix(e, order)}
    back = {"quaternion": matrix_to_quaternion, "rotation_6d": matrix_to_six, "axis_angle": matrix_to_axis_angle, "matrix": lambda m: m, "euler": lambda m: matrix_to_euler(m, order)}
    if source not in to or target not in back:
        raise ValueError(f"unknown rotation {source} or {target}")
    return v if source == target else back[target](to[source](v))
