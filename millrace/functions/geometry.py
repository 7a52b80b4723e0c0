"""Rotations, poses and cameras as expressions over small arrays.

Quaternions are (x, y, z, w); matrices are nine numbers, row by row; a pose is a rotation and a translation.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = list[Column]


def items(v: Column, n: int) -> Vec:
    return [F.get(v, F.lit(i)) for i in range(n)]


def euler_to_matrix(roll: Column, pitch: Column, yaw: Column) -> Vec:
    """Rz(yaw) Ry(pitch) Rx(roll)."""
    cr, sr, cp, sp, cy, sy = F.cos(roll), F.sin(roll), F.cos(pitch), F.sin(pitch), F.cos(yaw), F.sin(yaw)
    return [cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr, sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr, -sp, cp * sr, cp * cr]


def matrix_to_euler(m: Vec) -> Vec:
    """Inverse of euler_to_matrix(); where pitch is a right angle, yaw is 0."""
    flat = F.sqrt(m[0] * m[0] + m[3] * m[3])
    regular = flat >= 1e-6
    roll = F.when(regular, F.atan2(m[7], m[8])).otherwise(F.atan2(-m[5], m[4]))
    return [roll, F.atan2(-m[6], flat), F.when(regular, F.atan2(m[3], m[0])).otherwise(0.0)]


def quaternion_multiply(a: Vec, b: Vec) -> Vec:
    ax, ay, az, aw = a
    bx, by, bz, bw = b
    return [aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx, aw * bz + ax * by - ay * bx + az * bw, aw * bw - ax * bx - ay * by - az * bz]


def quaternion_invert(q: Vec) -> Vec:
    n = q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3]
    return [-q[0] / n, -q[1] / n, -q[2] / n, q[3] / n]


def quaternion_normalize(q: Vec) -> Vec:
    n = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3])
    return [x / n for x in q]


def quaternion_to_matrix(q: Vec) -> Vec:
    x, y, z, w = q
    return [
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    ]


def apply_matrix(m: Vec, v: Vec) -> Vec:
    return [m[3 * i] * v[0] + m[3 * i + 1] * v[1] + m[3 * i + 2] * v[2] for i in range(3)]


def transpose(m: Vec) -> Vec:
    return [m[3 * j + i] for i in range(3) for j in range(3)]


def matmul(a: Vec, b: Vec) -> Vec:
    return [a[3 * i] * b[j] + a[3 * i + 1] * b[3 + j] + a[3 * i + 2] * b[6 + j] for i in range(3) for j in range(3)]


def pose_invert(m: Vec, t: Vec) -> tuple[Vec, Vec]:
    back = transpose(m)
    return back, [-x for x in apply_matrix(back, t)]


def pose_compose(m1: Vec, t1: Vec, m2: Vec, t2: Vec) -> tuple[Vec, Vec]:
    """First the second pose, then the first."""
    return matmul(m1, m2), [a + b for a, b in zip(apply_matrix(m1, t2), t1, strict=True)]


def project(p: Vec, fx: Column, fy: Column, cx: Column, cy: Column) -> Vec:
    """Camera coordinates to pixels."""
    return [fx * p[0] / p[2] + cx, fy * p[1] / p[2] + cy]


def backproject(u: Column, v: Column, depth: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> Vec:
    """A pixel and its depth to camera coordinates."""
    return [(u - cx) / fx * depth, (v - cy) / fy * depth, depth]


def parse_camera(text: Column) -> Column:
    """`fx fy cx cy qx qy qz qw tx ty tz` to eleven numbers; null for any other count."""
    parts = F.transform(F.split(F.trim(text), r"\s+"), lambda x: x.cast("double"))
    return F.when(F.size(parts) == 11, parts)


def rotation_6d(m: Vec) -> Vec:
    """The first two rows of a matrix."""
    return m[:6]


def matrix_from_6d(v: Vec) -> Vec:
    """Gram-Schmidt: the first row normalized, the second without its part along the first, and their cross product."""
    n = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    a = [x / n for x in v[:3]]
    along = a[0] * v[3] + a[1] * v[4] + a[2] * v[5]
    b = [y - along * x for x, y in zip(a, v[3:6], strict=True)]
    n = F.sqrt(b[0] * b[0] + b[1] * b[1] + b[2] * b[2])
    b = [x / n for x in b]
    return [*a, *b, a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def axis_turn(axis: str, angle: Column) -> Vec:
    """Matrix of a turn about X, Y or Z."""
    return [x if isinstance(x, Column) else F.lit(x) for x in _turn(axis, angle)]


def _turn(axis: str, angle: Column) -> list[Column | float]:
    """The same with its zeros and ones as numbers."""
    c, s = F.cos(angle), F.sin(angle)
    return {"X": [1.0, 0.0, 0.0, 0.0, c, -s, 0.0, s, c], "Y": [c, 0.0, s, 0.0, 1.0, 0.0, -s, 0.0, c], "Z": [c, -s, 0.0, s, c, 0.0, 0.0, 0.0, 1.0]}[axis]


def _products(a: list[Column | float], b: list[Column | float]) -> list[Column | float]:
    """matmul() without the products by the numbers 0 and 1, which would be computed for every row."""

    def times(x, y):
        if isinstance(x, float) or isinstance(y, float):
            number, other = (x, y) if isinstance(x, float) else (y, x)
            return other if number == 1 else 0.0
        return x * y

    def total(parts):
        some = [x for x in parts if not (isinstance(x, float) and x == 0)]
        return functools.reduce(operator.add, some) if some else 0.0

    return [total(times(a[3 * i + k], b[3 * k + j]) for k in range(3)) for i in range(3) for j in range(3)]


def angles_to_matrix(angles: Vec, order: str) -> Vec:
    """Product of the turns about three different axes, named in order (XYZ, XZY, YXZ, YZX, ZXY or ZYX)."""
    if sorted(order) != ["X", "Y", "Z"]:
        raise ValueError(f"no order {order!r}")
    a, b, c = (_turn(x, angle) for x, angle in zip(order, angles, strict=True))
    return [x if isinstance(x, Column) else F.lit(x) for x in _products(_products(a, b), c)]


def matrix_to_angles(m: Vec, order: str) -> Vec:
    """Inverse of angles_to_matrix() for a middle angle within a right angle of 0."""
    if sorted(order) != ["X", "Y", "Z"]:
        raise ValueError(f"no order {order!r}")
    i, j, k = ("XYZ".index(x) for x in order)
    sign = 1.0 if (i, j, k) in ((0, 1, 2), (1, 2, 0), (2, 0, 1)) else -1.0
    at = lambda r, c: m[3 * r + c]
    middle = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), at(i, k) * sign)))
    return [F.atan2(-sign * at(j, k), at(k, k)), middle, F.atan2(-sign * at(i, j), at(i, i))]


def matrix_to_quaternion(m: Vec) -> Vec:
    """The unit quaternion of a rotation, w not negative, from whichever of its squares is largest."""
    ww, xx, yy, zz = 1 + m[0] + m[4] + m[8], 1 + m[0] - m[4] - m[8], 1 - m[0] + m[4] - m[8], 1 - m[0] - m[4] + m[8]
    forms = [
        (ww, [m[7] - m[5], m[2] - m[6], m[3] - m[1], ww]), (xx, [xx, m[1] + m[3], m[2] + m[6], m[7] - m[5]]),
        (yy, [m[1] + m[3], yy, m[5] + m[7], m[2] - m[6]]), (zz, [m[2] + m[6], m[5] + m[7], zz, m[3] - m[1]]),
    ]
    most = F.greatest(ww, xx, yy, zz)
    raw = [F.coalesce(*[F.when(square >= most, parts[i]) for square, parts in forms]) for i in range(4)]
    q = quaternion_normalize(raw)
    return [F.when(q[3] < 0, -x).otherwise(x) for x in q]


def quaternion_to_axis_angle(q: Vec) -> Vec:
    """Rotation vector of a unit quaternion, at most half a turn long."""
    w = F.abs(q[3])
    sign = F.when(q[3] < 0, -1.0).otherwise(1.0)
    s = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2])
    k = F.when(s > 1e-12, 2 * F.atan2(s, w) / F.greatest(s, F.lit(1e-300))).otherwise(2.0) * sign
    return [x * k for x in q[:3]]


def axis_angle_to_quaternion(v: Vec) -> Vec:
    angle = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    k = F.when(angle > 1e-12, F.sin(angle / 2) / F.greatest(angle, F.lit(1e-300))).otherwise(0.5)
    return [*(x * k for x in v), F.cos(angle / 2)]


def ray(m: Vec, t: Vec, u: Column, v: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Vec, Vec]:
    """Centre of a camera with a world-to-camera pose, and the direction of a pixel at depth 1, in the world."""
    back, centre = pose_invert(m, t)
    return centre, apply_matrix(back, backproject(u, v, F.lit(1.0), fx, fy, cx, cy))


def pluecker(centre: Vec, direction: Vec) -> Vec:
    """Unit direction and moment, centre x direction, of a ray."""
    n = F.sqrt(direction[0] * direction[0] + direction[1] * direction[1] + direction[2] * direction[2])
    d = [x / n for x in direction]
    c = centre
    return [*d, c[1] * d[2] - c[2] * d[1], c[2] * d[0] - c[0] * d[2], c[0] * d[1] - c[1] * d[0]]
