"""3-vectors and 3x3 matrices of columns.

A vector is a tuple of three columns and a matrix a tuple of three rows, so every
function is plain arithmetic that stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridelake.functions.scalars import clip, wrap_degrees

Vector = tuple[Column, Column, Column]
Matrix = tuple[Vector, Vector, Vector]


def vector(x: float | Column, y: float | Column, z: float | Column) -> Vector:
    return tuple(v if isinstance(v, Column) else F.lit(float(v)) for v in (x, y, z))


def joint(joints: str, index: int) -> Vector:
    """The point of one joint in an array of structs x, y, z."""
    point = F.col(joints)[index]
    return point["x"], point["y"], point["z"]


def packed(v: Vector) -> Column:
    return F.struct(v[0].alias("x"), v[1].alias("y"), v[2].alias("z"))


def unpacked(name: str) -> Vector:
    point = F.col(name)
    return point["x"], point["y"], point["z"]


def minus(a: Vector, b: Vector) -> Vector:
    return tuple(x - y for x, y in zip(a, b, strict=True))


def plus(a: Vector, b: Vector) -> Vector:
    return tuple(x + y for x, y in zip(a, b, strict=True))


def scaled(a: Vector, k: float | Column) -> Vector:
    return tuple(x * k for x in a)


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vector, b: Vector) -> Vector:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def horizontal(a: Vector) -> Vector:
    return a[0], a[1], F.lit(0.0)


def normalized(a: Vector, eps: float = 1e-5) -> tuple[Vector, Column]:
    """a over the larger of its norm and eps, and whether the norm exceeds eps."""
    size = norm(a)
    return scaled(a, 1 / F.greatest(size, F.lit(eps))), F.coalesce(size > eps, F.lit(False))


def chosen(test: Column, a: Vector, b: Vector) -> Vector:
    return tuple(F.when(test, x).otherwise(y) for x, y in zip(a, b, strict=True))


def heading_degrees(a: Vector) -> Column:
    return wrap_degrees(F.degrees(F.atan2(a[1], a[0])))


def angle_degrees(a: Vector, b: Vector, least: float = 1e-8) -> Column:
    """The angle between two vectors; null where either is close to zero."""
    size = norm(a) * norm(b)
    return F.when(size >= least, F.degrees(F.acos(clip(dot(a, b) / F.greatest(size, F.lit(least)), -1.0, 1.0))))


def sagittal_degrees(a: Vector) -> Column:
    """Orientation in the x-z plane, 0 straight down."""
    return F.degrees(F.atan2(a[0], -a[2]))


def times(m: Matrix, v: Vector) -> Vector:
    return tuple(dot(row, v) for row in m)


def product(a: Matrix, b: Matrix) -> Matrix:
    columns = transposed(b)
    return tuple(tuple(dot(row, c) for c in columns) for row in a)


def transposed(m: Matrix) -> Matrix:
    return tuple(zip(*m, strict=True))


def determinant(m: Matrix) -> Column:
    return dot(m[0], cross(m[1], m[2]))


def matrix_column(name: str) -> Matrix:
    """An array of three arrays of three numbers."""
    m = F.col(name)
    return tuple(tuple(m[i][k] for k in range(3)) for i in range(3))


def packed_matrix(m: Matrix) -> Column:
    return F.array(*[F.array(*row) for row in m])


def identity() -> Matrix:
    return tuple(tuple(F.lit(1.0 if i == k else 0.0) for k in range(3)) for i in range(3))


def skew(v: Vector) -> Matrix:
    zero = F.lit(0.0)
    return (zero, -v[2], v[1]), (v[2], zero, -v[0]), (-v[1], v[0], zero)


def axis_angle_matrix(v: Vector, eps: float = 1e-8) -> Matrix:
    """Rotation by |v| radians about v; the identity for angles up to eps."""
    angle = norm(v)
    safe = F.greatest(angle, F.lit(eps))
    a = scaled(v, 1 / safe)
    c, s = F.cos(angle), F.sin(angle)
    rows = []
    k = skew(a)
    for i in range(3):
        row = []
        for j in range(3):
            value = a[i] * a[j] * (1 - c) + (c if i == j else F.lit(0.0)) + k[i][j] * s
            row.append(F.when(angle > eps, value).otherwise(F.lit(1.0 if i == j else 0.0)))
        rows.append(tuple(row))
    return tuple(rows)


def euler_zyx_degrees(m: Matrix) -> tuple[Column, Column, Column]:
    """Roll, pitch and yaw of Rz(yaw) Ry(pitch) Rx(roll); roll is 0 where the pitch is straight up or down."""
    pitch = F.asin(clip(-m[2][0], -1.0, 1.0))
    regular = F.abs(F.cos(pitch)) > 1e-6
    roll = F.when(regular, F.atan2(m[2][1], m[2][2])).otherwise(F.lit(0.0))
    yaw = F.when(regular, F.atan2(m[1][0], m[0][0])).otherwise(F.atan2(-m[0][1], m[1][1]))
    return F.degrees(roll), F.degrees(pitch), F.degrees(yaw)


def rotation_between(a: Vector, b: Vector, eps: float = 1e-8) -> Matrix:
    """Rotation that takes unit vector a to unit vector b; a half turn about a fixed normal if they're opposite."""
    v, c = cross(a, b), dot(a, b)
    k = skew(v)
    square = product(k, k)
    factor = 1 / F.greatest(1 + c, F.lit(eps))
    helper = chosen(F.abs(a[0]) < 0.9, vector(1, 0, 0), vector(0, 1, 0))
    n, _ = normalized(cross(a, helper), eps)
    one = identity()
    rows = []
    for i in range(3):
        row = []
        for j in range(3):
            general = one[i][j] + k[i][j] + square[i][j] * factor
            row.append(F.when(c > -1 + eps, general).otherwise(2 * n[i] * n[j] - one[i][j]))
        rows.append(tuple(row))
    return tuple(rows)
