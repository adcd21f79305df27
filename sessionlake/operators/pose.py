"""Rigid transforms as column expressions: rotations are nine numbers, row by row; transforms have three more, the translation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Nine = list[Column]


def from_rpy_deg(roll: Column, pitch: Column, yaw: Column) -> Nine:
    """Rotation about x by roll, then y by pitch, then z by yaw, in degrees."""
    (cr, sr), (cp, sp), (cy, sy) = ((F.cos(F.radians(a)), F.sin(F.radians(a))) for a in (roll, pitch, yaw))
    return [cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr, sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr, -sp, cp * sr, cp * cr]


def product(a: Nine, b: Nine) -> Nine:
    return [a[3 * i] * b[j] + a[3 * i + 1] * b[3 + j] + a[3 * i + 2] * b[6 + j] for i in range(3) for j in range(3)]


def transposed(a: Nine) -> Nine:
    return [a[3 * j + i] for i in range(3) for j in range(3)]


def turned(a: Nine, v: list[Column]) -> list[Column]:
    return [a[3 * i] * v[0] + a[3 * i + 1] * v[1] + a[3 * i + 2] * v[2] for i in range(3)]


def composed(a: tuple[Nine, list[Column]], b: tuple[Nine, list[Column]]) -> tuple[Nine, list[Column]]:
    """First b, then a."""
    return product(a[0], b[0]), [x + y for x, y in zip(turned(a[0], b[1]), a[1], strict=True)]


def inverted(a: tuple[Nine, list[Column]]) -> tuple[Nine, list[Column]]:
    back = transposed(a[0])
    return back, [-x for x in turned(back, a[1])]


def to_quaternion(m: Nine) -> list[Column]:
    """w, x, y, z of norm 1, w not negative: each size from the diagonal, each sign from the differences beside it.

    Where w vanishes (half turns) the signs come from the sums beside the largest of the others.
    """
    half = lambda s: F.sqrt(F.greatest(F.lit(0.0), s)) / 2
    w, x, y, z = half(1 + m[0] + m[4] + m[8]), half(1 + m[0] - m[4] - m[8]), half(1 - m[0] + m[4] - m[8]), half(1 - m[0] - m[4] + m[8])
    sign = lambda c: F.when(c < 0, -1.0).otherwise(1.0)
    turns = w > 1e-9
    sx = F.when(turns, sign(m[7] - m[5])).otherwise(1.0)
    sy = F.when(turns, sign(m[2] - m[6])).otherwise(F.when(x >= 1e-9, sign(m[1])).otherwise(1.0))
    sz = F.when(turns, sign(m[3] - m[1])).otherwise(F.when(x >= 1e-9, sign(m[2])).otherwise(sign(m[5])))
    return [w, sx * x, sy * y, sz * z]


def from_quaternion(w: Column, x: Column, y: Column, z: Column) -> Nine:
    """The rotation of a quaternion of any norm but 0."""
    s = 2 / (w * w + x * x + y * y + z * z)
    return [1 - s * (y * y + z * z), s * (x * y - z * w), s * (x * z + y * w), s * (x * y + z * w), 1 - s * (x * x + z * z), s * (y * z - x * w), s * (x * z - y * w), s * (y * z + x * w), 1 - s * (x * x + y * y)]


def named(columns: list[Column], prefix: str) -> list[Column]:
    return [c.alias(f"{prefix}{k}") for k, c in enumerate(columns)]


def consistency(targets: DataFrame, by: str, order: str) -> DataFrame:
    """How far the poses (r0 to r8, t0 to t2 in metres) of a calibration lie from its first one: means in degrees and mm, and a verdict."""
    names = [*(f"r{k}" for k in range(9)), *(f"t{k}" for k in range(3))]
    first = targets.groupBy(by).agg(F.min_by(F.struct(*names), order).alias("_f"))  # one row each: joined back, not a window
    rows = targets.join(first, by)
    trace = sum((F.col(f"_f.r{k}") * F.col(f"r{k}") for k in range(1, 9)), F.col("_f.r0") * F.col("r0"))
    turn = F.degrees(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (trace - 1) / 2))))
    gap = F.sqrt(sum(((F.col(f"_f.t{k}") - F.col(f"t{k}")) ** 2 for k in (1, 2)), (F.col("_f.t0") - F.col("t0")) ** 2)) * 1000
    out = rows.groupBy(by).agg(F.count("*").alias("frames"), F.avg(turn).alias("mean_deg"), F.avg(gap).alias("mean_mm"))
    good, fair = (F.col("mean_deg") < 2) & (F.col("mean_mm") < 10), (F.col("mean_deg") < 5) & (F.col("mean_mm") < 30)
    return out.withColumn("verdict", F.when(good, "good").when(fair, "usable").otherwise("retake"))


def intrinsics(focal: Column, aperture_h: Column, aperture_v: Column, width: Column, height: Column) -> Column:
    """fx, fy, cx, cy in pixels from a focal length and apertures in one unit."""
    return F.struct((focal / aperture_h * width).alias("fx"), (focal / aperture_v * height).alias("fy"), (width / 2.0).alias("cx"), (height / 2.0).alias("cy"))


def corner_coverage(u_min: Column, v_min: Column, u_max: Column, v_max: Column, width: float, height: float) -> Column:
    """Share of an image that the box around detected corners covers."""
    return (u_max - u_min) * (v_max - v_min) / (width * height)


def camera_or_default(rows: DataFrame, name: str, registry: DataFrame, default: str) -> DataFrame:
    """Rows with the registry's columns for their camera, or those of the default one where it isn't known; the registry is small."""
    known = registry.withColumnRenamed("camera", "_camera")
    asked = rows.join(F.broadcast(registry.select(F.col("camera").alias(name)).withColumn("_known", F.lit(True))), name, "left")
    key = F.when(F.col("_known"), F.col(name)).otherwise(F.lit(default))
    return asked.withColumn("_key", key).join(F.broadcast(known), F.col("_key") == F.col("_camera"), "left").drop("_known", "_key", "_camera")
