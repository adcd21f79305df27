"""Geometry as column expressions, and averages of rotations."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def project(x: Column, y: Column, z: Column, fx: float, fy: float, cx: float, cy: float, width: int, height: int, patch: int = 28, cells: int = 24) -> Column:
    """Pinhole projection of a camera point: patch row and column (clamped), and whether it lay in the image."""
    u, v = fx * x / z + cx, fy * y / z + cy
    valid = (z > 0) & (u >= 0) & (u < width) & (v >= 0) & (v < height)
    scale_x, scale_y = float(patch * cells) / width, float(patch * cells) / height

    def cell(p: Column) -> Column:
        return F.least(F.lit(cells - 1), F.greatest(F.lit(0), F.floor(p / patch))).cast("int")

    return F.struct(cell(v * scale_y).alias("row"), cell(u * scale_x).alias("col"), valid.alias("valid"))


def rotation_error_deg(trace: Column) -> Column:
    return F.degrees(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (trace - 1) / 2))))


def quat_to_rotvec(w: Column, x: Column, y: Column, z: Column) -> list[Column]:
    """Rotation vector of a quaternion (any norm but 0, either sign)."""
    n = F.sqrt(w * w + x * x + y * y + z * z)
    sign = F.when(w < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    s = F.sqrt(x * x + y * y + z * z) / n
    angle = 2 * F.atan2(s, F.abs(w) / n)
    k = F.when(s < 1e-12, F.lit(2.0)).otherwise(angle / s) * sign / n
    return [k * x, k * y, k * z]


def aabb_distance(low_a: Sequence[Column], high_a: Sequence[Column], low_b: Sequence[Column], high_b: Sequence[Column]) -> Column:
    gaps = [F.greatest(F.lit(0.0), la - hb, lb - ha) for la, ha, lb, hb in zip(low_a, high_a, low_b, high_b, strict=True)]
    return F.sqrt(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]))


def trimmed(samples: DataFrame, by: str, score: str, tie: str, share: float = 0.2, least: int = 4, only_from: int = 8) -> DataFrame:
    """The best round(n * (1 - share)) samples of each group, `least` at least; groups under `only_from` stay whole."""
    w = Window.partitionBy(by)
    rows = samples.withColumn("_n", F.count("*").over(w)).withColumn("_r", F.row_number().over(w.orderBy(score, tie)))
    keep = F.when(F.col("_n") >= only_from, F.greatest(F.lit(least), F.bround(F.col("_n") * (1 - share), 0))).otherwise(F.col("_n"))
    return rows.filter(F.col("_r") <= keep).drop("_n", "_r")


def average_pose(poses: DataFrame, by: str) -> DataFrame:
    """Mean rotation (top eigenvector of the summed outer products) and median translation of quaternion poses.

    The ten distinct sums of products are aggregated by Spark, so a group of any size is one small row for the eigenvector.
    """
    q = ["qw", "qx", "qy", "qz"]
    pairs = [(i, j) for i in range(4) for j in range(i, 4)]
    sums = poses.groupBy(by).agg(*(F.sum(F.col(q[i]) * F.col(q[j])).alias(f"s{i}{j}") for i, j in pairs), *(F.median(c).alias(c) for c in ("tx", "ty", "tz")))

    def top(batches):
        for b in batches:
            m = np.zeros((len(b), 4, 4))
            for i, j in pairs:
                m[:, i, j] = m[:, j, i] = b[f"s{i}{j}"].to_numpy()
            v = np.linalg.eigh(m)[1][:, :, -1] if len(b) else np.empty((0, 4))
            v = v * np.where(v[:, :1] < 0, -1.0, 1.0)
            yield pd.DataFrame({by: b[by], **{c: v[:, k] for k, c in enumerate(q)}, **{c: b[c] for c in ("tx", "ty", "tz")}})

    kind = poses.schema[by].dataType.simpleString()
    return sums.mapInPandas(top, f"{by} {kind}, " + ", ".join(f"{c} double" for c in [*q, "tx", "ty", "tz"]))


def info_nce(pairs: DataFrame, batch: str, item: str, anchor: str, positive: str, temperature: float = 0.07) -> DataFrame:
    """Symmetric contrastive loss of each batch: cosine of every anchor with every positive of its own, bounded batch."""

    def norm(c: str) -> Column:
        return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))

    left = pairs.select(F.col(batch), F.col(item).alias("i"), F.col(anchor).alias("a"), norm(anchor).alias("na"))
    right = pairs.select(F.col(batch), F.col(item).alias("j"), F.col(positive).alias("p"), norm(positive).alias("np"))
    dot = F.aggregate(F.zip_with("a", "p", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    logits = left.join(right, batch).select(batch, "i", "j", (dot / (F.col("na") * F.col("np")) / temperature).alias("l"))
    rows = F.log(F.sum(F.exp("l")).over(Window.partitionBy(batch, "i")))
    cols = F.log(F.sum(F.exp("l")).over(Window.partitionBy(batch, "j")))
    loss = logits.withColumn("row", rows - F.col("l")).withColumn("col", cols - F.col("l")).filter("i = j")
    return loss.groupBy(batch).agg(F.count("*").alias("n"), ((F.avg("row") + F.avg("col")) / 2).alias("loss"))


def _unit(c: str) -> Column:
    return F.transform(c, lambda x: x / F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, y: a + y * y)))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cross_entropy(logits: DataFrame, group: list[str], logit: str, wanted: str) -> DataFrame:
    """group and loss: the log of the summed exponentials less the wanted one's logit, steady for large logits; groups without a wanted one give no row."""
    top = logits.groupBy(*group).agg(F.max(logit).alias("_top"), F.max(F.when(F.col(wanted), F.col(logit))).alias("_want"))
    sums = logits.join(top, group).groupBy(*group).agg(F.sum(F.exp(F.col(logit) - F.col("_top"))).alias("_sum"), F.first("_top").alias("_top"), F.first("_want").alias("_want"))
    return sums.filter("_want is not null").select(*group, (F.log("_sum") + F.col("_top") - F.col("_want")).alias("loss"))


def gathered_info_nce(points: DataFrame, patches: DataFrame, batch: str, point: str, patch: str, feature: str, valid: Column, temperature: float = 0.07) -> DataFrame:
    """Contrastive loss of points against the patches that they fall on: batch, n, loss.

    A valid point's positive is the patch of its number; the others are those of the batch's other valid points, two
    points of one patch too. Batches are bounded by what one training step holds; one without a valid point gives no row.
    """
    found = points.filter(valid).select(batch, F.col(point).alias("i"), patch, _unit(feature).alias("a"))
    target = patches.select(batch, patch, _unit(feature).alias("p"))
    met = found.join(target, [batch, patch]).select(batch, "i", "a", "p")
    pairs = met.select(batch, "i", "a").join(met.select(batch, F.col("i").alias("j"), "p"), batch)
    logits = pairs.select(batch, "i", "j", (_dot("a", "p") / temperature).alias("l"), (F.col("i") == F.col("j")).alias("own"))
    rows, columns = cross_entropy(logits, [batch, "i"], "l", "own"), cross_entropy(logits, [batch, "j"], "l", "own")
    loss = rows.groupBy(batch).agg(F.count("*").alias("n"), F.avg("loss").alias("_r")).join(columns.groupBy(batch).agg(F.avg("loss").alias("_c")), batch)
    return loss.select(batch, "n", ((F.col("_r") + F.col("_c")) / 2).alias("loss"))


def indexed_info_nce(anchors: DataFrame, candidates: DataFrame, batch: str, item: str, feature: str, number: str, wanted: str, temperature: float = 0.07) -> DataFrame:
    """Loss of anchors against all candidates of their batch, the wanted one being that of a given number: batch, n, loss."""
    a = anchors.select(batch, item, wanted, _unit(feature).alias("a"))
    c = candidates.select(batch, F.col(number).alias("_number"), _unit(feature).alias("p"))
    logits = a.join(c, batch).select(batch, item, (_dot("a", "p") / temperature).alias("l"), (F.col("_number") == F.col(wanted)).alias("own"))
    return cross_entropy(logits, [batch, item], "l", "own").groupBy(batch).agg(F.count("*").alias("n"), F.avg("loss").alias("loss"))


def tactile_info_nce(anchors: DataFrame, points: DataFrame, patches: DataFrame, batch: str, item: str, feature: str, number: str, temperature: float = 0.07) -> DataFrame:
    """Mean of a tactile feature's losses against points (wanted: point) and image patches (wanted: patch): batch, n, loss."""
    to_points = indexed_info_nce(anchors, points, batch, item, feature, number, "point", temperature)
    to_patches = indexed_info_nce(anchors, patches, batch, item, feature, number, "patch", temperature).select(batch, F.col("loss").alias("_l"))
    return to_points.join(to_patches, batch).select(batch, "n", ((F.col("loss") + F.col("_l")) / 2).alias("loss"))
