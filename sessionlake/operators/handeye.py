"""Hand-eye calibration: X in A X = X B from sums of moments, a group's samples never meeting in one task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.operators.geometry import trimmed
from sessionlake.session import stage

#: Below such an angle a motion tells nothing about the rotation.
LEAST_ANGLE = 1e-6


def _at(r: str, i: int, j: int) -> str:
    return f"{r}[{3 * i + j}]"


def log_rotation(r: str) -> list[str]:
    """SQL of the rotation vector of a matrix given as nine numbers, row by row; for angles below 180 degrees."""
    angle = f"acos(least(1D, greatest(-1D, ({_at(r, 0, 0)} + {_at(r, 1, 1)} + {_at(r, 2, 2)} - 1) / 2)))"
    k = f"if({angle} < {LEAST_ANGLE}, 0D, {angle} / (2 * sin({angle})))"
    return [f"{k} * ({_at(r, 2, 1)} - {_at(r, 1, 2)})", f"{k} * ({_at(r, 0, 2)} - {_at(r, 2, 0)})", f"{k} * ({_at(r, 1, 0)} - {_at(r, 0, 1)})"]


def _moments(pairs: DataFrame, by: str) -> DataFrame:
    """The sums that X depends on: 9 of rotation vectors, 6 + 3 + 27 of the translations' normal equations."""
    turns = pairs.select(by, "ra", "ta", "tb", *(F.expr(f"array({', '.join(log_rotation(r))})").alias(k) for r, k in (("ra", "_a"), ("rb", "_b"))))
    c = [[f"({_at('ra', i, j)} - {int(i == j)})" for j in range(3)] for i in range(3)]
    sums = {f"m{i}{j}": f"_b[{i}] * _a[{j}]" for i in range(3) for j in range(3)}
    sums |= {f"n{i}{j}": " + ".join(f"{c[k][i]} * {c[k][j]}" for k in range(3)) for i in range(3) for j in range(i, 3)}
    sums |= {f"d{i}": " + ".join(f"{c[k][i]} * ta[{k}]" for k in range(3)) for i in range(3)}
    sums |= {f"w{i}{j}{k}": f"{c[j][i]} * tb[{k}]" for i in range(3) for j in range(3) for k in range(3)}
    return turns.groupBy(by).agg(F.expr("count(*) as n"), *(F.expr(f"sum({x}) as {k}") for k, x in sums.items()))


def _solved(sums: DataFrame, by: str) -> DataFrame:
    kind = sums.schema[by].dataType.simpleString()

    def solve(batches):
        for g in batches:
            out = []
            for row in g.to_dict("records"):
                m = np.array([[row[f"m{i}{j}"] for j in range(3)] for i in range(3)])
                u, _, v = np.linalg.svd(m.T)  # the rotation nearest to the sum of a b'
                r = u @ np.diag([1.0, 1.0, np.sign(np.linalg.det(u @ v)) or 1.0]) @ v
                normal = np.array([[row[f"n{min(i, j)}{max(i, j)}"] for j in range(3)] for i in range(3)])
                side = np.array([sum(r[j, k] * row[f"w{i}{j}{k}"] for j in range(3) for k in range(3)) - row[f"d{i}"] for i in range(3)])
                out.append((row[by], row["n"], r.reshape(-1).tolist(), np.linalg.lstsq(normal, side, rcond=None)[0].tolist()))
            yield pd.DataFrame(out, columns=[by, "n", "rx", "tx"])

    return sums.mapInPandas(solve, f"{by} {kind}, n long, rx array<double>, tx array<double>")


def solve(pairs: DataFrame, by: str) -> DataFrame:
    """by, n, rx (nine numbers) and tx of X for motions A (ra, ta) of the hand and B (rb, tb) of the eye, A X = X B.

    The rotation aligns the motions' rotation vectors, the translation solves the normal equations of
    (RA - 1) t = R tB - tA; both need sums over the samples alone, which Spark adds up in parts, and each group is solved
    from one row of 46 numbers. It takes two motions about unlike axes.
    """
    return _solved(_moments(pairs, by), by)


def residuals(pairs: DataFrame, solved: DataFrame, by: str) -> DataFrame:
    """Samples with rot_deg and trans, how far A X is from X B, and score = rot_deg + 100 * trans (translations in metres)."""
    x = pairs.join(solved.select(F.col(by).alias("_by"), "rx", "tx"), F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    product = lambda p, q, i, j: "(" + " + ".join(f"{_at(p, i, k)} * {_at(q, k, j)}" for k in range(3)) + ")"
    off = [f"({product('ra', 'rx', i, j)} - {product('rx', 'rb', i, j)})" for i in range(3) for j in range(3)]
    gap = ["(" + " + ".join(f"{_at('ra', i, k)} * tx[{k}] - {_at('rx', i, k)} * tb[{k}]" for k in range(3)) + f" + ta[{i}] - tx[{i}])" for i in range(3)]
    size = lambda parts: "sqrt(aggregate(array(" + ", ".join(parts) + "), 0D, (a, v) -> a + v * v))"
    # the sine keeps small angles exact, where a cosine doesn't
    x = x.select("*", F.expr(f"degrees(2 * asin(least(1D, {size(off)} / {2 * 2**0.5}D))) as rot_deg"), F.expr(f"{size(gap)} as trans"))
    return x.withColumn("score", F.col("rot_deg") + 100 * F.col("trans")).drop("rx", "tx")


def hand_eye(pairs: DataFrame, by: str, item: str, share: float = 0.2, rounds: int = 1) -> DataFrame:
    """X of each group, solved again after its worst samples are left out: by, n, n_used, rx, tx, mean_rot_deg, max_rot_deg, mean_trans.

    Errors are over all samples, those left out too. The samples are staged, and so is what a round has solved (a row
    a group).
    """
    pairs = stage(pairs.select(by, item, "ra", "ta", "rb", "tb"), "pairs")
    used = stage(solve(pairs, by), "solved")
    for _ in range(rounds):
        best = stage(trimmed(residuals(pairs, used, by), by, "score", item, share).select(pairs.columns), "best")
        used = stage(solve(best, by), "solved")
    errors = residuals(pairs, used, by).groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("n"), F.avg("rot_deg").alias("mean_rot_deg"), F.max("rot_deg").alias("max_rot_deg"), F.avg("trans").alias("mean_trans"))
    return errors.join(used.select(by, F.col("n").alias("n_used"), "rx", "tx"), F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
