"""Near-duplicate vectors by an epsilon grid order join."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import components, extended, stage
from sessionlake.llm.vectors import matrix, of_dimensions, packed, sample

#: Vectors that the principal dimensions are fitted on, dimensions that sort and that bound, vectors of an interval,
#: of the smaller intervals in it, and intervals below one of the recursion.
SAMPLE, SORTED, BOUNDED, INTERVAL, SMALLER, FAN = 4096, 4, 8, 8192, 64, 8
#: Room for rounding in squared distances of unit vectors.
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of norm 1; zero rows become NaN and so invalid."""
    top = np.abs(x).max(1, keepdims=True)
    with np.errstate(all="ignore"):
        x = x / np.where(top > 0, top, np.nan)
        return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal(vectors: np.ndarray) -> np.ndarray:
    """Orthonormal columns, by falling variance; any orthonormal columns keep the join exact."""
    centred = vectors - vectors.mean(0)
    _, basis = np.linalg.eigh(centred.T @ centred)
    return basis[:, ::-1]


def intervals(vectors: DataFrame, basis: np.ndarray, eps: float, rows: int) -> DataFrame:
    """Vectors in epsilon grid order, staged: interval, id, v and the leading principal coordinates p0, p1, ..."""
    d = min(BOUNDED, basis.shape[1])

    def project(batches):
        for batch in batches:
            p = matrix(batch.column("v").to_pylist()) @ basis[:, :d] if batch.num_rows else np.empty((0, d))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.ascontiguousarray(c)) for c in p.T)], [*batch.schema.names, *(f"p{k}" for k in range(d))])

    schema = extended(vectors, ", ".join(f"p{k} double" for k in range(d)))
    cells = [F.floor(F.col(f"p{k}") / eps) for k in range(min(SORTED, d))]
    ordered = vectors.mapInArrow(project, schema).repartitionByRange(max(1, -(-vectors.count() // rows)), *cells, "id")
    return stage(ordered.sortWithinPartitions(*cells, "id").withColumn("interval", F.spark_partition_id()), "intervals")


def near_intervals(held: DataFrame, eps: float, d: int, depth: int) -> DataFrame:
    """Pairs (a, b), a <= b, of intervals not provably farther apart than eps, by recursion over intervals of intervals."""
    box = [f(f"p{k}").alias(f"{n}{k}") for k in range(d) for n, f in (("lo", F.min), ("hi", F.max))]
    pairs = None
    for level in range(depth, -1, -1):
        nodes = held.groupBy(F.expr(f"interval div {FAN**level}").alias("node")).agg(*box)
        a = nodes.select(F.expr(f"node div {FAN}").alias("pa"), F.col("node").alias("a"), *(F.col(f"{n}{k}").alias(f"a{n}{k}") for k in range(d) for n in ("lo", "hi")))
        b = nodes.select(F.expr(f"node div {FAN}").alias("pb"), F.col("node").alias("b"), *(F.col(f"{n}{k}").alias(f"b{n}{k}") for k in range(d) for n in ("lo", "hi")))
        if pairs is None:  # the top has FAN nodes at most
            pairs = held.sparkSession.range(1).select(F.lit(0).cast("long").alias("pa"), F.lit(0).cast("long").alias("pb"))
        gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"alo{k}") - F.col(f"bhi{k}"), F.col(f"blo{k}") - F.col(f"ahi{k}")), 2) for k in range(d)), F.lit(0.0))
        pairs = pairs.join(a, "pa").join(b, "pb").filter(F.col("a") <= F.col("b")).filter(gap <= eps * eps + SLACK).select(F.col("a").alias("pa"), F.col("b").alias("pb"))
    return pairs.select(F.col("pa").alias("a"), F.col("pb").alias("b"))


def join_intervals(a: pd.DataFrame, b: pd.DataFrame, same: bool, cosine: float, d: int) -> pd.DataFrame:
    """Per vector that links across the two intervals: its links' weight, and one vector of its component there."""
    ids = np.concatenate([a["id"].to_numpy("i8"), b["id"].to_numpy("i8")])
    weight = np.concatenate([a["n"].to_numpy("i8"), b["n"].to_numpy("i8")])
    x, y = matrix(a["v"]), matrix(b["v"])
    px, py = (t[[f"p{k}" for k in range(d)]].to_numpy("f8") for t in (a, b))
    m, label, count = len(a), np.arange(len(ids)), np.zeros(len(ids), "i8")
    limit = 2 - 2 * cosine + SLACK
    cuts_y = range(0, len(y), SMALLER)
    lo = np.array([py[k : k + SMALLER].min(0) for k in cuts_y])
    hi = np.array([py[k : k + SMALLER].max(0) for k in cuts_y])
    for at in range(0, m, SMALLER):
        own = px[at : at + SMALLER]
        gap = np.maximum(0, np.maximum(lo - own.max(0), own.min(0) - hi))
        near = np.flatnonzero((gap * gap).sum(1) <= limit)
        if not len(near):
            continue
        cols = np.concatenate([np.arange(k * SMALLER, min((k + 1) * SMALLER, len(y))) for k in near])
        linked = x[at : at + SMALLER] @ y[cols].T >= cosine
        if same:
            linked &= cols[None, :] != (at + np.arange(len(linked)))[:, None]
        count[at : at + len(linked)] += linked @ weight[m + cols]
        if not same:
            count[m + cols] += weight[at : at + len(linked)] @ linked
        for i in np.flatnonzero(linked.any(1)):
            mine = np.concatenate([[at + i], (0 if same else m) + cols[linked[i]]])
            roots = np.unique(label[mine])
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
    some = np.flatnonzero(count)
    return pd.DataFrame({"id": ids[some], "links": count[some], "root": ids[label[some]]})


def links_of(members: DataFrame, cosine: float, interval: int) -> DataFrame:
    """(id, links, root) of distinct unit vectors of one dimension: weights of the links found, in parts, and a vector each is connected with."""
    n = members.count()
    eps = math.sqrt(2 - 2 * cosine)
    basis = principal(sample(members, SAMPLE))
    d = min(BOUNDED, basis.shape[1])
    held_in = intervals(members, basis, eps, interval)
    depth = max(0, math.ceil(math.log(max(1, -(-n // interval)), FAN)) - 1)
    pairs = stage(near_intervals(held_in, eps, d, depth), "pairs")
    points = [f"p{k}" for k in range(d)]
    left = pairs.join(held_in.select(F.col("interval").alias("a"), "id", "n", "v", *points), "a")
    renamed = held_in.select(F.col("interval").alias("w"), *(F.col(c).alias(c) for c in ("id", "n", "v", *points)))
    right = pairs.filter("a < b").select(F.col("a").alias("u"), F.col("b").alias("w")).join(renamed, "w")

    def joined(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        same = key[0] == key[1]
        return join_intervals(a, a if same else b, same, cosine, d)

    return stage(left.groupBy("a", "b").cogroup(right.groupBy("u", "w")).applyInPandas(joined, "id long, links long, root long"), "links")


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", interval: int = INTERVAL) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row: links are pairs with a cosine of at least the given one.

    Equal vectors become one with a weight. Unit vectors are sorted by their cells on the leading principal dimensions
    and cut into intervals; pairs of intervals whose boxes are farther apart than the radius are skipped, from large
    intervals down to small ones. Tasks pass on counts and links that connect, never all pairs. Exact but for rounding
    in the last places. Vectors that are null, zero or hold null or non-finite components link with nothing, those of
    unlike dimensions not with each other, rows with a null id not at all. Rows of one id count as one vector each,
    their links summed by id. Other columns are left out; an empty table gives no row.
    """
    held = stage(packed(vectors.filter(F.col(id_col).isNotNull()), id_col, vector_col, unit), "units")
    everyone = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    members = stage(held.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n")), "distinct")
    parts = [links_of(part, cosine, interval) for part in of_dimensions(members)]
    if not parts:
        return everyone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = reduce(DataFrame.union, parts)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).filter("a <> b").distinct())
    per = members.select("v", "id", "n").join(links, "id", "left").join(groups, "id", "left").select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    per_id = held.join(per, "v").groupBy("id").agg(F.sum("links").alias("links"), F.min("component").alias("component"))
    out = everyone.join(per_id.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
