"""Exact top-k search by inner product over a pivot-distance index."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import drop_staged, small, stage
from sessionlake.llm.vectors import matrix, of_dimensions, packed, sample

#: Vectors that the pivots are fitted on, pivots at most, vectors of an annulus, queries that a task takes at once.
SAMPLE, PIVOTS, ANNULUS, QUERIES = 4096, 64, 4096, 4096
#: Annuli that a query opens first, how many times more in each round after it, and annuli whose bounds may be broadcast.
FIRST, FASTER, BROADCAST_ROWS = 2, 8, 200_000
#: Room for rounding in the bounds, of distances of the order of the data.
SLACK = 1e-6


def quantise(x: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * x)


def fit_pivots(vectors: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Centres of k-means, begun at vectors far from each other."""
    chosen = [0]
    far = ((vectors - vectors[0]) ** 2).sum(1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((vectors - vectors[chosen[-1]]) ** 2).sum(1))
    pivots = vectors[chosen].copy()
    for _ in range(rounds):
        near = distances(vectors, pivots).argmin(1)
        for k in range(len(pivots)):
            if (near == k).any():
                pivots[k] = vectors[near == k].mean(0)
    return pivots


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T, 0))


def lifted(x: np.ndarray, top: float | None) -> np.ndarray:
    """One dimension more, so that near means a large inner product: vectors come to the norm sqrt(top), queries (None) get 0."""
    more = np.zeros(len(x)) if top is None else np.sqrt(np.maximum(top - (x * x).sum(1), 0))
    return np.concatenate([x, more[:, None]], 1)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    if not q.size or not x.size or np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2.0**53:
        return (q @ x.T).astype("i8")
    return np.array([[sum(int(a) * int(b) for a, b in zip(r, s, strict=True)) for s in x] for r in q], "i8")


def build(vectors: DataFrame, top: float, pivots: np.ndarray, annulus: int) -> DataFrame:
    """The index, a staged table: block, pivot, r (distance to it), id, v; a block is an annulus of one pivot, a run of the order by r.

    Every vector is indexed. Vectors at one distance of one pivot, copies say, may fill several blocks.
    """

    def key(batches):
        for batch in batches:
            far = distances(lifted(matrix(batch.column("v").to_pylist()), top), pivots) if batch.num_rows else np.empty((0, 1))
            near = far.argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(near.astype("i4")), pa.array(far[np.arange(len(near)), near])], ["id", "v", "pivot", "r"])

    keyed = vectors.mapInArrow(key, "id long, v binary, pivot int, r double")
    n = vectors.count()
    runs = keyed.repartitionByRange(max(1, -(-n // annulus)), "pivot", "r", F.xxhash64("id", "v"))
    return stage(runs.withColumn("block", F.spark_partition_id().cast("long") * len(pivots) + F.col("pivot")), "annuli")


def best_of(k: int):
    """For a cogroup of queries and an annulus: the k best of the annulus for each query."""

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, x = right["id"].to_numpy("i8"), matrix(right["v"])
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            asked, q = left["query_id"].to_numpy("i8"), matrix(left["q"])
            for at in range(0, len(asked), 256):
                s = scores(q[at : at + 256], x)
                for who, row in zip(asked[at : at + 256], s, strict=True):
                    row = np.where(ids == who, np.iinfo("i8").min, row)
                    some = np.arange(len(row)) if len(row) <= k else np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
                    some = some[ids[some] != who]
                    some = some[np.lexsort((ids[some], -row[some]))][:k]
                    out.append(pd.DataFrame({"query_id": who, "vec_id": ids[some], "score": row[some]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return best


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(held: DataFrame, k: int, every: int, pivots: int, annulus: int, opened: list[int] | None = None) -> DataFrame | None:
    """top_k() over packed vectors of one dimension; opened gets the numbers of (query, annulus) pairs opened and there are."""

    def norms(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([float((matrix(batch.column("v").to_pylist()) ** 2).sum(1).max())])], ["top"])

    top = held.mapInArrow(norms, "top double").agg(F.max("top")).first()[0]
    centres = fit_pivots(lifted(sample(held, SAMPLE), top), pivots)
    index = build(held, top, centres, annulus)
    rings = stage(index.groupBy("block", "pivot").agg(F.min("r").alias("lo"), F.max("r").alias("hi")), "rings")
    asked = held.filter(F.col("id") % every == 0)
    chunks = max(1, -(-asked.count() // QUERIES))

    def far(batches):
        for batch in batches:
            if batch.num_rows:
                q = matrix(batch.column("v").to_pylist())
                d = distances(lifted(q, None), centres)
                ends = pa.array(np.arange(len(d) + 1) * d.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array((q * q).sum(1)), pa.array(d.min(1)), pa.ListArray.from_arrays(ends, pa.array(d.ravel()))], ["query_id", "q", "qq", "least", "d"])

    queries = stage(asked.mapInArrow(far, "query_id long, q binary, qq double, least double, d array<double>").withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("long")), "queries")
    # a ring's points are no nearer than it to its pivot, and nearer to it than to the query's own pivot
    d = F.col("d")[F.col("pivot")]
    bound = F.greatest(F.lit(0.0), d - F.col("hi"), F.col("lo") - d, (d - F.col("least")) / 2)
    found, state, wave = None, queries.select("query_id", F.lit(-1.0).alias("past"), F.lit(-1).cast("long").alias("block_past"), F.lit(None).cast("double").alias("limit")), FIRST
    while True:
        near = queries.select("query_id", "least", "d", F.explode(F.sequence(F.lit(0), F.lit(len(centres) - 1))).alias("pivot")).join(small(rings, BROADCAST_ROWS), "pivot").join(state, "query_id")
        near = near.select("query_id", "block", bound.alias("bound"), "past", "block_past", "limit").filter("(bound > past or bound = past and block > block_past) and (limit is null or bound <= limit)")
        order = Window.partitionBy("query_id").orderBy("bound", "block")
        which = stage(near.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= wave).select("query_id", "block", "bound"), "opened")
        number = which.count()
        if opened is not None:
            opened.append(number)
        if not number:
            break
        rows = which.join(queries.select("query_id", "q", "chunk"), "query_id").select("block", "chunk", "query_id", "q")
        wanted = stage(rows.select("block", "chunk").distinct(), "wanted")  # only what is asked for is copied
        copies = index.select("block", "id", "v").join(small(wanted, BROADCAST_ROWS), "block")
        more = rows.groupBy("block", "chunk").cogroup(copies.groupBy("block", "chunk")).applyInPandas(best_of(k), "query_id long, vec_id long, score long")
        found = stage(ranked(more if found is None else found.union(more), k).drop("rank"), "found")
        known = found.groupBy("query_id").agg(F.min("score").alias("s"), F.count("*").alias("n"))
        last = which.groupBy("query_id").agg(F.max(F.struct("bound", "block")).alias("last"))
        limit = F.when(F.col("n") >= k, F.sqrt(F.greatest(F.lit(0.0), F.col("qq") + F.lit(top) - 2.0 * F.col("s"))) * (1 + SLACK) + SLACK)
        state = last.join(queries.select("query_id", "qq"), "query_id").join(known, "query_id", "left")
        state = stage(state.select("query_id", F.col("last.bound").alias("past"), F.col("last.block").alias("block_past"), limit.alias("limit")), "state")
        wave *= FASTER
    if opened is not None:
        opened[:] = [sum(opened), queries.count() * rings.count()]
    drop_staged(index, rings)
    return None if found is None else ranked(found, k)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, annulus: int = ANNULUS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k vectors of the largest integer inner product.

    Components become floor(256 * x). Queries are the rows whose id is divisible by every; a query's own row is no
    candidate of it, ties go to the smaller id. Exact: vectors are lifted to one norm, where inner products order as
    distances do; each vector is keyed by its nearest pivot and its distance to it. A query opens annuli by their
    triangle-inequality bounds, FIRST of them and then FASTER times more a round, until the next bound exceeds the
    distance of its k-th result. Null vectors and those with null or non-finite components take no part; neither do
    null ids; vectors of unlike dimensions are no candidates of each other. Other columns are left out. Repeated ids
    are candidates of each other's queries only under another id. An empty table gives no row.
    """
    held = stage(packed(vectors.filter(F.col(id_col).isNotNull()), id_col, vector_col, quantise), "vectors")
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for part in of_dimensions(held):
        found = search(part, k, every, pivots, annulus)
        if found is not None:
            out = out.union(found.select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
    return out
