"""Vectors as packed bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(vectors: DataFrame, id_col: str, vector_col: str, change: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """id and vector (little-endian doubles) of the rows whose vector is valid, of any dimension.

    Valid: not null, not empty, every component there and finite; after change (rows x dimensions to the same) too.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(F.size("v") > 0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for d in np.unique(sizes):
                some = pa.array(sizes == d)
                x = batch.column(1).filter(some).flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(-1, d)  # nulls become NaN
                good = np.isfinite(x).all(1)
                x = x[good] if change is None else change(x[good])
                still = np.isfinite(x).all(1)
                ids = batch.column(0).filter(some).to_numpy(zero_copy_only=False)[good][still]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([r.tobytes() for r in x[still]], pa.binary())], ["id", "v"])

    return rows.mapInArrow(pack, "id long, v binary")


def of_dimensions(held: DataFrame) -> list[DataFrame]:
    """Packed vectors parted by dimension: those of unlike ones compare with nothing of each other."""
    sizes = [r["n"] for r in held.select(F.length("v").alias("n")).distinct().orderBy("n").collect()]
    return [held.filter(F.length("v") == n) for n in sizes] if len(sizes) > 1 else [held] if sizes else []


def matrix(blobs) -> np.ndarray:
    """Rows of doubles from packed vectors."""
    blobs = list(blobs)
    return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1) if blobs else np.empty((0, 0))


def sample(packed_rows: DataFrame, bound: int) -> np.ndarray:
    """At most bound vectors, those with the smallest hashes."""
    rows = packed_rows.select("v", F.xxhash64("id", "v").alias("h")).orderBy("h").limit(bound).select("v").collect()
    return matrix(bytes(r["v"]) for r in rows)
