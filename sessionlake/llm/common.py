"""What the operators share: the shared folder, staging, folds, null-safe inputs and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.session import shared_folder, small, stage  # noqa: F401  one folder for the whole library


def drop_staged(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def extended(df: DataFrame, more: str) -> StructType:
    """The schema of df with more columns, given as "name type, ..."."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so what a task makes of a batch in Python stays small; nothing is copied."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lean(spark: SparkSession, rows: int = 1000) -> None:
    """Let Spark hand Python workers so many rows at once, where the session has no setting of its own: texts may be long, and it holds a batch more than once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, rows)


def hashed_sample(rows: DataFrame, by: str, key: list[str], most: int) -> DataFrame:
    """Of each value of a column at most so many rows, those with the smallest hashes of key and value.

    Values are counted first, and only rows whose hash is below the share that leaves some 1.5 times as many go on, so what
    is ranked of a value is bounded whatever its rows.
    """
    counts = small(rows.groupBy(by).agg(F.count("*").alias("_of")), 100_000)
    near = rows.join(counts, by).withColumn("_h", F.pmod(F.xxhash64(*key, by), F.lit(1 << 40)))
    near = near.filter(F.col("_h") <= F.lit(1.5 * most * (1 << 40)) / F.col("_of"))  # in doubles, whatever the counts
    order = Window.partitionBy(by).orderBy("_h", *key)
    return near.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= most).drop("_n", "_h", "_of")


def range_column(df: DataFrame, column: str, n: int, name: str) -> DataFrame:
    """df with each row's number of about n ranges of a numeric column, ascending, by approximate quantiles.

    Equal values share a range, nulls are in range -1. Only the n bounds come to the driver.
    """
    from pyspark.ml.feature import Bucketizer

    cuts = df.select(F.percentile_approx(column, [k / n for k in range(1, n)], max(10_000, 20 * n)).alias("c")).first()["c"] if n > 1 else None
    bounds = sorted({float(c) for c in cuts or ()})
    null = F.col(column).isNull()
    if not bounds:
        return df.withColumn(name, F.when(null, -1).otherwise(0))
    ranged = df.withColumn(f"_{name}_of", F.coalesce(F.col(column).cast("double"), F.lit(0.0)))
    ranged = Bucketizer(splits=[-float("inf"), *bounds, float("inf")], inputCol=f"_{name}_of", outputCol=f"_{name}_at").transform(ranged)
    return ranged.withColumn(name, F.when(null, -1).otherwise(F.col(f"_{name}_at").cast("int"))).drop(f"_{name}_of", f"_{name}_at")


def fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 5; 0 is the held-out fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (id, component), component the smallest id reached.

    Alternates large-star and small-star steps until every component is a star around its smallest id, which the links
    up and down that are counted with the minima tell. Minima are grouped with partial aggregation and joined back, so a
    node with very many links is split by adaptive skew joins rather than gathered. Ids that stand in no edge aren't
    returned; self links, nulls and repeated rows are ignored.
    """
    now = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.col("v") < F.col("u")).alias("down"), F.count_if(F.col("v") > F.col("u")).alias("up")), "least")
        if least.filter("down > 1 or down = 1 and up > 0").isEmpty():
            drop_staged(least)
            break
        large = both.join(least.select("u", F.least("u", "m").alias("m")), "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(near, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v"))).distinct()
        after = stage(small, "edges")
        drop_staged(now, least)
        now = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
