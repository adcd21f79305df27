"""Structured Streaming counterparts of live ingestion."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_folder(spark: SparkSession, like: DataFrame, path: str, files_per_trigger: int = 8) -> DataFrame:
    """A bounded number of new files per micro-batch."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def with_event_time(stream: DataFrame, column: str = "ts", late: str = "2 days") -> DataFrame:
    return stream.withColumn("event_time", F.col(column).cast("timestamp")).withWatermark("event_time", late)


def tumbling(stream: DataFrame, width: str, keys: list[str]) -> DataFrame:
    """Rows and sum of value in windows of event time."""
    found = stream.groupBy(F.window("event_time", width), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return found.select(F.unix_micros("window.start").alias("start_us"), *keys, "n", "total")


def sliding_rate(stream: DataFrame, width: str, slide: str, key: str) -> DataFrame:
    """Rows a second in sliding windows."""
    found = stream.groupBy(F.window("event_time", width, slide), key).count()
    span = (F.unix_micros("window.end") - F.unix_micros("window.start")) / 1e6
    return found.select(F.unix_micros("window.start").alias("start_us"), key, "count", (F.col("count") / span).alias("hz"))


def sessions(stream: DataFrame, gap: str, key: str) -> DataFrame:
    """Sessions that end after a gap: start, n."""
    found = stream.groupBy(F.session_window("event_time", gap), key).agg(F.count("*").alias("n"))
    return found.select(key, F.unix_micros("session_window.start").alias("start_us"), "n")


def deduplicated(stream: DataFrame, keys: list[str]) -> DataFrame:
    return stream.dropDuplicatesWithinWatermark(keys)


def monotonic(rows: DataFrame, key: str) -> DataFrame:
    """Per key a clock that never stands still: t, or the clock before plus one, in the order of row_index.

    rows is what a stream has written: files come in any order, so the order holds over the whole table only.
    """
    upto = Window.partitionBy(key).orderBy("row_index").rowsBetween(Window.unboundedPreceding, 0)
    n = F.row_number().over(Window.partitionBy(key).orderBy("row_index"))
    return rows.withColumn("n", n).select(key, "row_index", (F.max(F.col("t") - F.col("n")).over(upto) + F.col("n")).alias("clock"))


def run_to_table(stream: DataFrame, folder: str, mode: str = "complete") -> DataFrame:
    """Process what there is and give the result, from Parquet files in the shared folder.

    In complete mode each micro-batch writes the whole result anew, of which the last one counts; nothing is held by the
    driver.
    """
    spark = stream.sparkSession
    name = f"stream_{uuid.uuid4().hex}"
    out, done = f"{folder}/{name}", []
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint-{name}").trigger(availableNow=True)
    if mode == "complete":

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/{number}")
            done.append(number)

        writer.foreachBatch(write).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{out}/{done[-1]}") if done else spark.createDataFrame([], stream.schema)
    writer.format("parquet").option("path", out).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def write_versions(stream: DataFrame, path: str, checkpoint: str, seconds: float = 0.1):
    """Micro-batches to Parquet at a fixed interval: the buffered appends of live collection."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=f"{int(seconds * 1000)} milliseconds").start()


def latest_values(stream: DataFrame, key: str, time: str, columns: list[str]) -> DataFrame:
    """The newest row of each key so far."""
    return stream.groupBy(key).agg(F.max_by(F.struct(*columns), time).alias("l")).select(key, *(F.col(f"l.{c}").alias(c) for c in columns))


def pair_rate(stream: DataFrame, width: str, device: str, first: str, second: str) -> DataFrame:
    """Complete pairs of two devices in windows: the smaller of their counts, 0 where one sends nothing."""
    count = {k: F.count_if(F.col(device) == v) for k, v in (("a", first), ("b", second))}
    found = stream.groupBy(F.window("event_time", width)).agg(count["a"].alias("a"), count["b"].alias("b"))
    span = (F.unix_micros("window.end") - F.unix_micros("window.start")) / 1e6
    return found.select(F.unix_micros("window.start").alias("start_us"), F.least("a", "b").alias("pairs"), (F.least("a", "b") / span).alias("hz"))
