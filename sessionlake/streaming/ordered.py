"""Streams whose rows are put in event-time order before they are worked on: a strict clock and flushed batches.

State lives in RocksDB (Spark asks for it here), so rows that wait for the watermark need not fit in memory with all
others, only those of a group of keys. A row that comes later than the watermark's delay is dropped, as Spark does with late rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Groups that keys are dealt to; one call of a processor works on all keys of a group, whose waiting rows it holds in memory.
GROUPS = 4096
ROW = pa.schema([("key", pa.string()), ("at", pa.int64()), ("row_index", pa.int64()), ("t", pa.int64())])


def packed(rows: pa.Table) -> bytes:
    """A table as one value of state."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpacked(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(value)).read_all()


class InOrder(StatefulProcessor):
    """Holds rows until the watermark has passed them and then gives them to `step`, by time and row_index.

    A call has a group of keys: state is read and written once for all of them, not key by key. What `step` keeps of a
    key is a tuple of KEPT.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "rows binary")
        self.kept = handle.getValueState("kept", "keys binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [pa.Table.from_pandas(batch.loc[~batch["mark"], ROW.names], ROW, preserve_index=False) for batch in rows]
        new = pa.concat_tables(parts) if parts else ROW.empty_table()
        if new.num_rows:  # marks only move the watermark
            self.held.appendValue((packed(new),))
            self.handle.registerTimer(pc.max(new["at"]).as_py() // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = pa.concat_tables([unpacked(x[0]) for x in self.held.get()]) if self.held.exists() else ROW.empty_table()
        due = held.filter(pc.field("at") < now).sort_by([(c, "ascending") for c in ("at", "row_index", "t")])
        if due.num_rows:
            rest = held.filter(pc.field("at") >= now)
            self.held.put([(packed(rest),)]) if rest.num_rows else self.held.clear()
        before = self._kept()
        kept = dict(before)
        out = self.step(zip(*(due[c].to_pylist() for c in ROW.names), strict=True), now, kept)
        if kept != before:
            self.kept.update((packed(pa.table([pa.array(kept, pa.string()), *(pa.array(c, pa.int64()) for c in zip(*kept.values(), strict=True))], ["key", *self.KEPT])),)) if kept else self.kept.clear()
        if out:
            columns = zip(["key", *self.NAMES], zip(*out, strict=True), strict=True)
            yield pd.DataFrame({name: pd.Series(values, dtype=object if name == "key" else "int64") for name, values in columns})

    def _kept(self) -> dict[str | None, tuple]:
        if not self.kept.exists():
            return {}
        key, *values = unpacked(self.kept.get()[0]).columns
        return dict(zip(key.to_pylist(), zip(*(v.to_pylist() for v in values), strict=True), strict=True))

    def close(self) -> None:
        pass


class StrictClock(InOrder):
    """t of each row, or the clock before plus one where t isn't above it."""

    KEPT = ("clock",)
    NAMES = ("row_index", "clock")
    RESULT = "row_index long, clock long"

    def step(self, due: Iterable[tuple], now: int, kept: dict[str | None, tuple]) -> list[tuple]:
        out = []
        for key, _, i, t in due:
            clock = max(t, kept[key][0] + 1) if key in kept else t
            kept[key] = (clock,)
            out.append((key, i, clock))
        return out


class Batches(InOrder):
    """Batches of at most `size` rows; one ends, too, once `idle_us` have passed since its last row."""

    KEPT = NAMES = ("start_us", "end_us", "n", "total")
    RESULT = "start_us long, end_us long, n long, total long"

    def __init__(self, size: int, idle_us: int):
        self.size, self.idle_us = size, idle_us

    def step(self, due: Iterable[tuple], now: int, kept: dict[str | None, tuple]) -> list[tuple]:
        out = []
        for key, at, _, t in due:
            batch = kept.get(key)
            if batch and at - batch[1] >= self.idle_us:
                out.append((key, *batch))
                batch = None
            kept[key] = batch = (batch[0], at, batch[2] + 1, batch[3] + t) if batch else (at, at, 1, t)
            if batch[2] == self.size:
                out.append((key, *kept.pop(key)))
        for key in [k for k, batch in kept.items() if now - batch[1] > self.idle_us]:
            out.append((key, *kept.pop(key)))
        if kept:
            self.handle.registerTimer((min(batch[1] for batch in kept.values()) + self.idle_us) // 1000 + 1)
        return out


def in_order(stream: DataFrame, key: str, processor: InOrder) -> DataFrame:
    """The processor over a stream with event_time (watermarked), row_index and t, by key, of a type that can be cast to a string and back."""
    kind, mark = stream.schema[key].dataType, F.col("row_index").isNull()
    longs = [F.when(mark, F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in ("row_index", "t")]  # without nulls, which pandas would make doubles of
    rows = stream.select(F.col(key).cast("string").alias("key"), "event_time", F.unix_micros("event_time").alias("at"), *longs, mark.alias("mark"))
    rows = rows.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(GROUPS)))
    found = rows.groupBy("group").transformWithStateInPandas(statefulProcessor=processor, outputStructType=f"key string, {processor.RESULT}", outputMode="Append", timeMode="EventTime")
    return found.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)


def strict_clock(stream: DataFrame, key: str) -> DataFrame:
    """key, row_index, clock: a clock for each key that rises by one at least from row to row in event-time order."""
    return in_order(stream, key, StrictClock())


def batches(stream: DataFrame, key: str, size: int = 100, idle_us: int = 100_000) -> DataFrame:
    """key, start_us, end_us, n, total: what live collection writes at once, by number of rows or idle time."""
    return in_order(stream, key, Batches(size, idle_us))


def with_marks(stream: DataFrame, folder: str, column: str = "ts") -> DataFrame:
    """The stream and the rows of a folder of marks, which have a time and nothing else: they move the watermark on."""
    spark = stream.sparkSession
    kind = stream.select(column).schema
    spark.createDataFrame([], kind).write.mode("append").parquet(folder)
    return stream.unionByName(spark.readStream.schema(kind).parquet(folder), allowMissingColumns=True)


def mark(stream: DataFrame, folder: str, time: str, column: str = "ts") -> None:
    spark = stream.sparkSession
    spark.range(1).select(F.lit(time).cast(stream.schema[column].dataType).alias(column)).write.mode("append").parquet(folder)


class Run:
    """A query in append mode into Parquet files that goes on from its checkpoint at each call."""

    def __init__(self, stream: DataFrame, folder: str):
        self.stream, self.base = stream, f"{folder}/stream-{uuid.uuid4().hex}"

    def go(self) -> DataFrame:
        """Process all that is there now; all rows written so far."""
        conf, name = self.stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
        before = conf.get(name, None)
        conf.set(name, ROCKS)
        try:
            query = self.stream.writeStream.outputMode("append").option("checkpointLocation", f"{self.base}/checkpoint").trigger(availableNow=True).format("parquet").option("path", f"{self.base}/rows").start()
        finally:
            conf.set(name, before) if before else conf.unset(name)
        query.awaitTermination()
        return self.stream.sparkSession.read.schema(self.stream.schema).parquet(f"{self.base}/rows")


def run_closed(stream: DataFrame, folder: str, marks: str, source: DataFrame, column: str = "ts") -> DataFrame:
    """Process what there is, then mark a time after all of it and go on from the checkpoint, so that nothing waits any more."""
    run = Run(stream, folder)
    run.go()
    mark(source, marks, "2261-01-01 00:00:00", column)
    return run.go()


def aligned(frames: DataFrame, samples: DataFrame, within: str, by: str = "session") -> DataFrame:
    """Live alignment: by, t, row_index, lo, hi of each frame, its last sample before t and its first at or after it.

    A join of two streams by an interval of time: both have event_time, watermarked; t, row_index, and samples value.
    State holds what the interval and the watermarks still need. A frame without a sample in the interval has neither.
    """
    f = frames.select(F.col(by).alias("_by"), F.col("event_time").alias("_ft"), F.col("row_index").alias("_f"))
    s = samples.select(F.col(by).alias("_sby"), F.col("event_time").alias("_st"), F.col("row_index").alias("_s"), "value")
    met = f.join(s, F.expr(f"_by = _sby and _st >= _ft - interval {within} and _st <= _ft + interval {within}"), "left_outer")
    sample = F.struct(F.unix_micros("_st").alias("t"), F.col("_s").alias("row_index"), "value")
    found = met.groupBy("_by", "_ft", "_f").agg(F.max(F.when(F.col("_st") < F.col("_ft"), sample)).alias("lo"), F.min(F.when(F.col("_st") >= F.col("_ft"), sample)).alias("hi"))
    return found.select(F.col("_by").alias(by), F.unix_micros("_ft").alias("t"), F.col("_f").alias("row_index"), "lo", "hi")
