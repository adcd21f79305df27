"""Repairs: stable sort, first-wins dedupe, fills, channel repair, baseline and normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.operators.stats import came


def stable_sort(stream: DataFrame, by: str, arrival: str = "arrival") -> DataFrame:
    """Adds pos: the order by (t, arrival), or the order of arrival for a session where any t is missing."""
    whole = F.bool_and(F.col("t").isNotNull()).over(Window.partitionBy(by))
    rows = stream.withColumn("_key", F.when(whole, F.col("t")).otherwise(F.lit(0)))
    return rows.withColumn("pos", F.row_number().over(Window.partitionBy(by).orderBy("_key", *came(stream, arrival)))).drop("_key")


def dedupe_first(stream: DataFrame, keys: list[str], arrival: str = "arrival") -> DataFrame:
    """Of rows with equal keys the one that came first."""
    return stream.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*came(stream, arrival)))).filter("_n = 1").drop("_n")


def fill(stream: DataFrame, by: str, columns: list[str], arrival: str = "arrival") -> DataFrame:
    """Empty and null cells take the last value before them, or else the first one of the session."""
    order = came(stream, arrival)
    before = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = stream
    for c in columns:
        known = F.nullif(F.col(c), F.lit(""))
        first = F.min_by(known, F.when(known.isNotNull(), F.struct(*order))).over(Window.partitionBy(by))
        out = out.withColumn(c, F.coalesce(F.last(known, True).over(before), first))
    return out


def repaired(channel: Column, neighbours: list[Column], mode: str) -> Column:
    """A bad channel from its neighbours: clean (all needed, mean cut to an integer), display (any present), tensor (float mean)."""
    total = sum(neighbours[1:], neighbours[0])
    if mode == "tensor":
        return total / float(len(neighbours))
    if mode == "clean":
        return F.coalesce((total / float(len(neighbours))).cast("long").cast("double"), channel)
    if mode == "display":
        present = sum((n.isNotNull().cast("int") for n in neighbours[1:]), neighbours[0].isNotNull().cast("int"))
        known = sum((F.coalesce(n, F.lit(0.0)) for n in neighbours[1:]), F.coalesce(neighbours[0], F.lit(0.0)))
        return F.coalesce(F.try_divide(known, present.cast("double")).cast("long").cast("double"), channel)
    raise ValueError(f"unknown mode {mode}")


def baseline_deltas(samples: DataFrame, by: list[str], order: str, head: int = 50) -> DataFrame:
    """Adds baseline (mean of the first rows) and delta = max(0, baseline - value)."""
    w = Window.partitionBy(*by)
    rows = samples.withColumn("_n", F.row_number().over(w.orderBy(order)))
    rows = rows.withColumn("baseline", F.avg(F.when(F.col("_n") <= head, F.col("value"))).over(w))
    return rows.withColumn("delta", F.greatest(F.lit(0.0), F.col("baseline") - F.col("value"))).drop("_n")


def normalised(delta: Column, scale: float = 3500.0) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), delta / scale))


def windows(samples: DataFrame, by: list[str], order: str, values: str, size: int = 16, stride: int = 1) -> DataFrame:
    """Complete sliding windows: window_id, start_t, end_t, center_t (rounded down) and tensor (values in order)."""
    w = Window.partitionBy(*by).orderBy(order)
    ahead = w.rowsBetween(Window.currentRow, size - 1)
    rows = samples.select(*by, (F.row_number().over(w) - 1).alias("_n"), F.col("t").alias("start_t"), F.lead("t", size - 1).over(w).alias("end_t"), F.collect_list(values).over(ahead).alias("tensor"))
    rows = rows.filter((F.size("tensor") == size) & (F.col("_n") % stride == 0))
    return rows.select(*by, F.expr(f"_n div {stride}").alias("window_id"), "start_t", "end_t", F.expr("(start_t + end_t) div 2").alias("center_t"), "tensor")


def depth_to_mm(metres: Column, far: float = 65.535) -> Column:
    """Depth in metres to whole millimetres of 16 bits."""
    return F.rint(F.least(F.lit(far), F.greatest(F.lit(0.0), metres)) / 0.001).cast("int")
