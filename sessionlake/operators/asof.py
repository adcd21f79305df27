"""As-of joins of a frame timeline with sensor streams.

Frames and streams: a session column, t (long, microseconds) and row_index; streams carry value and code as well. All
streams of a session are matched in one exchange and two sorts; a stream of any length is read once, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = "struct<t:bigint,row_index:bigint,value:double,code:bigint>"
TOLERANCE_US = 50_000


def _samples(frames: DataFrame, streams: dict[str, DataFrame], by: str) -> DataFrame:
    """Frames (_frame 1) and all streams' samples (_frame 0) in one table, a column for each stream."""
    none = [F.lit(None).cast(SAMPLE).alias(name) for name in streams]
    rows = frames.select(by, "t", "row_index", F.lit(1).alias("_frame"), *none)
    for name, samples in streams.items():
        own = F.struct(F.col("t").cast("long").alias("t"), F.col("row_index").cast("long").alias("row_index"), F.col("value").cast("double").alias("value"), F.col("code").cast("long").alias("code"))
        columns = [own.alias(n) if n == name else F.lit(None).cast(SAMPLE).alias(n) for n in streams]
        rows = rows.unionByName(samples.filter("t is not null").select(by, "t", "row_index", F.lit(0).alias("_frame"), *columns))
    return rows


def _filled(rows: DataFrame, names: list[str], keys: list[str], edge: list[str]) -> DataFrame:
    """<name>_lo and <name>_hi of frames within the rows of the same keys; edge columns come before t in the order."""
    so_far = (Window.unboundedPreceding, Window.currentRow)
    up = Window.partitionBy(*keys).orderBy(*edge, "t", F.desc("_frame"), "row_index").rowsBetween(*so_far)
    down = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in edge), F.desc("t"), "_frame", F.desc("row_index")).rowsBetween(*so_far)
    kept = [*keys, "t", "row_index", "_frame", *edge]
    found = rows.select(*kept, *(F.last(n, True).over(up).alias(f"{n}_lo") for n in names), *names)
    found = found.select(*kept, *(f"{n}_lo" for n in names), *(F.last(n, True).over(down).alias(f"{n}_hi") for n in names))
    return found.filter("_frame = 1").drop("_frame", *edge)


def brackets(frames: DataFrame, streams: dict[str, DataFrame], by: str = "session") -> DataFrame:
    """Frames with <name>_lo (last sample strictly before t) and <name>_hi (first sample at or after t) per stream."""
    return _filled(_samples(frames, streams, by), list(streams), [by], [])


#: Cells of time that one cell of the next coarser level holds, as a power of two, and how many coarser levels there are.
FAN_BITS, LEVELS = 10, 2


def _carried(cells: DataFrame, names: list[str], levels: int = LEVELS) -> DataFrame:
    """_by and cell with <name>_before, the last sample of earlier cells, and <name>_after, the first of later ones.

    A scan in levels: cells within a coarser one, those within a yet coarser one, and so on, so no window holds more than
    1024 cells but the last, which holds one row for each million cells.
    """
    keys = ["_by", "_up"] if levels else ["_by"]
    rows = cells.withColumn("_up", F.shiftright("cell", FAN_BITS))
    earlier = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.select("*", *(F.last(f"{n}_last", True).over(earlier).alias(f"{n}_before") for n in names))
    found = found.select("*", *(F.last(f"{n}_first", True).over(later).alias(f"{n}_after") for n in names))
    if not levels:
        return found
    coarse = rows.groupBy("_by", F.col("_up").alias("cell")).agg(*(F.min(f"{n}_first").alias(f"{n}_first") for n in names), *(F.max(f"{n}_last").alias(f"{n}_last") for n in names))
    above = _carried(coarse, names, levels - 1).select(F.col("_by").alias("_b"), F.col("cell").alias("_u"), *(F.col(f"{n}_{k}").alias(f"_{n}_{k}") for n in names for k in ("before", "after")))
    met = found.join(above, F.col("_by").eqNullSafe(F.col("_b")) & F.col("_up").eqNullSafe(F.col("_u")))
    return met.select("_by", "cell", *(F.coalesce(f"{n}_{k}", f"_{n}_{k}").alias(f"{n}_{k}") for n in names for k in ("before", "after")))


def bucketed_brackets(frames: DataFrame, streams: dict[str, DataFrame], cell_us: int, by: str = "session") -> DataFrame:
    """brackets for sessions of any length: a window holds one cell of time of one session, never a whole session.

    Each cell's first and last samples are summed up (a row a cell and task is shuffled), a scan over those carries the
    last one of the cells before and the first one of the cells after into every cell, and the windows start and end with
    them. A session that holds most rows is spread over as many tasks as it has cells; choose cell_us so that a
    cell has some 10^4 to 10^6 rows. A frame without a time has no brackets. The inputs are read twice.
    """
    names = list(streams)
    t = F.col("t").cast("long")
    rows = _samples(frames, streams, by).withColumn("cell", F.call_function("div", t - F.pmod(t, F.lit(cell_us).cast("long")), F.lit(cell_us).cast("long")))
    cells = rows.filter("cell is not null").groupBy(F.col(by).alias("_by"), "cell").agg(*(F.min(n).alias(f"{n}_first") for n in names), *(F.max(n).alias(f"{n}_last") for n in names))
    carried = _carried(cells, names)
    ends = [
        carried.select(F.col("_by").alias(by), F.lit(None).cast("long").alias("t"), F.lit(None).cast("long").alias("row_index"), F.lit(0).alias("_frame"), *(F.col(f"{n}_{k}").alias(n) for n in names), "cell", F.lit(e).alias("_edge"))
        for k, e in (("before", -1), ("after", 1))
    ]
    whole = rows.withColumn("_edge", F.lit(0)).unionByName(ends[0]).unionByName(ends[1])
    return _filled(whole, names, [by, "cell"], ["_edge"]).drop("cell")


def nearest(name: str) -> Column:
    """The nearer of the bracketing samples, the earlier one at a tie; null for an empty stream."""
    lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
    return F.when(hi.isNull() | (lo.isNotNull() & (F.col("t") - lo["t"] <= hi["t"] - F.col("t"))), lo).otherwise(hi)


def nearest_columns(name: str, tolerance_us: int = TOLERANCE_US) -> list[Column]:
    """<name>_index, <name>_dt_us (signed) and <name>_valid; an empty stream gives -1, 0 and 0."""
    best = nearest(name)
    dt = best["t"] - F.col("t")
    return [
        F.coalesce(best["row_index"], F.lit(-1)).cast("long").alias(f"{name}_index"),
        F.coalesce(dt, F.lit(0)).cast("long").alias(f"{name}_dt_us"),
        F.coalesce((F.abs(dt) <= tolerance_us).cast("int"), F.lit(0)).alias(f"{name}_valid"),
    ]


def clipped_index(name: str) -> Column:
    """row_index of the first sample at or after t, the last sample's for a frame after all."""
    return F.coalesce(F.col(f"{name}_hi")["row_index"], F.col(f"{name}_lo")["row_index"])


def interpolated(name: str) -> Column:
    """value on the line between the bracketing samples; at the edges that of the only one."""
    lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
    part = (F.col("t") - lo["t"]) / (hi["t"] - lo["t"])
    return F.when(lo.isNull(), hi["value"]).when(hi.isNull(), lo["value"]).otherwise(lo["value"] + (hi["value"] - lo["value"]) * part)


def interpolated_code(name: str) -> Column:
    """code on the line too, as the live collector does; the other side's where one is missing."""
    lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
    part = (F.col("t") - lo["t"]) / (hi["t"] - lo["t"])
    return F.coalesce(lo["code"] + (hi["code"] - lo["code"]) * part, lo["code"].cast("double"), hi["code"].cast("double"))


def offset_ms(name: str, to: str = "nearest") -> Column:
    """(source time - frame time) in milliseconds, to the nearest sample or to the one before (lo, else hi)."""
    source = nearest(name) if to == "nearest" else F.coalesce(F.col(f"{name}_lo"), F.col(f"{name}_hi"))
    return (source["t"] - F.col("t")) / 1000.0


def sync_summary(synced: DataFrame, name: str, by: str = "session") -> DataFrame:
    """Frames, valid frames, mean and largest |dt| without zeros but with invalid matches, and the sum of indices."""
    dt = F.abs(F.when(F.col(f"{name}_dt_us") != 0, F.col(f"{name}_dt_us")))
    return synced.groupBy(by).agg(
        F.count("*").alias("frames"), F.sum(F.col(f"{name}_valid").cast("long")).alias("valid_frames"),
        F.round(F.avg(dt), 3).alias("mean_abs_dt_us"), F.max(dt).alias("max_abs_dt_us"), F.sum(f"{name}_index").alias("idx_sum"),
    )


def synthetic_timeline(frames: DataFrame, anchors: DataFrame, fps: float = 30.0, by: str = "session") -> DataFrame:
    """frame_id (from 0) per session to times anchor + frame_id * int(1e6 / fps), where no frame log exists."""
    return frames.join(anchors.select(by, "anchor"), by).withColumn("t", F.col("anchor") + F.col("row_index") * int(1e6 / fps))
