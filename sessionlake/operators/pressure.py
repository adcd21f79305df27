"""Cleaning of whole pressure files, as one operation with its counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.operators import clean


def check_channels(header: list[str], wanted: list[str]) -> list[str]:
    """The header with the wanted channels last, in their order; raises ValueError where one lacks or another is there."""
    channels = [c for c in header if c.startswith("CH") and c[2:].isdigit()]
    missing, extra = [c for c in wanted if c not in channels], [c for c in channels if c not in wanted]
    if missing or extra:
        raise ValueError(f"channels missing: {missing}, extra: {extra}")
    return [c for c in header if c not in channels] + wanted


def clean_files(rows: DataFrame, by: str, repairs: dict[str, list[str]], arrival: str = "arrival") -> DataFrame:
    """Rows (by, t, arrival, channels) of files, cleaned: sorted (pos), bad channels set to the whole mean of their neighbours.

    Adds _reversal, _moved, and for each bad channel c c_replaced and c_changed, for clean_details. A file with a missing t keeps its order.
    """
    back = Window.partitionBy(by).orderBy(arrival)
    lost = F.count_if(F.col("t").isNull()).over(back.rowsBetween(Window.unboundedPreceding, 0))
    out = rows.withColumn("_reversal", (F.col("t") < F.lag("t").over(back)) & (lost == 0)).withColumn("_came", F.row_number().over(back))
    out = clean.stable_sort(out, by, arrival)
    placed = out.select(by, F.col("_came").alias("pos"), F.col("t").alias("_t"))
    out = out.join(placed, [by, "pos"]).withColumn("_moved", ~F.col("t").eqNullSafe(F.col("_t"))).drop("_t", "_came")
    for bad, neighbours in repairs.items():
        near = [F.col(c) for c in neighbours]
        all_there = near[0].isNotNull()
        for c in near[1:]:
            all_there = all_there & c.isNotNull()
        new = clean.repaired(F.col(bad), near, "clean")
        out = out.withColumns({f"{bad}_replaced": all_there, f"{bad}_changed": all_there & ~new.eqNullSafe(F.col(bad)), bad: new})
    return out


def clean_details(cleaned: DataFrame, by: str, bad: list[str]) -> DataFrame:
    """A row a file: rows, timestamp_reversals, rows_reordered, rows_replaced, rows_changed, rows_failed, changed."""
    total = lambda kind: sum((F.count_if(F.col(f"{c}_{kind}")) for c in bad[1:]), F.count_if(F.col(f"{bad[0]}_{kind}")))
    out = cleaned.groupBy(by).agg(F.count("*").alias("rows"), F.count_if("_reversal").alias("timestamp_reversals"), F.count_if("_moved").alias("rows_reordered"), total("replaced").alias("rows_replaced"), total("changed").alias("rows_changed"))
    out = out.withColumn("rows_failed", F.col("rows") * len(bad) - F.col("rows_replaced"))
    return out.withColumn("changed", (F.col("rows_reordered") > 0) | (F.col("rows_changed") > 0))


def cleaning_counters(pressure: DataFrame, gripper: DataFrame, aligned: DataFrame) -> DataFrame:
    """The running totals of a cleaning, one row, from details a file.

    pressure: clean_details(); gripper: duplicates, filled; aligned: rows, written, created.
    """
    p = pressure.agg(
        F.count("*").alias("pressure_files_seen"), F.count_if("changed").alias("pressure_files_changed"), F.count_if(F.col("rows_reordered") > 0).alias("pressure_files_sorted"), F.sum("rows_reordered").alias("pressure_rows_reordered"),
        F.count_if(F.col("rows_changed") > 0).alias("pressure_ch58_files_changed"), F.sum("rows_replaced").alias("pressure_ch58_rows_replaced"), F.sum("rows_changed").alias("pressure_ch58_rows_changed"), F.sum("rows_failed").alias("pressure_ch58_rows_failed"))
    g = gripper.agg(F.count("*").alias("gripper_files_seen"), F.count_if((F.col("duplicates") > 0) | (F.col("filled") > 0)).alias("gripper_files_changed"), F.sum("duplicates").alias("gripper_duplicate_rows_removed"), F.sum("filled").alias("gripper_sys_state_filled"))
    a = aligned.agg(F.count("*").alias("aligned_files_seen"), F.count_if("written").alias("aligned_files_written"), F.count_if("created").alias("aligned_files_created"), F.sum(F.when(F.col("written"), F.col("rows")).otherwise(0)).alias("aligned_rows_written"))
    return p.crossJoin(g).crossJoin(a)  # three single rows
