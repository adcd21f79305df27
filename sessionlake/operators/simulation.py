"""Simulated episodes: final success, force summaries, masks, produced files and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.operators.stats import percent_done

#: Metres in the plane, and least and most height over the target, of an arrival; height of the target's own point.
NEAR_XY, LOW_Z, HIGH_Z, TARGET_HEIGHT = 0.02, 0.23, 0.28, 0.0


def final_success(rows: DataFrame, by: list[str], order: str, height: float = TARGET_HEIGHT, near: float = NEAR_XY, low: float = LOW_Z, high: float = HIGH_Z) -> DataFrame:
    """Per environment: the share of rows marked success, and whether its last row (x, y, z against tx, ty, tz) is an arrival."""
    last = F.max_by(F.struct("x", "y", "z", "tx", "ty", "tz", "distance"), order)
    out = rows.groupBy(*by).agg((F.avg(F.col("success").cast("double")) * 100).alias("success_rate"), last.alias("l"))
    xy = F.sqrt((F.col("l.x") - F.col("l.tx")) ** 2 + (F.col("l.y") - F.col("l.ty")) ** 2)
    out = out.select(*by, "success_rate", F.col("l.distance").alias("final_distance"), xy.alias("final_xy"), (F.col("l.z") - (F.col("l.tz") - height)).alias("final_z"))
    return out.withColumn("final_success", (F.col("final_xy") < near) & F.col("final_z").between(low, high))


def force_summary(rows: DataFrame, by: str, forces: list[str]) -> DataFrame:
    """Peak of each sensor, the largest norm over them, most sensors in contact at once, and samples."""
    norm = F.sqrt(sum((F.col(f) ** 2 for f in forces[1:]), F.col(forces[0]) ** 2))
    touch = sum(((F.col(f) > 0).cast("int") for f in forces[1:]), (F.col(forces[0]) > 0).cast("int"))
    return rows.groupBy(by).agg(F.count("*").alias("samples"), *(F.max(f).alias(f"peak_{f}") for f in forces), F.max(norm).alias("peak_norm"), F.max(touch).alias("most_contacts"))


def mask_coverage(mask: Column) -> Column:
    """Pixels above 0 in a mask (an array), and their percentage."""
    n = F.size(F.filter(mask, lambda x: x > 0))
    return F.struct(n.alias("pixels"), (n * 100.0 / F.size(mask)).alias("percent"))


def files_by_environment(paths: DataFrame, path: str, pattern: str) -> DataFrame:
    """Files of each environment, whose number is the pattern's first group; other files count under none."""
    env = F.regexp_extract(path, pattern, 1)
    return paths.select(F.when(env != "", env.cast("int")).alias("env")).groupBy("env").agg(F.count("*").alias("files"))


def with_sidecar(rows: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the file of their keys beside them (path null where there is none); of several files the first by name."""
    return rows.join(files.groupBy(*keys).agg(F.min("path").alias("path")), keys, "left")


def progress(runs: DataFrame, logs: DataFrame, made: DataFrame, run: str) -> DataFrame:
    """Runs (run, wanted) with their last log line (line_no, line), what they made and the percentage; runs without any count 0."""
    last = logs.groupBy(run).agg(F.max_by("line", "line_no").alias("last_line"))
    count = made.groupBy(run).agg(F.count("*").alias("made"))
    out = runs.join(last, run, "left").join(count, run, "left").withColumn("made", F.coalesce("made", F.lit(0).cast("long")))
    return out.withColumn("percent", F.least(F.lit(100.0), F.coalesce(percent_done(F.col("made"), F.col("wanted")), F.lit(0.0))))
