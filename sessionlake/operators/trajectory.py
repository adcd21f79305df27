"""Trajectory statistics, phases and debouncing; rows are ordered within their group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.operators.stats import came

STEP_S = 0.016


def motion(rows: DataFrame, by: str, order: str, value: str, step_s: float = STEP_S) -> DataFrame:
    """Adds speed and accel, differences by the time step; 0 in the first row."""
    w = Window.partitionBy(by).orderBy(order)
    out = rows.withColumn("speed", F.coalesce((F.col(value) - F.lag(value).over(w)) / step_s, F.lit(0.0)))
    return out.withColumn("accel", F.coalesce((F.col("speed") - F.lag("speed").over(w)) / step_s, F.lit(0.0)))


def episode_stats(rows: DataFrame, by: str, order: str, value: str, tail: int = 10) -> DataFrame:
    """n, mean, population std, min, max, mean of the last rows, mean and largest |speed|, last value."""
    moved = motion(rows, by, order, value).withColumn("_back", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(order))))
    return moved.groupBy(by).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(F.when(F.col("_back") <= tail, F.col(value))).alias("tail_mean"), F.avg(F.abs("speed")).alias("speed_mean"), F.max(F.abs("speed")).alias("speed_max"),
        F.max_by(value, order).alias("final"))


def success_rates(rows: DataFrame, episode: str, env: str, success: str) -> DataFrame:
    """Per episode, and per episode and environment: n, successes, failures and success_pct; env is null for the whole episode."""
    won = F.col(success).cast("int")
    found = rows.groupingSets([[F.col(episode)], [F.col(episode), F.col(env)]], F.col(episode), F.col(env)).agg(
        F.grouping_id().alias("_g"), F.count(won).alias("n"), F.sum(won).alias("successes"), (F.avg(won) * 100).alias("success_pct"))
    return found.select(episode, env, (F.col("_g") > 0).alias("whole"), "n", "successes", (F.col("n") - F.col("successes")).alias("failures"), "success_pct")


def phase_spans(rows: DataFrame, by: str, order: str, phase: str) -> DataFrame:
    """Runs of one phase: span, phase, first and last order value, n."""
    w = Window.partitionBy(by).orderBy(order)
    change = F.coalesce((F.col(phase) != F.lag(phase).over(w)).cast("int"), F.lit(1))
    runs = rows.withColumn("_change", change).withColumn("span", F.sum("_change").over(w))
    return runs.groupBy(by, "span").agg(F.first(phase).alias("phase"), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def phase_baseline(rows: DataFrame, by: str, phase: str, value: str, rest: str) -> DataFrame:
    """Per phase the mean and largest of value minus the group's mean over the rest phase."""
    base = F.avg(F.when(F.col(phase) == rest, F.col(value))).over(Window.partitionBy(by))
    return rows.withColumn("_net", F.col(value) - base).groupBy(by, phase).agg(F.avg("_net").alias("net_mean"), F.max("_net").alias("net_max"), F.count("*").alias("n"))


def peak_anchored(rows: DataFrame, by: str, phase: str, value: str, phases: list[str], share: float = 0.3) -> DataFrame:
    """In the given phases value becomes peak + share * (value - mean), both over those phases."""
    inside = F.col(phase).isin(phases)
    w = Window.partitionBy(by)
    peak, mean = F.max(F.when(inside, F.col(value))).over(w), F.avg(F.when(inside, F.col(value))).over(w)
    return rows.withColumn("anchored", F.when(inside, peak + share * (F.col(value) - mean)).otherwise(F.col(value)))


def debounce(rows: DataFrame, by: str, order: str, inside: str, stable: int = 30) -> DataFrame:
    """Adds streak, the rows in tolerance up to here since the last one out of it, and paused: streak >= stable."""
    w = Window.partitionBy(by).orderBy(order)
    runs = rows.withColumn("_run", F.sum((~F.col(inside)).cast("int")).over(w))
    streak = F.count_if(F.col(inside)).over(Window.partitionBy(by, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return runs.withColumn("streak", streak).withColumn("paused", F.col("streak") >= stable).drop("_run")


def monotonic_clock(rows: DataFrame, by: str, order: str) -> DataFrame:
    """Adds clock: t, or the clock before plus one where t isn't later."""
    w = Window.partitionBy(by).orderBy(*came(rows, order))
    n = rows.withColumn("_n", F.row_number().over(w).cast("long"))
    return n.withColumn("clock", F.max(F.col("t") - F.col("_n")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("_n")).drop("_n")


def densify(rows: DataFrame, by: str, order: str, step: int) -> DataFrame:
    """Grid times between consecutive rows, `step` apart, each with the row they follow."""
    rows = rows.withColumn("_end", F.coalesce(F.lead(order).over(Window.partitionBy(by).orderBy(order)) - 1, F.col(order)))
    return rows.withColumn("grid_t", F.explode(F.sequence(F.col(order), F.greatest(F.col(order), F.col("_end")), F.lit(step).cast("long")))).drop("_end")
