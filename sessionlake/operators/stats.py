"""Timing, quality and channel statistics of streams; arrival is the order in which rows came."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.session import small, stage


def came(stream: DataFrame, arrival: str = "arrival") -> list[str]:
    """Columns that put a stream in order of arrival; rows that arrive at once keep the order of row_index, where there is one."""
    return [arrival, "row_index"] if "row_index" in stream.columns and arrival != "row_index" else [arrival]


def deltas(stream: DataFrame, by: list[str], arrival: str = "arrival") -> DataFrame:
    """Adds delta, t minus the t of the row that came before."""
    return stream.withColumn("delta", F.col("t") - F.lag("t").over(Window.partitionBy(*by).orderBy(*came(stream, arrival))))


def timing(stream: DataFrame, by: list[str], arrival: str = "arrival") -> DataFrame:
    """n, duration_us (largest - smallest t), hz_mean, hz_median (of positive deltas), duplicates, reversals."""
    found = deltas(stream, by, arrival).groupBy(*by).agg(
        F.count("t").alias("n"), (F.max("t") - F.min("t")).alias("duration_us"), F.median(F.when(F.col("delta") > 0, F.col("delta"))).alias("_m"),
        (F.count("t") - F.countDistinct("t")).alias("duplicates"), F.count_if(F.col("delta") < 0).alias("reversals"),
    )
    rate = F.when((F.col("n") >= 2) & (F.col("duration_us") > 0), (F.col("n") - 1) * 1e6 / F.col("duration_us"))
    return found.select(*by, "n", "duration_us", rate.alias("hz_mean"), (1e6 / F.col("_m")).alias("hz_median"), "duplicates", "reversals")


def timing_checker(stream: DataFrame, by: list[str], arrival: str = "arrival", near_us: int = 5) -> DataFrame:
    """The session checker's variant: duration last - first, positive intervals in ms, gaps over twice their mean."""
    ms = F.when(F.col("delta") > 0, F.col("delta") / 1000.0)
    rows = deltas(stream, by, arrival).withColumn("ms", ms).withColumn("_mean", F.avg("ms").over(Window.partitionBy(*by)))
    gap, order = F.col("ms") > 2 * F.col("_mean"), F.struct(*came(stream, arrival))
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), (F.max_by("t", order) - F.min_by("t", order)).alias("duration_us"),
        F.avg("ms").alias("mean_ms"), F.median("ms").alias("median_ms"), F.stddev_samp("ms").alias("std_ms"), F.min("ms").alias("min_ms"), F.max("ms").alias("max_ms"),
        F.count_if(gap).alias("gaps"), F.max(F.when(gap, F.col("ms"))).alias("max_gap_ms"), F.count_if((F.col("delta") > 0) & (F.col("delta") < near_us)).alias("near_duplicates"),
    ).withColumn("mean_hz", 1000.0 / F.col("mean_ms"))


def reordered(stream: DataFrame, by: str, arrival: str = "arrival") -> DataFrame:
    """Rows whose position holds another t once the stream is sorted by (t, arrival)."""
    w, order = Window.partitionBy(by), came(stream, arrival)
    first = stream.select(by, "t", F.row_number().over(w.orderBy(*order)).alias("pos"))
    then = stream.select(by, F.col("t").alias("sorted_t"), F.row_number().over(w.orderBy("t", *order)).alias("pos"))
    return first.join(then, [by, "pos"]).groupBy(by).agg(F.count_if(F.col("t") != F.col("sorted_t")).alias("rows_reordered"))


def offset_audit(offsets: DataFrame, by: str, columns: list[str], over_ms: float = 50.0) -> DataFrame:
    """Of rows with any offset: rows, the largest |offset| of any column, and rows whose own largest is over the limit."""
    worst = F.array_max(F.array(*(F.abs(c) for c in columns)))
    rows = offsets.withColumn("_w", worst).filter("_w is not null")
    return rows.groupBy(by).agg(F.count("*").alias("rows"), F.max("_w").alias("max_abs_ms"), F.count_if(F.col("_w") > over_ms).alias("rows_over"))


def null_audit(cells: DataFrame, by: list[str], cell: Column, is_time: Column) -> DataFrame:
    """Blank cells, as they are counted by the checker: a timestamp that is no number counts, and once more if it is blank."""
    from sessionlake.functions import parse

    blank = parse.is_blank(cell)
    unread = is_time & parse.safe_int(cell).isNull()
    return cells.groupBy(*by).agg(F.count("*").alias("cells"), (F.count_if(blank) + F.count_if(unread)).alias("nulls"))


#: Values of a group that are sorted at once, ranges that a pass counts, and groups that may be broadcast.
SORTED, RANGES, GROUPS = 4096, 1024, 500_000


def floor_percentile(values: DataFrame, by: str, value: str, share: float) -> DataFrame:
    """by and value: sorted[int(n * share)] of each group's finite values, exactly, however many they are.

    Passes count a group's values in equal ranges between its bounds and keep the range that holds the wanted place,
    until at most SORTED values are left, or equal ones; those are sorted. A pass is a partial aggregate, so no group
    meets in one task. Nulls, NaN and infinite values don't count.
    """

    def met(rows: DataFrame, groups: DataFrame) -> DataFrame:
        groups = small(groups, GROUPS).withColumnRenamed(by, "_by")
        return rows.join(groups, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")

    number = F.col(value).cast("double")
    left = stage(values.select(by, number.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < float("inf"))), "values")
    n = F.count("*")
    at = stage(left.groupBy(by).agg(F.least(F.floor(n * F.lit(share)), n - 1).alias("_k"), n.alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "places")
    found = None
    while True:
        done = F.col("_lo") == F.col("_hi")
        few = (F.col("_n") <= SORTED) & ~done
        equal = at.filter(done).select(by, F.col("_lo").alias(value))
        near = met(left, at.filter(few)).groupBy(by).agg(F.get(F.sort_array(F.collect_list("_v")), F.any_value("_k").cast("int")).alias(value))
        found = equal.union(near) if found is None else found.union(equal).union(near)
        large = at.filter(~done & ~few)
        if large.isEmpty():
            return found
        place = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * RANGES)
        ranged = met(left, large).withColumn("_r", F.least(F.lit(RANGES - 1), place))
        counts = ranged.groupBy(by, "_r").agg(F.count("*").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.any_value("_k").alias("_k"))
        before = F.coalesce(F.sum("_c").over(Window.partitionBy(by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # at most RANGES rows
        chosen = counts.withColumn("_b", before).filter((F.col("_k") >= F.col("_b")) & (F.col("_k") < F.col("_b") + F.col("_c")))
        at = stage(chosen.select(by, (F.col("_k") - F.col("_b")).alias("_k"), F.col("_c").alias("_n"), "_lo", "_hi"), "places")
        left = stage(met(left, at.select(by, "_lo", "_hi")).filter(F.col("_v").between(F.col("_lo"), F.col("_hi"))).select(by, "_v"), "values")


def offset_quality(offsets: DataFrame, by: str, over_ms: float = 10.0) -> DataFrame:
    """mean, p95 (floor index), largest |offset_ms| and rows over the limit."""
    sizes = stage(offsets.filter("offset_ms is not null").select(by, F.abs("offset_ms").alias("_a")), "offsets")
    a = F.col("_a")
    sums = sizes.groupBy(by).agg(F.count("*").alias("n"), F.avg(a).alias("mean_ms"), F.max(a).alias("max_ms"), F.count_if(a > over_ms).alias("n_over"))
    p95 = floor_percentile(sizes, by, "_a", 0.95).select(F.col(by).alias("_by"), F.col("_a").alias("p95_ms"))
    return sums.join(p95, F.col(by).eqNullSafe(F.col("_by")), "left").select(by, "n", "mean_ms", "p95_ms", "max_ms", "n_over")


def channels_long(wide: DataFrame, keys: list[str], channels: list[str]) -> DataFrame:
    return wide.unpivot(keys, channels, "channel", "value")


def channel_stats(long: DataFrame, by: str) -> DataFrame:
    """Per (by, channel) and per channel over all: n, mean, max, min, sample std (0 for fewer than two)."""
    whole = long.groupingSets([[F.col(by), F.col("channel")], [F.col("channel")]], F.col(by), F.col("channel"))
    return whole.agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("max"), F.min("value").alias("min"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"))


def out_of_range(long: DataFrame, low: float = 0, high: float = 5007) -> DataFrame:
    """Channels with values outside [low, high]: how many, smallest and largest; most first, then by name."""
    bad = long.groupBy("channel").agg(F.count_if(~F.col("value").between(low, high)).alias("n_bad"), F.min("value").alias("min"), F.max("value").alias("max"))
    return bad.filter("n_bad > 0").orderBy(F.desc("n_bad"), "channel")


def rate_snapshot(stream: DataFrame, by: str, target_hz: float, recent_us: int = 1_000_000) -> DataFrame:
    """Average rate, samples of the last second, population std of intervals, jitter %, estimate of dropped samples."""
    rows = stream.withColumn("delta", F.col("t") - F.lag("t").over(Window.partitionBy(by).orderBy("t"))).withColumn("_end", F.max("t").over(Window.partitionBy(by)))
    found = rows.groupBy(by).agg(F.count("*").alias("n"), F.avg("delta").alias("mean_us"), F.stddev_pop("delta").alias("std_us"), F.count_if(F.col("t") >= F.col("_end") - recent_us).alias("recent"), (F.max("t") - F.min("t")).alias("span_us"))
    expected = F.floor(F.col("span_us") * target_hz / 1e6)
    return found.select(by, "n", (1e6 / F.col("mean_us")).alias("avg_hz"), "recent", "std_us", (100 * F.col("std_us") / F.col("mean_us")).alias("jitter_pct"), F.greatest(F.lit(0).cast("long"), expected - F.col("n")).alias("dropped"))


def histogram(values: DataFrame, low: float, high: float, bins: int = 10) -> DataFrame:
    """Equal bins; values beyond the ends count in the outer bins."""
    k = F.floor((F.col("value") - low) / ((high - low) / bins))
    return values.filter("value is not null").groupBy(F.least(F.lit(bins - 1), F.greatest(F.lit(0), k)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def percent_done(done: Column, total: Column) -> Column:
    return F.try_divide(done * 100.0, total)
