"""Episodes and steps, index joins, resampling, splits and annotation ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions import parse


def steps(rows: DataFrame, episode: str, order: str, state: str, least: int = 2) -> DataFrame:
    """Steps of episodes of at least two rows: step, is_first, is_last, action (next state - state; zeros at the end)."""
    w = Window.partitionBy(episode)
    nxt = F.lead(state).over(w.orderBy(order))
    out = rows.withColumn("step", F.row_number().over(w.orderBy(order)) - 1).withColumn("_n", F.count("*").over(w))
    out = out.withColumn("action", F.coalesce(F.zip_with(nxt, F.col(state), lambda a, b: a - b), F.transform(state, lambda x: F.lit(0.0))))
    out = out.filter(F.col("_n") >= least)
    return out.withColumn("is_first", F.col("step") == 0).withColumn("is_last", F.col("step") == F.col("_n") - 1).drop("_n")


def number_rows(rows: DataFrame, order: list[str], name: str = "_n", buckets: int | None = None) -> DataFrame:
    """Numbers from 0 over all rows in order, without ranking them in one task: ranks within ranges plus the ranges' starts."""
    ranged = rows.repartitionByRange(*([buckets] if buckets else []), *order).withColumn("_p", F.spark_partition_id())
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_c"))
    sizes = sizes.select("_p", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row a range
    local = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1)
    return local.join(F.broadcast(sizes), "_p").withColumn(name, F.col("_r") + F.col("_before")).drop("_p", "_r", "_before")


def number_episodes(episodes: DataFrame, order: str, buckets: int = 1024) -> DataFrame:
    """episode_id from 0 in order."""
    return number_rows(episodes, [order], "episode_id", buckets)


def gather(left: DataFrame, index: str, values: DataFrame, keys: list[str], columns: list[str], default: float = 0.0) -> DataFrame:
    """values' columns at row_index = index; default where the index is out of range."""
    right = values.select(*keys, F.col("row_index").alias("_at"), *(F.col(c).alias(f"_{c}") for c in columns))
    on = [left[k] == right[k] for k in keys] + [left[index] == right["_at"]]
    return left.join(right, on, "left").select(*(left[c] for c in left.columns), *(F.coalesce(right[f"_{c}"], F.lit(default)).alias(c) for c in columns))


def resample_index(position: Column, rows: Column, wanted: Column) -> Column:
    """Index of a proportional sample: linspace(0, rows - 1, wanted) at position, cut to an integer."""
    return F.when(wanted > 1, F.floor(position * (rows - 1) / (wanted - 1))).otherwise(F.lit(0)).cast("long")


def ratio_index(frame: Column, frames: Column, rows: Column) -> Column:
    return F.least((frame * rows / frames).cast("long"), rows - 1)


def zip_by_position(left: DataFrame, right: DataFrame, by: str, left_order: str, right_order: str) -> DataFrame:
    """Rows at equal positions of the two orders; the longer side's rest is left out."""
    a = left.withColumn("pos", F.row_number().over(Window.partitionBy(by).orderBy(left_order)))
    b = right.withColumn("pos", F.row_number().over(Window.partitionBy(by).orderBy(right_order)))
    return a.join(b, [by, "pos"])


def stable_hash_id(text: Column, size: int) -> Column:
    """MD5 of the text modulo a vocabulary size that is a power of two up to 2^32."""
    if size & (size - 1) or not 0 < size <= 1 << 32:
        raise ValueError("size must be a power of two up to 2^32")
    return F.conv(F.right(F.md5(text), F.lit(8)), 16, 10).cast("long") % size


def expand_ranges(notes: DataFrame, key: str) -> DataFrame:
    """A row per row number of row_start..row_end; ranges that end before they start give none."""
    good = notes.filter(F.col("row_start") <= F.col("row_end"))
    return good.withColumn("row", F.explode(F.sequence("row_start", "row_end"))).drop("row_start", "row_end")


def pages(rows: DataFrame, by: str, order: str, size: int = 12) -> DataFrame:
    """Sheets of `size` rows in order: sheet (from 0), first, last and n."""
    numbered = rows.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1)
    return numbered.groupBy(by, F.floor(F.col("_n") / size).alias("sheet")).agg(F.min_by(order, "_n").alias("first"), F.max_by(order, "_n").alias("last"), F.count("*").alias("n"))


def pick_index(n: Column, share: float) -> Column:
    """round((n - 1) * share), halves to even, within the rows."""
    return F.greatest(F.lit(0), F.least(n - 1, F.bround((n - 1) * F.lit(share), 0).cast("long")))


def rank_in(value: Column, order: list[str]) -> Column:
    """Place in a given order, 999 where it isn't in it."""
    at = F.array_position(F.array(*map(F.lit, order)), value)
    return F.when(at > 0, at - 1).otherwise(F.lit(999)).cast("long")


def intersection(stems: DataFrame, keys: list[str], stream: str, required: int) -> DataFrame:
    """Keys that are present in all required streams."""
    return stems.groupBy(*keys).agg(F.countDistinct(stream).alias("_k")).filter(F.col("_k") == required).drop("_k")


def missing_ids(rows: DataFrame, by: str, number: str) -> DataFrame:
    """Ids between the smallest and the largest that are absent: missing (how many)."""
    return rows.groupBy(by).agg((F.max(number) - F.min(number) + 1 - F.countDistinct(number)).cast("long").alias("missing"))


def semi_on_stem(rows: DataFrame, files: DataFrame, path: str, stem: str) -> DataFrame:
    """Rows whose stem a file has: its name without folders and the last ending."""
    stems = files.select(F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1).alias(stem)).distinct()
    return rows.join(stems, stem, "left_semi")


def image_order(name: Column) -> list[Column]:
    """Sort keys of images: by number where the stem is one, others last, then by name."""
    stem = F.regexp_extract(name, r"([^/]*?)(?:\.[^./]*)?$", 1)
    return [F.coalesce(stem.try_cast("long"), F.lit(10**12)), name]


def first_of_each(rows: DataFrame, by: list[str], order: list, most: int) -> DataFrame:
    """The first rows of each bucket, for reports."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_n") <= most).drop("_n")


def newest(sessions: DataFrame, name: str, most: int, *ties: str) -> DataFrame:
    """The newest sessions, whose names begin with their time; of equal names those with the greatest tie columns."""
    return sessions.orderBy(F.desc(name), *(F.desc(c) for c in ties)).limit(most)


def present_lists(rows: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Sorted distinct values of columns, per group."""
    return rows.groupBy(by).agg(*(F.array_sort(F.collect_set(c)).alias(c) for c in columns))


def clock_offset(rows: DataFrame, by: str, order: str, host: str, sensor: str, head: int = 100) -> DataFrame:
    """Median of host minus sensor clock over each session's first rows."""
    return first_of_each(rows, [by], [order], head).groupBy(by).agg(F.median(F.col(host) - F.col(sensor)).alias("offset"))


def without_arm(joints: Column) -> Column:
    """Joints, or six zeros where there are none."""
    return F.coalesce(F.when(F.size(joints) > 0, joints), F.array(*[F.lit(0.0)] * 6))


def sorted_series(rows: DataFrame, by: str, text: str, arrival: str = "arrival") -> DataFrame:
    """Whole-number timestamps of text cells: those that are none go, of equal ones the first to arrive stays; by, t, pos."""
    t = parse.safe_int(F.col(text))
    first = rows.withColumn("t", t).filter("t is not null").groupBy(by, "t").agg(F.min(arrival).alias("_a"))
    return first.withColumn("pos", F.row_number().over(Window.partitionBy(by).orderBy("t"))).drop("_a")


def merged_windows(parts: list[DataFrame], info: list[str]) -> DataFrame:
    """Windows of several sources in one table, with the session columns that each has and null for others."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*info, *(c for c in out.columns if c not in info))
