"""Live ingestion over the driver's events: clocks, batches and alignment made in the stream, and sensor packets."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.functions import parse
from sessionlake.plans.registry import EV, events, query, r6, table
from sessionlake.session import shared_folder
from sessionlake.sources import packets
from sessionlake.streaming import operators as streaming
from sessionlake.streaming import ordered

#: Within so long a frame's samples are looked for, and so late a row may come.
WITHIN, LATE = "12 hours", "2 days"


def _marked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str]:
    """Events as a stream with marks, the events, and the marks' folder."""
    like = table(spark, sf_dir, "events")
    marks = f"{shared_folder(spark)}/marks-{uuid.uuid4().hex}"
    return ordered.with_marks(streaming.read_folder(spark, like, f"{sf_dir}/event[s].parquet"), marks), like, marks


def _by_hours(stream: DataFrame) -> DataFrame:
    hours = F.expr("unix_micros(cast(ts as timestamp)) div 3600000000")
    return streaming.with_event_time(stream, late=LATE).select(F.col("user_id").alias("session"), "event_time", F.col("event_id").alias("row_index"), hours.alias("t"))


@query(f"""with {EV}, o as (select session, row_index, t // 3600000000 as h, row_number() over (partition by session order by t, row_index) as rn from ev)
    select session, row_index, (max(h - rn) over (partition by session order by rn) + rn)::bigint as clock from o""")
def stream_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict clock made in the stream, by event time, over two runs from one checkpoint."""
    stream, like, marks = _marked(spark, sf_dir)
    return ordered.run_closed(ordered.strict_clock(_by_hours(stream), "session"), shared_folder(spark), marks, like)


@query(f"""with {EV}, o as (select session, row_index, t, t // 3600000000 as h, coalesce((t - lag(t) over (partition by session order by t, row_index) >= 43200000000)::int, 1) as cut from ev),
    g as (select *, sum(cut) over (partition by session order by t, row_index) as run from o), b as (select *, (row_number() over (partition by session, run order by t, row_index) - 1) // 4 as part from g)
    select session, min(t)::bigint as start_us, max(t)::bigint as end_us, count(*)::bigint as n, sum(h)::bigint as total from b group by session, run, part""")
def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flushes of at most four rows, or after half a day without one."""
    stream, like, marks = _marked(spark, sf_dir)
    found = ordered.batches(_by_hours(stream), "session", 4, 12 * 3_600_000_000)
    return ordered.run_closed(found, shared_folder(spark), marks, like)


@query(f"""with {EV}, f as (select * from ev where modality = 'view'), s as (select * from ev where modality = 'click'),
    c as (select f.session, f.t, f.row_index, max((s.t, s.row_index, s.value)) filter (s.t < f.t) as lo, min((s.t, s.row_index, s.value)) filter (s.t >= f.t) as hi
          from f left join s on s.session = f.session and s.t between f.t - 43200000000 and f.t + 43200000000 group by 1, 2, 3)
    select session, row_index, lo[2] as lo_index, hi[2] as hi_index, round(case when lo is null then hi[3] when hi is null then lo[3] else lo[3] + (hi[3] - lo[3]) * ((t - lo[1]) / (hi[1] - lo[1])) end, 6) as value from c""")
def stream_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Robot samples around each frame on the line between them, joined while both stream in; the only one at an edge."""
    stream, like, marks = _marked(spark, sf_dir)
    timed = streaming.with_event_time(stream, late=LATE).select(F.col("user_id").alias("session"), "event_time", F.col("event_id").alias("row_index"), "value", "event_type")
    of = lambda kind: timed.filter((F.col("event_type") == kind) | F.col("event_type").isNull())  # noqa: E731  marks stay
    rows = ordered.run_closed(ordered.aligned(of("view"), of("click"), WITHIN), shared_folder(spark), marks, like).filter("row_index is not null")
    part = (F.col("t") - F.col("lo.t")) / (F.col("hi.t") - F.col("lo.t"))
    line = F.when(F.col("lo").isNull(), F.col("hi.value")).when(F.col("hi").isNull(), F.col("lo.value")).otherwise(F.col("lo.value") + (F.col("hi.value") - F.col("lo.value")) * part)
    return rows.select("session", "row_index", F.col("lo.row_index").alias("lo_index"), F.col("hi.row_index").alias("hi_index"), F.round(line, 6).alias("value"))


def _packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    raw = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda c: ((F.col("row_index") * 31 + c * F.col("code")) % 9000 - 1000).cast("int"))
    return e.select(F.col("t").alias("sensor_timestamp_us"), raw.alias("channels"))


@query(f"""with {EV}, p as (select t as sensor_timestamp_us, list_transform({list(parse.VALID_CHANNELS)}, lambda c: (row_index * 31 + c * code) % 9000 - 1000) as v from ev)
    select sensor_timestamp_us, v[1]::int as first, v[20]::int as last, list_sum(v)::bigint as total from p""")
def packet_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor packets written as framed records, then read as a stream in two runs while more packets come."""
    spark.dataSource.register(packets.Packets)
    folder = f"{shared_folder(spark)}/packets-{uuid.uuid4().hex}"
    rows = _packets(spark, sf_dir)
    stream = spark.readStream.format("packets").option("path", folder).load()
    run = ordered.Run(stream, shared_folder(spark))
    for half in (0, 1):
        rows.filter(F.col("sensor_timestamp_us") % 2 == half).write.format("packets").option("path", folder).mode("append").save()
        found = run.go()
    valid = F.array(*(F.get("channels", F.lit(c - 1)) for c in parse.VALID_CHANNELS))
    total = F.aggregate(valid, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("sensor_timestamp_us", F.get(valid, F.lit(0)).alias("first"), F.get(valid, F.lit(19)).alias("last"), total.alias("total"))


@query("select user_id, count(*)::bigint as n, round(avg(value), 6) as mean_ms, round(list_sort(list(value))[1 + least(count(*) - 1, floor(count(*) * 0.95::double)::bigint)], 6) as p95 from events group by 1")
def exact_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 95th percentile by floor index of each user's values, by counting passes."""
    from sessionlake.operators import stats

    rows = table(spark, sf_dir, "events").select("user_id", "value")
    p95 = stats.floor_percentile(rows, "user_id", "value", 0.95).withColumnRenamed("value", "p95")
    return r6(rows.groupBy("user_id").agg(F.count("*").alias("n"), F.avg("value").alias("mean_ms")).join(p95, "user_id"), "mean_ms", "p95")
