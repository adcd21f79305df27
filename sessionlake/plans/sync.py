"""Alignment: frames are view events, robot click, gripper purchase, pressure signup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.operators import asof, stats
from sessionlake.plans.registry import EV, events, of, query

DAY_US = 86_400_000_000
STREAMS = {"robot": "click", "gripper": "purchase", "pressure": "signup"}


def _bracketed(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    e = events(spark, sf_dir)
    return asof.brackets(of(e, "view"), {n: of(e, STREAMS[n]) for n in names})


def _nearest_sql(name: str) -> str:
    return f"""{name} as (select f.row_index, coalesce(g.row_index, -1)::bigint as idx, coalesce(g.t - f.t, 0)::bigint as dt,
        coalesce((abs(g.t - f.t) <= {DAY_US})::int, 0)::int as valid,
        row_number() over (partition by f.row_index order by abs(g.t - f.t), g.t, g.row_index) as rn
        from f left join ev g on g.session = f.session and g.modality = '{STREAMS[name]}' qualify rn = 1)"""


F_SQL = "f as (select * from ev where modality = 'view')"


def _bracket_sql(name: str) -> str:
    m = STREAMS[name]
    return f"""{name} as (select f.session, f.row_index, f.t, a.t as lo_t, a.row_index as lo_i, a.value as lo_v, a.code as lo_c, b.t as hi_t, b.row_index as hi_i, b.value as hi_v, b.code as hi_c,
        case when a.t is null then b.value when b.t is null then a.value else a.value + (b.value - a.value) * ((f.t - a.t) / (b.t - a.t)) end as v,
        case when b.t is null or (a.t is not null and f.t - a.t <= b.t - f.t) then a.t else b.t end as near_t,
        case when b.t is null or (a.t is not null and f.t - a.t <= b.t - f.t) then a.code else b.code end as near_c
        from f asof left join (select * from ev where modality = '{m}') a on a.session = f.session and f.t > a.t
               asof left join (select * from ev where modality = '{m}') b on b.session = f.session and f.t <= b.t)"""


@query(f"with {EV}, {F_SQL}, {_nearest_sql('robot')} select f.session, f.row_index, idx as robot_index, dt as robot_dt_us, valid as robot_valid from f join robot using (row_index)")
def asof_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bracketed(spark, sf_dir, ["robot"]).select("session", "row_index", *asof.nearest_columns("robot", DAY_US))


@query(f"with {EV}, {F_SQL}, {_nearest_sql('robot')} select f.session, f.row_index, idx as robot_index, dt as robot_dt_us from f join robot using (row_index) where valid = 1")
def asof_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_nearest(spark, sf_dir).filter("robot_valid = 1").drop("robot_valid")


@query(f"""with {EV}, {F_SQL}, {", ".join(map(_nearest_sql, STREAMS))}
    select f.session, f.row_index, {", ".join(f"{n}.idx as {n}_index, {n}.dt as {n}_dt_us, {n}.valid as {n}_valid" for n in STREAMS)}
    from f {" ".join(f"join {n} on {n}.row_index = f.row_index" for n in STREAMS)}""")
def sync_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c for n in STREAMS for c in asof.nearest_columns(n, DAY_US)]
    return _bracketed(spark, sf_dir, list(STREAMS)).select("session", "row_index", *columns)


@query(f"""with {EV}, {F_SQL}, {", ".join(map(_nearest_sql, STREAMS))}
    select f.session, f.row_index, {", ".join(f"{n}.idx as {n}_index, {n}.dt as {n}_dt_us, {n}.valid as {n}_valid" for n in STREAMS)}
    from f {" ".join(f"join {n} on {n}.row_index = f.row_index" for n in STREAMS)}""")
def sync_index_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sync index by cells of a day, for sessions that are too long for one window."""
    e = events(spark, sf_dir)
    found = asof.bucketed_brackets(of(e, "view"), {n: of(e, m) for n, m in STREAMS.items()}, DAY_US)
    return found.select("session", "row_index", *(c for n in STREAMS for c in asof.nearest_columns(n, DAY_US)))


@query(f"""with {EV}, {F_SQL}, {_bracket_sql('robot')} select session, row_index, round(v, 6) as value,
    round(coalesce(lo_c + (hi_c - lo_c) * ((t - lo_t) / (hi_t - lo_t)), lo_c, hi_c)::double, 6) as code, round((coalesce(lo_t, hi_t) - t) / 1000.0::double, 3) as offset_ms from robot""")
def interp_mixed_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """interp_mixed by cells of six hours."""
    e = events(spark, sf_dir)
    found = asof.bucketed_brackets(of(e, "view"), {"robot": of(e, "click")}, DAY_US // 4)
    return found.select("session", "row_index", F.round(asof.interpolated("robot"), 6).alias("value"), F.round(asof.interpolated_code("robot"), 6).alias("code"), F.round(asof.offset_ms("robot", "before"), 3).alias("offset_ms"))


@query(f"""with {EV}, {F_SQL}, {_nearest_sql('robot')} select f.session, count(*)::bigint as frames, sum(valid)::bigint as valid_frames,
    round(avg(case when dt <> 0 then abs(dt) end), 3) as mean_abs_dt_us, max(case when dt <> 0 then abs(dt) end)::bigint as max_abs_dt_us, sum(idx)::bigint as idx_sum
    from f join robot using (row_index) group by f.session""")
def sync_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.sync_summary(asof_nearest(spark, sf_dir), "robot")


@query(f"with {EV}, {F_SQL}, {_bracket_sql('robot')} select session, row_index, coalesce(lo_i, hi_i) as lo_index, coalesce(hi_i, lo_i) as hi_index from robot")
def asof_bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo, hi = F.col("robot_lo.row_index"), F.col("robot_hi.row_index")
    return _bracketed(spark, sf_dir, ["robot"]).select("session", "row_index", F.coalesce(lo, hi).alias("lo_index"), F.coalesce(hi, lo).alias("hi_index"))


@query(f"with {EV}, {F_SQL}, {_bracket_sql('robot')} select session, row_index, round(v, 6) as value, near_c as code, round((near_t - t) / 1000.0::double, 3) as offset_ms from robot")
def interp_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bracketed(spark, sf_dir, ["robot"]).select("session", "row_index", F.round(asof.interpolated("robot"), 6).alias("value"), asof.nearest("robot")["code"].alias("code"), F.round(asof.offset_ms("robot"), 3).alias("offset_ms"))


@query(f"""with {EV}, {F_SQL}, {_bracket_sql('robot')} select session, row_index, round(v, 6) as value,
    round(coalesce(lo_c + (hi_c - lo_c) * ((t - lo_t) / (hi_t - lo_t)), lo_c, hi_c)::double, 6) as code, round((coalesce(lo_t, hi_t) - t) / 1000.0::double, 3) as offset_ms from robot""")
def interp_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bracketed(spark, sf_dir, ["robot"]).select("session", "row_index", F.round(asof.interpolated("robot"), 6).alias("value"), F.round(asof.interpolated_code("robot"), 6).alias("code"), F.round(asof.offset_ms("robot", "before"), 3).alias("offset_ms"))


@query(f"""with {EV}, {F_SQL}, {", ".join(map(_bracket_sql, STREAMS))}
    select f.session, f.row_index, {", ".join(f"round({n}.v, 6) as {n}_value, round(({n}.near_t - f.t) / 1000.0::double, 3) as {n}_offset_ms" for n in STREAMS)}
    from f {" ".join(f"join {n} on {n}.row_index = f.row_index" for n in STREAMS)}""")
def align_3way(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c for n in STREAMS for c in (F.round(asof.interpolated(n), 6).alias(f"{n}_value"), F.round(asof.offset_ms(n), 3).alias(f"{n}_offset_ms"))]
    return _bracketed(spark, sf_dir, list(STREAMS)).select("session", "row_index", *columns)


@query(f"""with {EV}, {F_SQL}, {_bracket_sql('robot')}, o as (select session, abs((near_t - t) / 1000.0::double) as a from robot where near_t is not null)
    select session, count(*)::bigint as n, round(avg(a), 6) as mean_ms, round(list_sort(list(a))[1 + floor(count(*) * 0.95::double)::bigint], 3) as p95_ms, round(max(a), 3) as max_ms,
    count(*) filter (a > 3600000)::bigint as n_over from o group by session""")
def align_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.offset_quality(_bracketed(spark, sf_dir, ["robot"]).select("session", asof.offset_ms("robot").alias("offset_ms")), "session", 3_600_000)
    return found.withColumns({c: F.round(c, k) for c, k in (("mean_ms", 6), ("p95_ms", 3), ("max_ms", 3))})


@query("""with e as (select user_id as session, min(epoch_us(ts)) as anchor, count(*) as n from events group by 1)
    select session, i::bigint as row_index, (anchor + i * 33333)::bigint as t from e, unnest(range(n)) as u(i)""")
def synthetic_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    anchors = events(spark, sf_dir).groupBy("session").agg(F.min("t").alias("anchor"), F.count("*").alias("n"))
    frames = anchors.select("session", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("row_index"))
    return asof.synthetic_timeline(frames, anchors).select("session", "row_index", "t")


SAMPLES = "s as (select session, row_index, value, (row_number() over (partition by session order by row_index) - 1)::bigint as i, count(*) over (partition by session)::bigint as n from ev where modality = '{}')"


def _numbered(spark: SparkSession, sf_dir: str, modality: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("session")
    return of(events(spark, sf_dir), modality).select("session", "row_index", "value", (F.row_number().over(w.orderBy("row_index")) - 1).cast("long").alias("i"), F.count("*").over(w).alias("n"))


def _with_source(spark: SparkSession, sf_dir: str, index) -> DataFrame:
    """Frames with the robot sample at a computed index."""
    robot = _numbered(spark, sf_dir, "click").select("session", F.col("i").alias("source"), F.col("value").alias("source_value"), F.col("n").alias("rows"))
    counts = robot.groupBy("session").agg(F.count("*").alias("rows"))
    frames = _numbered(spark, sf_dir, "view").join(counts, "session")
    return frames.withColumn("source", index).join(robot.drop("rows"), ["session", "source"]).select("session", "row_index", "source", "source_value")


def _source_sql(expr: str) -> str:
    a, b = SAMPLES.format("view"), SAMPLES.format("click").replace("s as", "g as", 1)
    return f"""with {EV}, {a}, {b}, c as (select session, count(*)::bigint as rows from g group by 1), x as (select s.*, c.rows, {expr} as source from s join c using (session))
        select x.session, x.row_index, x.source::bigint as source, g.value as source_value from x join g on g.session = x.session and g.i = x.source"""


@query(_source_sql("case when n > 1 then (i * (rows - 1)) // (n - 1) else 0 end"))
def proportional_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sessionlake.operators import episodes

    return _with_source(spark, sf_dir, episodes.resample_index(F.col("i"), F.col("rows"), F.col("n")))


@query(_source_sql("least((i * rows) // n, rows - 1)"))
def index_ratio_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sessionlake.operators import episodes

    return _with_source(spark, sf_dir, episodes.ratio_index(F.col("i"), F.col("n"), F.col("rows")))


@query(f"""with {EV}, a as (select session, row_index, row_number() over (partition by session order by row_index) as pos from ev where modality = 'view'),
    b as (select session, row_index as other, row_number() over (partition by session order by row_index) as pos from ev where modality = 'click')
    select session, pos::int as pos, row_index, other from a join b using (session, pos)""")
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sessionlake.operators import episodes

    e = events(spark, sf_dir)
    return episodes.zip_by_position(of(e, "view").select("session", "row_index"), of(e, "click").select("session", F.col("row_index").alias("other")), "session", "row_index", "other")


@query(f"""with {EV}, a as (select session, row_index, (row_index % 20)::bigint as at from ev where modality = 'view'),
    b as (select session, value, (row_number() over (partition by session order by row_index) - 1)::bigint as i from ev where modality = 'click')
    select a.session, a.row_index, a.at, coalesce(b.value, 0.0) as value from a left join b on b.session = a.session and b.i = a.at""")
def index_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sessionlake.operators import episodes

    left = of(events(spark, sf_dir), "view").select("session", "row_index", (F.col("row_index") % 20).alias("at"))
    right = _numbered(spark, sf_dir, "click").select("session", F.col("i").alias("row_index"), "value")
    return episodes.gather(left, "at", right, ["session"], ["value"])


@query(f"""with {EV}, a as (select row_index, session, t from ev where modality = 'error'), b as (select session, t, row_index from ev where modality = 'click')
    select a.session, a.row_index, b.row_index as force_index from a asof left join b on a.session = b.session and a.t <= b.t""")
def asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return asof.brackets(of(e, "error"), {"force": of(e, "click")}).select("session", "row_index", F.col("force_hi.row_index").alias("force_index"))
