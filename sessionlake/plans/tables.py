"""Typed tables, channels, bands, audits and losses over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.functions import parse
from sessionlake.operators import asof, geometry, rules, stats, trajectory
from sessionlake.plans.health import D, dirty
from sessionlake.plans.registry import EV, events, of, query, r6, table
from sessionlake.plans.sync import STREAMS, F_SQL, _bracket_sql, _bracketed
from sessionlake.session import shared_folder
from sessionlake.sources import recordings, tables
from sessionlake.streaming import operators as streaming


@query("""with f as (select l_returnflag, l_orderkey as step, l_linenumber - 1 as phase, l_quantity as fx, l_extendedprice / 1000 as gx from lineitem), b as (select l_returnflag, avg(fx) filter (phase = 0) as bf, avg(gx) filter (phase = 0) as bg from f group by 1)
    select l_returnflag as log, phase::int as phase, count(*)::bigint as n, round(avg(abs(fx - bf) + abs(gx - bg)), 4) as mean_grip, round(max(abs(fx - bf) + abs(gx - bg)), 4) as max_grip from f join b using (l_returnflag) group by 1, 2""")
def force_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written as force logs, read back by their headers with types, and the grip less that of the rest phase."""
    folder = f"{shared_folder(spark)}/forces-{uuid.uuid4().hex}"
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.col("l_orderkey").alias("step"), (F.col("l_linenumber") - 1).alias("phase"), F.concat(F.lit("phase, "), F.col("l_linenumber").cast("string")).alias("phase_name"), F.col("l_quantity").alias("finger1_fx"),
        F.col("l_discount").alias("finger1_fy"), F.col("l_tax").alias("finger1_fz"), (F.col("l_extendedprice") / 1000).alias("finger2_fx"))
    li.write.partitionBy("l_returnflag").option("header", True).csv(folder)
    rows = tables.read_table(spark, folder, tables.FORCES).withColumn("log", F.regexp_extract("path", "l_returnflag=([^/]+)", 1))
    found = tables.grip_forces(rows, "log").groupBy("log", "phase").agg(F.count("*").alias("n"), F.avg("grip").alias("mean_grip"), F.max("grip").alias("max_grip"))
    return found.withColumns({c: F.round(c, 4) for c in ("mean_grip", "max_grip")})


#: A mapping file: the sensor's channels and one that is broken.
MAPPING = '{"LEFT_CHANNEL": 51, "RIGHT_CHANNEL": 50, "LEFT_MATRIX_CHANNELS": [[63, 60, 57], [64, 61, 58], [49, 62, 59]], "RIGHT_MATRIX_CHANNELS": [[47, 44, 41], [48, 45, 42], [33, 46, 43]], "INTERPOLATE_CHANNELS": {"58": [57, 59]}}'


@query("""select l_orderkey, l_linenumber, case when l_returnflag = 'R' then (l_orderkey % 30)::double else trunc((l_quantity + l_linenumber) / 2) end as fixed, l_linenumber::int as by_number, 0 as unknown from lineitem""")
def channel_repair_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A broken channel of aligned rows by its configured neighbours, both of which must be there; a channel by its number."""
    folder = f"{shared_folder(spark)}/mapping-{uuid.uuid4().hex}"
    spark.createDataFrame([(MAPPING,)], "value string").coalesce(1).write.text(folder)
    channels = tables.Channels.read(spark, folder)
    li = table(spark, sf_dir, "lineitem")
    rows = li.select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 30).cast("double").alias("pressure_CH58"), F.col("l_quantity").alias("pressure_CH57"), F.when(F.col("l_returnflag") != "R", F.col("l_linenumber").cast("double")).alias("pressure_CH59"))
    fixed = tables.repaired_aligned(rows, channels)
    values = F.transform(F.sequence(F.lit(1), F.lit(20)), lambda k: F.when(k == 11, F.col("l_linenumber")).otherwise(F.lit(-1)).cast("int"))
    return fixed.select("l_orderkey", "l_linenumber", F.col("pressure_CH58").alias("fixed"), channels.value(values, F.lit(59)).cast("int").alias("by_number"), channels.value(values, F.lit(7)).cast("int").alias("unknown"))


def _band(value: str, good: float, fair: float | None) -> str:
    return f"case when {value} >= {good} then 'good' {'' if fair is None else f'when {value} >= {fair} then {chr(39)}fair{chr(39)} '}else '{'fair' if fair is None else 'poor'}' end"


@query(f"""select {_band('value / 100', 0.9, 0.7)} as rate_share, {_band('value / 2', 27, 20)} as camera, {_band('value * 2', 108, None)} as robot, {_band('value * 3', 180, 120)} as pressure, {_band('value', 80, 50)} as success,
    case when value / 50 < 0.5 then 'good' when value / 50 < 1.0 then 'fair' else 'poor' end as reprojection, case when value / 10 < 2 and value / 2 < 10 then 'good' when value / 10 < 5 and value / 2 < 30 then 'fair' else 'poor' end as hand_eye, count(*)::bigint as n from events group by all""")
def status_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table of bands over events' values."""
    v = F.col("value")
    kinds = {"rate_share": rules.status("rate_share", v / 100), "camera": rules.status("camera_hz", v / 2), "robot": rules.status("robot_hz", v * 2), "pressure": rules.status("pressure_hz", v * 3), "success": rules.status("success_pct", v)}
    kinds |= {"reprojection": rules.error_status("reprojection_px", v / 50), "hand_eye": rules.error_status("hand_eye", v / 10, v / 2)}
    return table(spark, sf_dir, "events").select(*(c.alias(k) for k, c in kinds.items())).groupBy(*kinds).agg(F.count("*").alias("n"))


@query("""select user_id % 10 as episode, event_type as env, grouping(event_type) = 1 as whole, count(*)::bigint as n, (count(*) filter (value < 20))::bigint as successes, (count(*) filter (value >= 20))::bigint as failures, round(100.0::double * count(*) filter (value < 20) / count(*), 6) as success_pct
    from events group by grouping sets ((user_id % 10), (user_id % 10, event_type))""")
def env_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Success of episodes, and of each environment in them."""
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("episode"), F.col("event_type").alias("env"), (F.col("value") < 20).alias("won"))
    return r6(trajectory.success_rates(rows, "episode", "env", "won"), "success_pct")


@query(f"""with {EV}, a as (select row_index, session, t from ev where modality = 'error'), b as (select session, t, row_index from ev where modality = 'click'), l as (select session, max_by(row_index, (t, row_index)) as last from b group by 1)
    select a.session, a.row_index, coalesce(b.row_index, l.last) as force_index from a asof left join b on a.session = b.session and a.t <= b.t left join l on l.session = a.session""")
def asof_forward_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first force step at or after each frame, the last one for frames after all."""
    e = events(spark, sf_dir)
    return asof.brackets(of(e, "error"), {"force": of(e, "click")}).select("session", "row_index", asof.clipped_index("force").alias("force_index"))


@query(f"""with {EV}, {F_SQL}, {", ".join(map(_bracket_sql, STREAMS))}, o as (select f.session, greatest({", ".join(f"abs(({n}.near_t - f.t) / 1000.0::double)" for n in STREAMS)}) as w from f {" ".join(f"join {n} on {n}.row_index = f.row_index" for n in STREAMS)})
    select session, count(*)::bigint as rows, round(max(w), 3) as max_abs_ms, (count(*) filter (w > 43200000))::bigint as rows_over from o where w is not null group by 1""")
def offset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each session's largest offset of any stream, and rows whose largest is over half a day."""
    rows = _bracketed(spark, sf_dir, list(STREAMS)).select("session", *(asof.offset_ms(n).alias(f"{n}_offset_ms") for n in STREAMS))
    return stats.offset_audit(rows, "session", [f"{n}_offset_ms" for n in STREAMS], 43_200_000).withColumn("max_abs_ms", F.round("max_abs_ms", 3))


@query(f"with {D} select modality, count(*)::bigint as cells, ((count(*) filter (cell = '')) + (count(*) filter (cell = '' and code % 2 = 0)))::bigint as nulls from d group by 1")
def null_audit_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank cells as the checker counts them: those of a timestamp twice (cells of even codes stand for timestamps)."""
    return stats.null_audit(dirty(spark, sf_dir), ["modality"], F.col("cell"), F.col("code") % 2 == 0)


VECTORS = "e as (select vec_id, vec_id // 32 as batch, vec_id % 32 as k, embedding[1:32]::double[] as a, embedding[33:64]::double[] as p, embedding[17:48]::double[] as q from embeddings where len(embedding) = 64)"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").filter("size(embedding) = 64").withColumn("e", F.col("embedding").cast("array<double>"))
    return e.select("vec_id", F.expr("vec_id div 32").alias("batch"), (F.col("vec_id") % 32).alias("k"), *(F.slice("e", n, 32).alias(c) for c, n in (("a", 1), ("p", 33), ("q", 17))))


@query(f"""with {VECTORS}, v as (select x.batch, x.vec_id as i, x.a, y.p from e x join e y on y.batch = x.batch and y.k = (x.k * 7) % 13 where x.vec_id % 5 <> 0),
    l as (select x.batch, x.i, y.i as j, list_cosine_similarity(x.a, y.p) / 0.07::double as l from v x join v y on x.batch = y.batch), w as (select *, ln(sum(exp(l)) over (partition by batch, i)) - l as r, ln(sum(exp(l)) over (partition by batch, j)) - l as c from l)
    select batch, count(*)::bigint as n, round((avg(r) + avg(c)) / 2, 4) as loss from w where i = j group by 1""")
def gathered_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss of valid points against the patches that they fall on."""
    e = _vectors(spark, sf_dir)
    points = e.select("vec_id", "batch", ((F.col("k") * 7) % 13).alias("patch"), F.col("a").alias("f"))
    patches = e.select("batch", F.col("k").alias("patch"), F.col("p").alias("f"))
    return geometry.gathered_info_nce(points, patches, "batch", "vec_id", "patch", "f", F.col("vec_id") % 5 != 0).withColumn("loss", F.round("loss", 4))


def _indexed_sql(name: str, feature: str, step: int) -> str:
    return f"""{name}l as (select x.batch, x.vec_id as i, y.k, list_cosine_similarity(x.a, y.{feature}) / 0.07::double as l, y.k = (x.vec_id * {step}) % 32 as own from e x join e y on y.batch = x.batch where x.vec_id % 4 = 0),
        {name} as (select batch, count(*) as n, avg(c) as loss from (select batch, i, ln(sum(exp(l))) - max(l) filter (own) as c from {name}l group by 1, 2) where c is not null group by 1)"""


@query(f"with {VECTORS}, {_indexed_sql('t', 'p', 3)}, {_indexed_sql('g', 'q', 5)} select t.batch, t.n::bigint as n, round((t.loss + g.loss) / 2, 4) as loss from t join g using (batch)")
def tactile_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean loss of tactile features against points and image patches of given numbers."""
    e = _vectors(spark, sf_dir)
    anchors = e.filter("vec_id % 4 = 0").select("vec_id", "batch", F.col("a").alias("f"), ((F.col("vec_id") * 3) % 32).alias("point"), ((F.col("vec_id") * 5) % 32).alias("patch"))
    of_kind = lambda c: e.select("batch", "k", F.col(c).alias("f"))
    return geometry.tactile_info_nce(anchors, of_kind("p"), of_kind("q"), "batch", "vec_id", "f", "k").withColumn("loss", F.round("loss", 4))


@query("""with c as (select event_type as key, count(*)::bigint as n, count(distinct user_id)::bigint as s, max(event_id)::bigint as m from events group by 1),
    l as (select 0 as part, 0::bigint as spot, '' as key, 0::bigint as k, '# Audit' as line union all select 1, 0, '', 0, '- Sessions: ' || count(distinct user_id) from events union all select 1, 1, '', 0, '- Rows: ' || count(*) from events
          union all select 2, 0, 'By kind', 0, '## By kind' union all select 2, 0, 'By kind', row_number() over (order by n desc, key), '- ' || key || ': ' || n from c
          union all select 3, 0, '', 0, '## Modality summary' union all select 3, 0, '', 1, '| modality | sessions | total | last |' union all select 3, 0, '', 2, '|---|---:|---:|---:|'
          union all select 3, 1, key, 0, '| ' || key || ' | ' || s || ' | ' || n || ' | ' || m || ' |' from c
          union all select 4, event_id + 1, '', 0, '- [warn] ' || user_id || ' ' || event_type || ' low_value: ' || event_id from events where event_id < 25)
    select (row_number() over (order by part, spot, key, k) - 1)::int as place, line from l""")
def audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit's summary as Markdown lines."""
    e = table(spark, sf_dir, "events")
    sums = e.agg(F.countDistinct("user_id").alias("s"), F.count("*").alias("n"))
    facts = sums.select(F.lit(0).alias("place"), F.lit("Sessions").alias("name"), F.col("s").alias("value")).union(sums.select(F.lit(1), F.lit("Rows"), F.col("n")))
    kinds = e.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("s"), F.max("event_id").alias("m"))
    counters = kinds.select(F.lit("By kind").alias("section"), F.col("event_type").alias("key"), "n")
    samples = e.filter("event_id < 25").select(F.col("event_id").alias("place"), F.lit("warn").alias("severity"), F.col("user_id").alias("session"), F.col("event_type").alias("modality"), F.lit("low_value").alias("code"), F.col("event_id").alias("found"))
    return tables.summary_lines("Audit", facts, counters, kinds.select(F.col("event_type").alias("modality"), F.col("s").alias("sessions"), F.col("n").alias("total"), F.col("m").alias("last")), samples)


@query(f"""with {EV}, s as (select distinct session, lpad((row_index % 40)::varchar, 4, '0') as frame from ev where modality = 'click'), f as (select session, lpad((row_index % 50)::varchar, 4, '0') as frame, code % 9 as n, value from ev where modality = 'view')
    select session, frame, count(*)::bigint as n, round(sum(n * value), 4) as total from f semi join s using (session, frame) where n >= 6 group by 1, 2""")
def frame_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arm states as JSON texts, those with a whole pose and an image."""
    e = events(spark, sf_dir)
    pose = F.when(F.col("code") % 9 > 0, F.array_repeat("value", (F.col("code") % 9).cast("int"))).otherwise(F.array().cast("array<double>"))
    state = F.struct(F.lit(0).alias("code"), F.struct(F.array("value").alias("joint"), pose.alias("pose")).alias("data"))
    name = lambda n: F.lpad((F.col("row_index") % n).cast("string"), 4, "0")
    texts = of(e, "view").select("session", F.to_json(F.struct(name(50).alias("frame"), state.alias("state"))).alias("text"))
    found = recordings.frame_states(texts, of(e, "click").select("session", name(40).alias("stem")))
    return found.groupBy("session", "frame").agg(F.count("*").alias("n"), F.round(F.sum(F.aggregate("pose", F.lit(0.0), lambda a, x: a + x)), 4).alias("total"))


@query("""with w as (select event_type, epoch_us(ts) // 86400000000 - k as day from events, (values (0), (1)) as v(k)) select (day * 86400000000)::bigint as start_us, event_type, count(*)::bigint as count, round(count(*) / 172800::double, 9) as hz from w group by 1, 2""")
def stream_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a second in windows of two days that begin each day."""
    like = spark.read.parquet(f"{sf_dir}/events.parquet")
    timed = streaming.with_event_time(streaming.read_folder(spark, like, f"{sf_dir}/event[s].parquet"))
    return streaming.run_to_table(streaming.sliding_rate(timed, "2 days", "1 day", "event_type"), shared_folder(spark)).withColumn("hz", F.round("hz", 9))


@query("""with n as (select event_id, case event_id % 4 when 0 then 'CH' || (event_id % 64) when 1 then event_type || '_offset_ms' when 2 then 'CH' || event_type else 'ep00' || (event_id % 10) || '_env' || (user_id % 7) || '_step' || event_id || '.jpg' end as name from events)
    select event_id, event_id % 4 = 0 as channel, event_id % 4 = 1 as offset_column, case when event_id % 4 = 3 then event_id % 10 end::int as ep, case when event_id % 4 = 3 then (select user_id % 7 from events e where e.event_id = n.event_id) end::int as env, case when event_id % 4 = 3 then event_id end::int as step from n""")
def column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the names of columns and image files say."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    image = F.concat(F.lit("ep00"), k % 10, F.lit("_env"), F.col("user_id") % 7, F.lit("_step"), k, F.lit(".jpg"))
    name = F.when(k % 4 == 0, F.concat(F.lit("CH"), k % 64)).when(k % 4 == 1, F.concat("event_type", F.lit("_offset_ms"))).when(k % 4 == 2, F.concat(F.lit("CH"), "event_type")).otherwise(image)
    rows = e.select("event_id", name.alias("name"))
    return rows.select("event_id", parse.is_channel(F.col("name")).alias("channel"), parse.is_offset(F.col("name")).alias("offset_column"), *recordings.episode_of(F.col("name")))
