"""Manifests, whole-file cleaning, annotation checks, poses, simulated episodes and small parsers over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlake.functions import parse
from sessionlake.operators import episodes, manifest, pose, pressure, rules, simulation
from sessionlake.plans.registry import EV, events, of, query, r6, table
from sessionlake.plans.sessions import NAMES, _names, _stream
from sessionlake.session import shared_folder
from sessionlake.streaming import operators as streaming

#: Line items as pressure files of suppliers: days as clock (lost in some rows of every tenth file), a bad channel and its neighbours.
P = """p as (select l_suppkey as session, ((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 100 + l_quantity::bigint as arrival, case when l_suppkey % 10 = 0 and l_orderkey % 97 = 0 then null else date_diff('day', date '1970-01-01', l_shipdate::date)::bigint end as t,
    l_quantity as "CH57", case when l_returnflag = 'R' and l_linenumber = 2 then null else l_linenumber::double end as "CH59", (l_orderkey % 30)::double as "CH58" from lineitem)"""
CLEAN = f"""{P}, q as (select *, t < lag(t) over b and count(*) filter (t is null) over (partition by session order by arrival rows between unbounded preceding and current row) = 0 as reversal, row_number() over b as came,
    bool_and(t is not null) over (partition by session) as whole from p window b as (partition by session order by arrival)),
    s as (select *, row_number() over (partition by session order by case when whole then t else 0 end, arrival) as pos, "CH57" is not null and "CH59" is not null as there, trunc(("CH57" + "CH59") / 2.0) as mean from q),
    c as (select s.*, s.t is distinct from o.t as moved, coalesce(s.mean, s."CH58") as fixed, s.there and s.mean is distinct from s."CH58" as changed_cell from s join s o on o.session = s.session and o.came = s.pos),
    d as (select session, count(*) as rows, count(*) filter (reversal) as timestamp_reversals, count(*) filter (moved) as rows_reordered, count(*) filter (there) as rows_replaced, count(*) filter (changed_cell) as rows_changed,
        count(*) filter (not there) as rows_failed, count(*) filter (moved) > 0 or count(*) filter (changed_cell) > 0 as changed from c group by session)"""


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    t = F.when(~((F.col("l_suppkey") % 10 == 0) & (F.col("l_orderkey") % 97 == 0)), F.unix_date(F.col("l_shipdate").cast("date")).cast("long"))
    near = F.when(~((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 2)), F.col("l_linenumber").cast("double"))
    rows = li.select(F.col("l_suppkey").alias("session"), (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")) * 100 + F.col("l_quantity").cast("long")).alias("arrival"), t.alias("t"), F.col("l_quantity").alias("CH57"), near.alias("CH59"), (F.col("l_orderkey") % 30).cast("double").alias("CH58"))
    return pressure.clean_files(rows, "session", {"CH58": ["CH57", "CH59"]})


@query(f"""with {P}, q as (select *, bool_and(t is not null) over (partition by session) as whole from p)
    select session, arrival, (row_number() over (partition by session order by case when whole then t else 0 end, arrival))::int as pos, coalesce(trunc(("CH57" + "CH59") / 2.0), "CH58") as "CH58" from q""")
def pressure_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sort, repair and order of whole files in one operation."""
    return _cleaned(spark, sf_dir).select("session", "arrival", "pos", "CH58")


@query(f"with {CLEAN} select * from d")
def pressure_clean_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pressure.clean_details(_cleaned(spark, sf_dir), "session", ["CH58"])


@query(f"""with {CLEAN}, {EV}, g as (select session, count(*) - count(distinct t) as duplicates, count(*) filter (code % 9 = 0) as filled from ev where modality = 'signup' group by session),
    a as (select o_orderkey % 5 as rows, o_orderkey % 5 > 0 as written, o_orderkey % 5 > 0 and o_orderkey % 2 = 0 as created from orders)
    select * from (select count(*) as pressure_files_seen, count(*) filter (changed) as pressure_files_changed, count(*) filter (rows_reordered > 0) as pressure_files_sorted, sum(rows_reordered)::bigint as pressure_rows_reordered,
        count(*) filter (rows_changed > 0) as pressure_ch58_files_changed, sum(rows_replaced)::bigint as pressure_ch58_rows_replaced, sum(rows_changed)::bigint as pressure_ch58_rows_changed, sum(rows_failed)::bigint as pressure_ch58_rows_failed from d),
    (select count(*) as gripper_files_seen, count(*) filter (duplicates > 0 or filled > 0) as gripper_files_changed, sum(duplicates)::bigint as gripper_duplicate_rows_removed, sum(filled)::bigint as gripper_sys_state_filled from g),
    (select count(*) as aligned_files_seen, count(*) filter (written) as aligned_files_written, count(*) filter (created) as aligned_files_created, sum(case when written then rows else 0 end)::bigint as aligned_rows_written from a)""")
def cleaning_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of a cleaning over all its files."""
    g = of(events(spark, sf_dir), "signup").groupBy("session").agg((F.count("*") - F.count_distinct("t")).alias("duplicates"), F.count_if(F.col("code") % 9 == 0).alias("filled"))
    n = F.col("o_orderkey") % 5
    a = table(spark, sf_dir, "orders").select(n.alias("rows"), (n > 0).alias("written"), ((n > 0) & (F.col("o_orderkey") % 2 == 0)).alias("created"))
    return pressure.cleaning_counters(pressure.clean_details(_cleaned(spark, sf_dir), "session", ["CH58"]), g, a)


#: Orders as recorded sessions with counts.
S = f"""{NAMES}, k as (select o.name as session, '/data/' || o.name as rel_path, regexp_extract(o.name, 'session_(\\d{{8}})_(\\d{{6}})', 1) as date, regexp_extract(o.name, 'session_(\\d{{8}})_(\\d{{6}})', 2) as time,
        case when dual then 'dual_realsense' when world and wrist then 'legacy_dji_realsense' when wrist then 'legacy_dji_realsense_rgb_only' else 'unknown' end as data_format, x.o_custkey % 10 = 0 as first_view,
        x.o_orderkey % 7 as visual_complete_frames, x.o_orderkey % 7 + (case when x.o_orderkey % 5 = 0 then 1 else 0 end) as frames_rows, x.o_orderkey % 3 as aligned_rows, x.o_orderkey % 11 as pressure_rows,
        (case x.o_orderkey % 4 when 2 then 0 when 3 then 64 else 20 end)::bigint as pressure_channel_count, x.o_totalprice as pressure_hz, x.o_orderkey % 4 as robot_rows, x.o_totalprice / 2 as robot_hz, x.o_orderkey % 6 as gripper_rows, x.o_totalprice / 4 as gripper_hz
        from o join orders x using (o_orderkey)),
    f as (select *, case when date < '19990615' or data_format in ('legacy_dji_realsense', 'legacy_dji_realsense_rgb_only') then 'pre_0615_dji_world' else 'post_0615_dual_realsense' end as phase from k),
    v as (select *, case when first_view then '0615_initial_realsense_position_incomplete_arm_view' when phase = 'pre_0615_dji_world' then 'legacy_dji_world_position' else 'realsense_repositioned_after_begin_end' end as view_tag from f),
    m as (select *, case when data_format = 'legacy_dji_realsense_rgb_only' then data_format when data_format = 'legacy_dji_realsense' then 'legacy_dji_realsense_rgbd' when first_view then 'dual_realsense_initial_position_begin_end'
        when data_format = 'dual_realsense' then 'dual_realsense_repositioned' else 'unknown' end as split from v)"""


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, key = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), F.col("o_orderkey")
    rows = _names(spark, sf_dir).join(x, "o_orderkey")
    counts = {"visual_complete_frames": key % 7, "frames_rows": key % 7 + F.when(key % 5 == 0, 1).otherwise(0), "aligned_rows": key % 3, "pressure_rows": key % 11, "robot_rows": key % 4, "gripper_rows": key % 6}
    channels = F.when(key % 4 == 2, 0).when(key % 4 == 3, 64).otherwise(20).cast("long")
    rates = {k: F.col("o_totalprice") / d for k, d in (("pressure_hz", 1), ("robot_hz", 2), ("gripper_hz", 4))}
    return rows.select(F.col("name").alias("session"), manifest.relative(F.concat(F.lit("/lake//data/"), F.col("name")), "/lake").alias("rel_path"), parse.data_format(F.col("dual"), F.col("world"), F.col("wrist")).alias("data_format"),
        (F.col("o_custkey") % 10 == 0).alias("first_view"), *(v.alias(k) for k, v in counts.items()), channels.alias("pressure_channel_count"), *(v.alias(k) for k, v in rates.items()))


@query(f"""with {S} select session, rel_path, date, time, split, phase, view_tag, data_format, (visual_complete_frames > 0 and data_format <> 'unknown')::int as usable_for_rgb,
    (visual_complete_frames > 0 and data_format in ('legacy_dji_realsense', 'dual_realsense'))::int as usable_for_rgbd, (data_format = 'dual_realsense' and aligned_rows > 0 and pressure_channel_count = 20 and robot_rows > 0 and gripper_rows > 0)::int as usable_for_aligned_training,
    visual_complete_frames, frames_rows, aligned_rows, pressure_rows, pressure_channel_count, pressure_hz, robot_rows, robot_hz, gripper_rows, gripper_hz,
    concat_ws(';', case when data_format = 'legacy_dji_realsense_rgb_only' then 'rgb_only_no_depth' end, case when first_view then 'incomplete_arm_view' end, case when data_format = 'dual_realsense' and aligned_rows = 0 then 'missing_aligned_timesteps' end,
        case when data_format = 'dual_realsense' and frames_rows <> visual_complete_frames then 'frames_vs_visual_count_mismatch' end, case when pressure_channel_count not in (20, 0) then 'pressure_channels_' || pressure_channel_count end) as notes from m""")
def clean_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the clean manifest, classification and usability included."""
    return manifest.manifest(_sessions(spark, sf_dir), F.col("first_view"), "19990615")


@query(f"""with {S} select session, view_tag, case when data_format like 'legacy%' then 'DJI world RGB' when data_format = 'dual_realsense' then 'RealSense world RGB-D' else 'unknown' end as world_camera,
    case when data_format = 'legacy_dji_realsense_rgb_only' then 'RealSense wrist RGB' when data_format = 'unknown' then 'unknown' else 'RealSense wrist RGB-D' end as wrist_camera from m""")
def session_cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sessions(spark, sf_dir).withColumn("date", parse.session_date(F.col("session")))
    return manifest.classified(rows, F.col("first_view"), "19990615").select("session", "view_tag", manifest.cameras(F.col("data_format")).alias("c")).select("session", "view_tag", "c.*")


#: Customers as sheets' sessions: split by segment, ordered by name; every sheet is a run of up to seven.
SHEETS = """n as (select c_mktsegment as split, c_name as session, row_number() over (partition by c_mktsegment order by c_name) as k from customer),
    h as (select split, split || '_' || lpad(((k - 1) // 7)::varchar, 3, '0') as sheet_id, min(session) as start_session, max(session) as end_session, count(*) + (case when (k - 1) // 7 % 5 = 4 then 1 else 0 end) as session_count from n group by split, (k - 1) // 7),
    pl as (select h.sheet_id, (n.k - s.k + 1)::int as row, n.session, h.session_count = least(h.session_count, count(*) over (partition by h.sheet_id)) and max(case when n.k - s.k + 1 = h.session_count then n.session end) over (partition by h.sheet_id) = h.end_session as ok
        from h join n s on s.split = h.split and s.session = h.start_session join n on n.split = h.split and n.k between s.k and s.k + h.session_count - 1)"""


def _places(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("split"), F.col("c_name").alias("session"), F.lit("").alias("date"), F.lit("").alias("time"))
    sheets = episodes.pages(c, "split", "session", 7)
    sheets = sheets.select("split", F.col("first").alias("start_session"), F.col("last").alias("end_session"), (F.col("n") + F.when(F.col("sheet") % 5 == 4, 1).otherwise(0)).alias("session_count"), F.lpad(F.col("sheet").cast("string"), 3, "0").alias("number"))
    sheets = sheets.withColumn("sheet_id", manifest.sheet_name(F.col("split"), F.concat(F.lit("sheet_"), F.col("number")))).drop("number")
    return c, manifest.sheet_sessions(c, sheets)


@query(f"with {SHEETS} select sheet_id, row, session, coalesce(ok, false) as ok from pl")
def sheet_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sessions a sheet shows, and whether it ends where it says."""
    return _places(spark, sf_dir)[1]


@query(f"""with {SHEETS}, a as (select distinct sheet_id, case when row % 6 = 5 then 'T9' else 'T1' end as task_id, case when row % 4 = 0 then 1 else row end as row_start, row + (case when row = 7 then 3 else 0 end) as row_end from pl
        union all select split || '_999', 'T1', 1, 2 from (select distinct split from n)), z as (select sheet_id, max(row) as size from pl group by 1),
    j as (select a.*, case when size is null then 'unknown_sheet' when task_id <> 'T1' then 'unknown_task' when row_start < 1 or row_end > size or row_start > row_end then 'invalid_range' end as problem from a left join z using (sheet_id)),
    g as (select session, count(*) as n from j join pl on pl.sheet_id = j.sheet_id and pl.row between j.row_start and j.row_end where problem is null group by 1)
    select problem, sheet_id as item, count(*) as n from j where problem is not null group by 1, 2 union all select 'duplicate_session', session, n from g where n > 1
    union all select 'missing_session', session, 0 from n where session not in (select session from g)""")
def annotation_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown sheets and tasks, ranges out of their sheet, sessions named twice or never."""
    c, places = _places(spark, sf_dir)
    row = F.col("row")
    notes = places.select("sheet_id", F.when(row % 6 == 5, "T9").otherwise("T1").alias("task_id"), F.when(row % 4 == 0, 1).otherwise(row).alias("row_start"), (row + F.when(row == 7, 3).otherwise(0)).alias("row_end")).distinct()
    odd = c.select("split").distinct().select(manifest.sheet_name(F.col("split"), F.lit(" 999 ")).alias("sheet_id"), F.lit("T1").alias("task_id"), F.lit(1).alias("row_start"), F.lit(2).alias("row_end"))
    return manifest.annotation_problems(notes.union(odd), places, c, ["T1"])


@query("""with s as (select o_orderkey as session, 'pressure' as modality, o_orderkey % 13 = 0 as undecodable, o_orderkey % 7 = 0 as unparsable, (case when o_orderkey % 3 = 0 then 20 else 64 end)::bigint as channels from orders),
    j as (select o_orderkey as session, o_orderkey % 17 as over, o_orderkey % 5 as images, o_orderkey % 9 = 0 as bad_json, (o_orderkey % 40)::double as hz from orders)
    select session, 'csv_decode_error' as code, 'error' as severity, 0::bigint as found from s where undecodable union all select session, 'csv_parse_error', 'error', 0 from s where unparsable and not undecodable
    union all select session, 'nonstandard_pressure_schema', 'warn', channels from s where channels <> 20 union all select session, 'large_sync_offset', 'warn', over from j where over > 0
    union all select session, 'empty_image_dir', 'error', 0 from j where images = 0 union all select session, 'low_frequency', 'warn', images from j where hz < 20.0 union all select session, 'json_parse_error', 'error', 0 from j where bad_json""")
def file_issue_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of unreadable files, odd channel sets, large offsets, empty image folders, slow cameras and bad JSON."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    base, no = k.alias("session"), F.lit(0)
    csv = o.select(base, F.lit("pressure").alias("modality"), (k % 13 == 0).alias("undecodable"), (k % 7 == 0).alias("unparsable"), F.when(k % 3 == 0, 20).otherwise(64).alias("channels"), no.alias("missing_channels"), no.alias("extra_channels"))
    aligned = o.select(base, F.lit("aligned_timesteps").alias("modality"), (k % 17).alias("rows_over_offset"))
    images = o.select(base, F.lit(True).alias("present"), (k % 5).alias("images"), (k % 40).cast("double").alias("hz_mean"), F.lit(rules.RATES["visual"][0]).alias("min_hz"))
    js = o.select(base, (k % 9 == 0).alias("unparsable"))
    found = [(csv, rules.STREAM_RULES), (aligned, rules.STREAM_RULES), (images, rules.IMAGE_RULES), (js, rules.JSON_RULES)]
    out = [rules.issues(x, r, ["session"]) for x, r in found]
    return out[0].union(out[1]).union(out[2]).union(out[3])


POSE = """e as (select s_suppkey, radians((s_suppkey % 360)::double) as r, radians((s_suppkey * 7 % 170 - 85)::double) as p, radians((s_suppkey * 13 % 360)::double) as y, s_acctbal / 1000 as t0, s_nationkey::double as t1, (s_suppkey % 9)::double as t2 from supplier),
    m as (select *, cos(y) * cos(p) as r0, cos(y) * sin(p) * sin(r) - sin(y) * cos(r) as r1, cos(y) * sin(p) * cos(r) + sin(y) * sin(r) as r2, sin(y) * cos(p) as r3, sin(y) * sin(p) * sin(r) + cos(y) * cos(r) as r4,
        sin(y) * sin(p) * cos(r) - cos(y) * sin(r) as r5, -sin(p) as r6, cos(p) * sin(r) as r7, cos(p) * cos(r) as r8 from e)"""


def _poses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list, list]:
    k = F.col("s_suppkey")
    turn = pose.from_rpy_deg((k % 360).cast("double"), (k * 7 % 170 - 85).cast("double"), (k * 13 % 360).cast("double"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", *pose.named(turn, "r"), (F.col("s_acctbal") / 1000).alias("t0"), F.col("s_nationkey").cast("double").alias("t1"), (k % 9).cast("double").alias("t2"))
    return rows, [F.col(f"r{i}") for i in range(9)], [F.col(f"t{i}") for i in range(3)]


@query(f"""with {POSE} select s_suppkey, {", ".join(f"round(r{i}, 6) as r{i}" for i in range(9))}, {", ".join(f"round(-(r{i} * t0 + r{3 + i} * t1 + r{6 + i} * t2), 6) as i{i}" for i in range(3))},
    {", ".join(f"round(2 * (r{3 * i} * t0 + r{3 * i + 1} * t1 + r{3 * i + 2} * t2) + t{i}, 6) as c{i}" for i in range(3))} from m""")
def pose_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotations from roll, pitch and yaw; translations of the inverse and of the pose after a pure one of twice its own."""
    rows, r, t = _poses(spark, sf_dir)
    back = pose.inverted((r, t))
    one = [F.lit(float(k % 4 == 0)) for k in range(9)]
    both = pose.composed((r, t), (one, [x * 2 for x in t]))
    names = [*(f"r{i}" for i in range(9)), *(f"i{i}" for i in range(3)), *(f"c{i}" for i in range(3))]
    return r6(rows.select("s_suppkey", *r, *pose.named(back[1], "i"), *pose.named(both[1], "c")), *names)


@query(f"with {POSE} select s_suppkey, {', '.join(f'round(r{i}, 6) as r{i}' for i in range(9))}, true as unit, true as positive from m")
def pose_quaternions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotation to quaternion and back gives the rotation; the quaternion has norm 1 and w isn't negative."""
    rows, r, _ = _poses(spark, sf_dir)
    q = rows.select("s_suppkey", *pose.named(pose.to_quaternion(r), "q"))
    q4 = [F.col(f"q{i}") for i in range(4)]
    norm = q4[0] ** 2 + q4[1] ** 2 + q4[2] ** 2 + q4[3] ** 2
    back = q.select("s_suppkey", *pose.named(pose.from_quaternion(*q4), "r"), (F.abs(norm - 1) < 1e-9).alias("unit"), (q4[0] >= 0).alias("positive"))
    return r6(back, *(f"r{i}" for i in range(9)))


@query(f"""with {POSE}, g as (select m.*, s_nationkey from m join supplier using (s_suppkey)), f as (select s_nationkey, {", ".join(f"arg_min({c}, s_suppkey) as f{c}" for c in [*(f"r{i}" for i in range(9)), "t0", "t1", "t2"])} from g group by 1),
    d as (select s_nationkey, degrees(acos(least(1.0, greatest(-1.0, ({" + ".join(f"r{i} * fr{i}" for i in range(9))} - 1) / 2)))) as deg, sqrt((t0 - ft0) ** 2 + (t1 - ft1) ** 2 + (t2 - ft2) ** 2) * 1000 as mm from g join f using (s_nationkey))
    select s_nationkey, count(*) as frames, round(avg(deg), 4) as mean_deg, round(avg(mm), 4) as mean_mm, case when avg(deg) < 2 and avg(mm) < 10 then 'good' when avg(deg) < 5 and avg(mm) < 30 then 'usable' else 'retake' end as verdict from d group by 1""")
def calibration_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pose.consistency(_poses(spark, sf_dir)[0], "s_nationkey", "s_suppkey")
    return found.withColumns({c: F.round(c, 4) for c in ("mean_deg", "mean_mm")})


@query("""with k as (select p_partkey, p_size * 0.5 as focal, p_brand from part) select p_partkey, round(focal / 20.955 * 640, 6) as fx, round(focal / 15.716 * 480, 6) as fy, 320.0::double as cx, 240.0::double as cy,
    (p_partkey % 500)::double * (p_partkey % 400) / 307200.0::double as coverage, case when p_brand in ('Brand#11', 'Brand#12') then p_brand else 'Brand#13' end as camera from k""")
def camera_intrinsics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pinhole parameters, the share of the image that corners cover, and a camera registry with a default."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", pose.intrinsics(F.col("p_size") * 0.5, F.lit(20.955), F.lit(15.716), F.lit(640), F.lit(480)).alias("i"), pose.corner_coverage(F.lit(0), F.lit(0), (k % 500).cast("double"), k % 400, 640.0, 480.0).alias("coverage"))
    registry = spark.createDataFrame([(f"Brand#1{i}", f"Brand#1{i}") for i in (1, 2, 3)], "camera string, label string")
    out = pose.camera_or_default(rows, "p_brand", registry, "Brand#13").select("p_partkey", "i.*", "coverage", F.col("label").alias("camera"))
    return r6(out, "fx", "fy")


@query("""with l as (select l_suppkey, max(((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 100 + l_quantity::bigint) as last, avg((l_returnflag = 'R')::int) * 100 as success_rate from lineitem group by 1),
    x as (select l.l_suppkey, success_rate, l_quantity as distance, l_discount / 4 as x, l_tax / 4 as y, l_discount * 4 as z from l join lineitem i on i.l_suppkey = l.l_suppkey and ((i.l_orderkey * 8 + i.l_linenumber) * 1000000 + i.l_partkey) * 100 + i.l_quantity::bigint = l.last)
    select l_suppkey, round(success_rate, 6) as success_rate, distance as final_distance, round(sqrt(x * x + y * y), 6) as final_xy, round(z, 6) as final_z, sqrt(x * x + y * y) < 0.02 and z between 0.23 and 0.28 as final_success from x""")
def final_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival of the last row of each environment."""
    li, zero = table(spark, sf_dir, "lineitem"), F.lit(0.0)
    rows = li.select("l_suppkey", (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")) * 100 + F.col("l_quantity").cast("long")).alias("n"), (F.col("l_returnflag") == "R").alias("success"), F.col("l_quantity").alias("distance"), (F.col("l_discount") / 4).alias("x"), (F.col("l_tax") / 4).alias("y"), (F.col("l_discount") * 4).alias("z"), zero.alias("tx"), zero.alias("ty"), zero.alias("tz"))
    return r6(simulation.final_success(rows, ["l_suppkey"], "n"), "success_rate", "final_xy", "final_z")


@query("""select l_suppkey, count(*) as samples, max(l_quantity) as peak_a, max(l_discount) as peak_b, max(l_tax) as peak_c, round(max(sqrt(l_quantity ** 2 + l_discount ** 2 + l_tax ** 2)), 6) as peak_norm,
    max((l_quantity > 0)::int + (l_discount > 0)::int + (l_tax > 0)::int)::int as most_contacts from lineitem group by 1""")
def force_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").alias("a"), F.col("l_discount").alias("b"), F.col("l_tax").alias("c"))
    return r6(simulation.force_summary(rows, "l_suppkey", ["a", "b", "c"]), "peak_norm")


@query("select vec_id, len(list_filter(embedding, lambda x: x > 0))::int as pixels, round(len(list_filter(embedding, lambda x: x > 0)) * 100.0 / len(embedding), 6)::double as percent from embeddings where embedding is not null and len(embedding) > 0")
def mask_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(F.size("embedding") > 0).select("vec_id", simulation.mask_coverage(F.col("embedding")).alias("m")).select("vec_id", "m.*")
    return rows.withColumn("percent", F.round(F.col("percent").cast("double"), 6))


@query("""with f as (select 'ep_' || l_orderkey || '_env' || (l_suppkey % 7) || '_' || l_linenumber || '.png' as path from lineitem union all select 'notes.txt')
    select try_cast(nullif(regexp_extract(path, '_env([0-9]+)_', 1), '') as int) as env, count(*) as files from f group by 1""")
def files_by_environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    paths = li.select(F.concat(F.lit("ep_"), F.col("l_orderkey"), F.lit("_env"), F.col("l_suppkey") % 7, F.lit("_"), F.col("l_linenumber"), F.lit(".png")).alias("path")).union(spark.createDataFrame([("notes.txt",)], "path string"))
    return simulation.files_by_environment(paths, "path", "_env([0-9]+)_")


@query("""with f as (select l_orderkey as o, l_linenumber as n, min('m_' || l_partkey || '.png') as path from lineitem where l_returnflag = 'N' group by 1, 2)
    select l_orderkey, l_linenumber, path from lineitem left join f on f.o = l_orderkey and f.n = l_linenumber""")
def sidecar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    files = li.filter("l_returnflag = 'N'").select("l_orderkey", "l_linenumber", F.concat(F.lit("m_"), F.col("l_partkey"), F.lit(".png")).alias("path"))
    return simulation.with_sidecar(li.select("l_orderkey", "l_linenumber"), files, ["l_orderkey", "l_linenumber"])


@query("""select c.c_custkey, c.c_custkey % 30 as wanted, l.last_line, coalesce(m.made, 0) as made, round(least(100.0, coalesce(coalesce(m.made, 0) * 100.0 / nullif(c.c_custkey % 30, 0), 0.0)), 6)::double as percent from customer c
    left join (select o_custkey, arg_max(o_orderpriority, o_orderkey) as last_line from orders group by 1) l on l.o_custkey = c.c_custkey left join (select o_custkey, count(*) as made from orders where o_orderstatus <> 'P' group by 1) m on m.o_custkey = c.c_custkey""")
def collection_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with the last line of their log and the share done; those without either stay."""
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    runs = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 30).alias("wanted"))
    logs = o.select("c_custkey", F.col("o_orderkey").alias("line_no"), F.col("o_orderpriority").alias("line"))
    out = simulation.progress(runs, logs, o.filter("o_orderstatus <> 'P'"), "c_custkey")
    return out.withColumn("percent", F.round(F.col("percent").cast("double"), 6))


@query("with s as (select distinct l_orderkey from lineitem where l_returnflag = 'R') select o_orderkey, o_orderstatus from orders where o_orderkey in (select l_orderkey from s)")
def stem_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.concat(F.lit("rgb/v1.0/"), F.col("l_orderkey"), F.lit(".jpg")).alias("path"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderkey").cast("string").alias("stem"))
    return episodes.semi_on_stem(rows, files, "path", "stem").drop("stem")


@query("""with f as (select c_nationkey, c_custkey, case when c_custkey % 5 = 0 then 'cover' || c_custkey else ((c_custkey * 37) % 1000)::varchar end || '.png' as name from customer)
    select c_nationkey, c_custkey, row_number() over (partition by c_nationkey order by coalesce(try_cast(regexp_extract(name, '^([^.]*)', 1) as bigint), 1000000000000), name, c_custkey)::int as place from f""")
def image_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered images by number, others after them by name."""
    k = F.col("c_custkey")
    name = F.concat(F.when(k % 5 == 0, F.concat(F.lit("cover"), k)).otherwise((k * 37 % 1000).cast("string")), F.lit(".png"))
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", name.alias("name"))
    return rows.select("c_nationkey", "c_custkey", F.row_number().over(Window.partitionBy("c_nationkey").orderBy(*episodes.image_order(F.col("name")), "c_custkey")).alias("place"))


@query(f"with {NAMES} select name, o_orderkey from o order by name desc, o_orderkey desc limit 25")
def newest_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's newest sessions: a limit is what it is."""
    return episodes.newest(_names(spark, sf_dir).select("name", "o_orderkey"), "name", 25, "o_orderkey")


@query("select o_orderpriority, o_orderkey from (select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as n from orders) where n <= 20")
def report_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of each kind of issue, as reports show them."""
    return episodes.first_of_each(table(spark, sf_dir, "orders"), ["o_orderpriority"], [F.desc("o_totalprice"), "o_orderkey"], 20).select("o_orderpriority", "o_orderkey")


@query("select o_custkey, array_to_string(list_sort(list_distinct(list(o_orderstatus))), ',') as statuses, array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') as priorities from orders group by 1")
def present_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = episodes.present_lists(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"])
    return found.select("o_custkey", F.array_join("o_orderstatus", ",").alias("statuses"), F.array_join("o_orderpriority", ",").alias("priorities"))


@query(f"with {EV}, r as (select session, t, row_index * 1000 as host, row_number() over (partition by session order by row_index) as n from ev) select session, median(host - t)::double as \"offset\" from r where n <= 100 group by 1")
def clock_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("host", F.col("row_index") * 1000)
    return episodes.clock_offset(rows, "session", "row_index", "host", "t").withColumn("offset", F.col("offset").cast("double"))


@query(f"with {EV}, x as (select session, arrival, case when row_index % 6 = 0 then 'bad' else (t // 3600000000)::varchar end as cell from ev), d as (select distinct session, try_cast(cell as bigint) as t from x) select session, t, row_number() over (partition by session order by t)::int as pos from d where t is not null")
def sorted_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.when(F.col("row_index") % 6 == 0, "bad").otherwise(F.expr("cast(t div 3600000000 as string)"))
    return episodes.sorted_series(events(spark, sf_dir).withColumn("cell", cell), "session", "cell")


@query(f"""with {EV} select row_index, coalesce(case code % 4 when 0 then value when 1 then value * 2 end, 0.0) as channel, rtrim(rtrim(printf('%.6f', value), '0'), '.') as shown, code % 3 = 0 as good_read,
    code % 5 > 0 as has_arm, case when code % 7 < 5 then null else row_index::double end as x from ev""")
def cell_parsers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels by number with a default, fixed decimals, good reads, joints or zeros, and cells by place in rows that may be short."""
    e, code = events(spark, sf_dir), F.col("code")
    channels = F.create_map(F.lit(0), F.col("value"), F.lit(1), F.col("value") * 2)
    joints = F.when(code % 5 > 0, F.array(*[F.lit(1.0)] * 6))
    cells = F.slice(F.array(F.col("row_index").cast("string"), *[F.lit("1")] * 6), F.lit(1), (code % 7 + 1).cast("int"))
    return e.select("row_index", parse.channel_or_zero(channels, (code % 4).cast("int")).alias("channel"), parse.fixed_text(F.col("value")).alias("shown"), (code % 3 == 0).alias("good_read"),
        (F.element_at(episodes.without_arm(joints), 1) > 0).alias("has_arm"), *parse.positional(cells, {"x": 0}, 6))


@query(f"with {EV} select session, arg_max(modality, row_index) as modality, arg_max(value, row_index) as value from ev group by 1")
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each session as a stream has it."""
    stream = _stream(spark, sf_dir)
    return streaming.run_to_table(streaming.latest_values(stream.withColumnRenamed("user_id", "session").withColumnRenamed("event_type", "modality"), "session", "event_id", ["modality", "value"]), shared_folder(spark))


@query("""select epoch_us(time_bucket(interval '1 day', ts::timestamp, timestamp '1970-01-01')) as start_us, least(count(*) filter (event_type = 'click'), count(*) filter (event_type = 'signup')) as pairs,
    round(least(count(*) filter (event_type = 'click'), count(*) filter (event_type = 'signup')) / 86400.0, 9)::double as hz from events group by 1""")
def stream_pair_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete pairs of two devices a day, 0 where one is silent."""
    stream = _stream(spark, sf_dir)
    found = streaming.run_to_table(streaming.pair_rate(streaming.with_event_time(stream), "1 day", "event_type", "click", "signup"), shared_folder(spark))
    return found.withColumn("hz", F.round("hz", 9))
