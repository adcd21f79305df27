"""Sessions, tensors, episodes, splits, trajectories, geometry, logs and streams over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.functions import parse
from sessionlake.operators import clean, episodes, geometry, manifest, rules, trajectory
from sessionlake.plans.registry import EV, events, of, query, r6, table
from sessionlake.session import shared_folder
from sessionlake.streaming import operators as streaming

NAMES = "o as (select o_orderkey, 'session_' || strftime(o_orderdate, '%Y%m%d') || '_' || lpad((o_orderkey % 240000)::varchar, 6, '0') as name, o_orderpriority = '1-URGENT' as dual, o_orderpriority in ('2-HIGH', '5-LOW') as world, o_orderpriority <> '5-LOW' as wrist from orders)"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("session_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.lpad((F.col("o_orderkey") % 240000).cast("string"), 6, "0"))
    p = F.col("o_orderpriority")
    return o.select("o_orderkey", name.alias("name"), (p == "1-URGENT").alias("dual"), p.isin("2-HIGH", "5-LOW").alias("world"), (p != "5-LOW").alias("wrist"))


@query(f"""with {NAMES}, c as (select *, regexp_extract(name, 'session_(\\d{{8}})_(\\d{{6}})', 1) as date, regexp_extract(name, 'session_(\\d{{8}})_(\\d{{6}})', 2) as time,
        case when dual then 'dual_realsense' when world and wrist then 'legacy_dji_realsense' when wrist then 'legacy_dji_realsense_rgb_only' else 'unknown' end as data_format from o)
    select o_orderkey, date, time, data_format, case when data_format = 'legacy_dji_realsense' or date < '19990615' then 'pre_0615' else 'post_0615' end as audit_phase,
        case when data_format in ('legacy_dji_realsense', 'legacy_dji_realsense_rgb_only') or date < '19990615' then 'pre_0615' else 'post_0615' end as clean_phase from c""")
def classify_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rule sets: the audit names one legacy layout, the cleaner two."""
    rows = _names(spark, sf_dir).select("o_orderkey", parse.session_date(F.col("name")).alias("date"), parse.session_time(F.col("name")).alias("time"), parse.data_format(F.col("dual"), F.col("world"), F.col("wrist")).alias("data_format"))
    kind, date = F.col("data_format"), F.col("date")
    both = ("legacy_dji_realsense", "legacy_dji_realsense_rgb_only")
    return rows.withColumn("audit_phase", parse.phase_of(kind, date, "19990615")).withColumn("clean_phase", parse.phase_of(kind, date, "19990615", both))


@query("""with m as (select c_nationkey, min(c_name) filter (c_custkey % 7 = 1) as b, max(c_name) filter (c_custkey % 7 = 1) as e from customer where c_mktsegment = 'BUILDING' group by 1),
    t as (select distinct c.c_name from customer c join m using (c_nationkey) where c.c_name between m.b and m.e) select c_custkey, c_name in (select c_name from t) as tagged from customer""")
def begin_end_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names between each parent's begin and end marker are tagged wherever they occur."""
    mark = (F.col("c_custkey") % 7 == 1) & (F.col("c_mktsegment") == "BUILDING")
    c = table(spark, sf_dir, "customer")
    return manifest.begin_end(c, "c_nationkey", "c_name", mark).select("c_custkey", "tagged")


@query("""select o_orderkey, o_totalprice > 50000 as visual_ok, o_orderstatus <> 'F' as sensors_ok, o_totalprice > 50000 and o_orderstatus <> 'F' as usable,
    concat_ws(';', case when o_totalprice <= 50000 then 'few_frames' end, case when o_orderstatus = 'F' then 'no_sensors' end) as notes from orders""")
def usability_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    visual, sensors = F.col("o_totalprice") > 50000, F.col("o_orderstatus") != "F"
    notes = F.array_join(F.array_compact(F.array(F.when(~visual, "few_frames"), F.when(~sensors, "no_sensors"))), ";")
    return table(spark, sf_dir, "orders").select("o_orderkey", visual.alias("visual_ok"), sensors.alias("sensors_ok"), (visual & sensors).alias("usable"), notes.alias("notes"))


@query("with r as (select unnest(['http://', 'http://th', 'http://a', 'https://', 'https://e']) as root) select page_id, max_by(root, length(root)) as root from pages join r on starts_with(url, root) group by 1")
def root_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest of a few configured roots that a path begins with."""
    longest = manifest.deepest_root(F.col("url"), ["http://", "http://th", "http://a", "https://", "https://e"])
    return table(spark, sf_dir, "pages").select("page_id", longest.alias("root")).filter("root is not null")


@query(f"""with {EV}, s as (select *, row_number() over (partition by session order by row_index) as n from ev where modality = 'signup'), b as (select *, avg(value) filter (n <= 5) over (partition by session) as baseline from s)
    select session, row_index, round(baseline, 6) as baseline, round(greatest(0, baseline - value), 6) as delta, round(least(1, greatest(0, greatest(0, baseline - value) / 100)), 6) as level from b""")
def baseline_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.baseline_deltas(of(events(spark, sf_dir), "signup"), ["session"], "row_index", 5)
    return r6(rows.select("session", "row_index", "baseline", "delta", clean.normalised(F.col("delta"), 100.0).alias("level")), "baseline", "delta", "level")


WINDOWS_SQL = f"""with {EV}, s as (select session, t, row_number() over w - 1 as n, lead(t, 3) over w as end_t, list(value) over (partition by session order by row_index rows between current row and 3 following) as tensor
    from ev where modality = 'signup' window w as (partition by session order by row_index)), k as (select session, (n // 2)::bigint as window_id, t as start_t, end_t, ((t + end_t) // 2)::bigint as center_t, tensor from s where len(tensor) = 4 and n % 2 = 0)"""


@query(WINDOWS_SQL + " select session, window_id, array_to_string(list_transform(tensor, lambda x: (x * 100)::bigint), ',') as tensor from k")
def sliding_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.windows(of(events(spark, sf_dir), "signup"), ["session"], "row_index", "value", 4, 2)
    return rows.select("session", "window_id", F.array_join(F.transform("tensor", lambda x: F.round(x * 100).cast("long").cast("string")), ",").alias("tensor"))


@query(WINDOWS_SQL + " select session, window_id, start_t, end_t, center_t from k")
def window_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.windows(of(events(spark, sf_dir), "signup"), ["session"], "row_index", "value", 4, 2).drop("tensor")


STEPS_SQL = "s as (select conv_id, turn, role, row_number() over (partition by conv_id order by turn) - 1 as step, count(*) over (partition by conv_id) as n, length(text)::double as x, lead(length(text)) over (partition by conv_id order by turn) as nx from conversations)"


def _steps(spark: SparkSession, sf_dir: str, least: int = 2) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumn("state", F.array(F.length("text").cast("double"), F.col("turn").cast("double")))
    return episodes.steps(rows, "conv_id", "turn", "state", least)


@query(f"with {STEPS_SQL} select conv_id, step::int as step, role, x as state, coalesce(nx - x, 0) as action, step = 0 as is_first, step = n - 1 as is_last from s where n >= 2")
def rlds_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steps(spark, sf_dir).select("conv_id", "step", "role", F.col("state")[0].alias("state"), F.col("action")[0].alias("action"), "is_first", "is_last")


@query(f"with {EV}, l as (select session, row_index, lead(value) over (partition by session order by row_index) - value as d from ev where modality = 'click') select session, row_index, round(coalesce(d, 0), 6) as action from l")
def action_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = of(events(spark, sf_dir), "click").withColumn("state", F.array("value"))
    return episodes.steps(rows, "session", "row_index", "state", 1).select("session", "row_index", F.round(F.col("action")[0], 6).alias("action"))


@query(f"with {STEPS_SQL} select count(distinct conv_id)::bigint as episodes, count(*) filter (step = 0)::bigint as firsts, count(*) filter (step = n - 1)::bigint as lasts from s where n >= 2")
def step_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steps(spark, sf_dir).agg(F.countDistinct("conv_id").alias("episodes"), F.count_if("is_first").alias("firsts"), F.count_if("is_last").alias("lasts"))


@query("with e as (select conv_id, count(*)::bigint as n from conversations group by 1 having count(*) >= 4) select conv_id, n, (row_number() over (order by conv_id) - 1)::bigint as episode_id from e")
def episode_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n")).filter("n >= 4")
    return episodes.number_episodes(kept, "conv_id").select("conv_id", "n", F.col("episode_id").cast("long").alias("episode_id"))


ATTRIBUTES = {"ECONOMY": (1, 0), "PROMO": (0, 1), "SMALL": (1, 1)}


@query("select p_partkey, case p_type when 'ECONOMY' then 1 when 'SMALL' then 1 else 0 end::int as soft, case p_type when 'PROMO' then 1 when 'SMALL' then 1 else 0 end::int as heavy from part")
def object_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes by type from a small fixed table; an unknown type has zeros."""
    attributes = spark.createDataFrame([(k, *v) for k, v in ATTRIBUTES.items()], "p_type string, soft int, heavy int")
    joined = table(spark, sf_dir, "part").join(F.broadcast(attributes), "p_type", "left")
    return joined.select("p_partkey", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("soft", "heavy")))


@query("select p_partkey, 'Pick up the ' || lower(p_name) || ' (' || p_brand || ').' as prompt from part")
def prompt_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", parse.prompt("Pick up the {name} ({brand}).", name=F.lower("p_name"), brand=F.col("p_brand")).alias("prompt"))


@query("select p_partkey, (('0x' || right(md5(p_name), 8))::bigint % 128)::bigint as hash_id from part")
def stable_hash_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", episodes.stable_hash_id(F.col("p_name"), 128).alias("hash_id"))


@query("""with a as (select c_custkey, c_mktsegment, c_custkey % 50 as row_start, c_custkey % 50 + c_custkey % 5 - 1 as row_end from customer where c_custkey % 3 = 0), x as (select c_custkey, c_mktsegment, unnest(range(row_start, row_end + 1)) as row from a)
    select x.c_custkey, x.row::bigint as row, n.n_name from x join nation n on n.n_nationkey = x.row""")
def range_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation ranges to rows, joined to the rows that exist."""
    k = F.col("c_custkey")
    notes = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select("c_custkey", (k % 50).alias("row_start"), (k % 50 + k % 5 - 1).alias("row_end"))
    return episodes.expand_ranges(notes, "c_custkey").join(table(spark, sf_dir, "nation"), F.col("row") == F.col("n_nationkey")).select("c_custkey", "row", "n_name")


@query("with n as (select c_mktsegment, c_name, row_number() over (partition by c_mktsegment order by c_name) - 1 as k from customer) select c_mktsegment, (k // 12)::bigint as sheet, min_by(c_name, k) as first, max_by(c_name, k) as last, count(*)::bigint as n from n group by 1, 2")
def sheet_paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.pages(table(spark, sf_dir, "customer").select("c_mktsegment", "c_name"), "c_mktsegment", "c_name")


@query(f"with {EV}, n as (select session, modality, count(*) as n from ev group by all) select session, modality, greatest(0, least(n - 1, round_even((n - 1) * 0.25::double, 0)::bigint))::bigint as pick from n")
def fractional_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("session", "modality").agg(F.count("*").alias("n")).select("session", "modality", episodes.pick_index(F.col("n"), 0.25).alias("pick"))


@query("""select c_custkey, case c_mktsegment when 'BUILDING' then 0 when 'MACHINERY' then 1 when 'FURNITURE' then 2 else 999 end::bigint as split_rank,
    row_number() over (partition by c_nationkey order by case c_mktsegment when 'BUILDING' then 0 when 'MACHINERY' then 1 when 'FURNITURE' then 2 else 999 end, c_name)::int as pos from customer""")
def custom_rank_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "customer").withColumn("split_rank", episodes.rank_in(F.col("c_mktsegment"), ["BUILDING", "MACHINERY", "FURNITURE"]))
    return rows.select("c_custkey", "split_rank", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("split_rank", "c_name")).alias("pos"))


@query("select c_mktsegment as split, count(*)::bigint as sessions, round(sum(c_acctbal), 2) as frames from customer group by 1")
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("split")).agg(F.count("*").alias("sessions"), F.round(F.sum("c_acctbal"), 2).alias("frames"))


@query("select r_name as task, c_mktsegment as split, count(*)::bigint as sessions, sum(c_custkey)::bigint as frames from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by rollup (r_name, c_mktsegment)")
def task_split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))  # tables of 25 and 5 rows
    return rows.rollup(F.col("r_name").alias("task"), F.col("c_mktsegment").alias("split")).agg(F.count("*").alias("sessions"), F.sum("c_custkey").alias("frames"))


MOTION_SQL = "m as (select *, coalesce((value - lag(value) over (partition by session order by row_index)) / 0.016::double, 0) as speed from ev), a as (select *, coalesce((speed - lag(speed) over (partition by session order by row_index)) / 0.016::double, 0) as accel, row_number() over (partition by session order by row_index desc) as back from m)"


@query(f"with {EV}, {MOTION_SQL} select session, row_index, round(speed, 3) as speed, round(accel, 2) as accel from a")
def traj_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = trajectory.motion(events(spark, sf_dir), "session", "row_index", "value")
    return moved.select("session", "row_index", F.round("speed", 3).alias("speed"), F.round("accel", 2).alias("accel"))


@query(f"""with {EV}, {MOTION_SQL} select session, count(*)::bigint as n, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as std, min(value) as min, max(value) as max, round(avg(value) filter (back <= 10), 6) as tail_mean,
    round(avg(abs(speed)), 4) as speed_mean, round(max(abs(speed)), 4) as speed_max, max_by(value, row_index) as final from a group by 1""")
def episode_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = r6(trajectory.episode_stats(events(spark, sf_dir), "session", "row_index", "value"), "mean", "std", "tail_mean")
    return found.withColumns({c: F.round(c, 4) for c in ("speed_mean", "speed_max")})


@query(f"""with {EV}, e as (select session, avg(value) as mean, max_by(value, row_index) as final from ev group by 1) select count(*)::bigint as episodes, round(avg(final), 6) as avg_final, round(min(final), 6) as best_final,
    round(max(final), 6) as worst_final, round(100.0::double * count(*) filter (final < 20) / count(*), 6) as success_pct, case when 100.0 * count(*) filter (final < 20) / count(*) >= 80 then 'good' when 100.0 * count(*) filter (final < 20) / count(*) >= 50 then 'fair' else 'poor' end as verdict from e""")
def cross_episode_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = trajectory.episode_stats(events(spark, sf_dir), "session", "row_index", "value")
    found = e.agg(F.count("*").alias("episodes"), F.avg("final").alias("avg_final"), F.min("final").alias("best_final"), F.max("final").alias("worst_final"), (F.count_if(F.col("final") < 20) * 100.0 / F.count("*")).alias("success_pct"))
    return r6(found, "avg_final", "best_final", "worst_final", "success_pct").withColumn("verdict", rules.band(F.col("success_pct"), 80, 50))


@query("select d.source, count(*)::bigint as n, round(100.0::double * sum(quality) / count(*), 6) as success_pct from labels l join documents d using (doc_id) group by 1")
def success_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return r6(rows.groupBy("source").agg(F.count("*").alias("n"), (F.sum("quality") * 100.0 / F.count("*")).alias("success_pct")), "success_pct")


@query(f"with {EV}, b as (select *, value - avg(value) filter (modality = 'view') over (partition by session) as net from ev) select session, modality, round(avg(net), 6) as net_mean, round(max(net), 6) as net_max, count(*)::bigint as n from b group by 1, 2")
def phase_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(trajectory.phase_baseline(events(spark, sf_dir), "session", "modality", "value", "view"), "net_mean", "net_max")


SPANS = "c as (select *, coalesce((modality <> lag(modality) over w)::int, 1) as ch from ev window w as (partition by session order by row_index)), g as (select *, sum(ch) over (partition by session order by row_index) as span from c)"


@query(f"with {EV}, {SPANS} select session, span::bigint as span, any_value(modality) as phase, min(row_index) as first, max(row_index) as last, count(*)::bigint as n from g group by 1, 2")
def phase_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory.phase_spans(events(spark, sf_dir), "session", "row_index", "modality")


@query(f"with {EV}, {SPANS} select modality as phase, count(*)::bigint as n, count(distinct (session, span))::bigint as spans from g group by 1")
def phase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory.phase_spans(events(spark, sf_dir), "session", "row_index", "modality").groupBy("phase").agg(F.sum("n").alias("n"), F.count("*").alias("spans"))


@query(f"""with {EV}, b as (select *, max(value) filter (modality in ('click', 'view')) over (partition by session) as peak, avg(value) filter (modality in ('click', 'view')) over (partition by session) as mean from ev)
    select session, row_index, round(case when modality in ('click', 'view') then peak + 0.3::double * (value - mean) else value end, 9) as anchored from b""")
def peak_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trajectory.peak_anchored(events(spark, sf_dir), "session", "modality", "value", ["click", "view"])
    return rows.select("session", "row_index", F.round("anchored", 9).alias("anchored"))


@query(f"""with {EV}, i as (select *, value < 60 as ok from ev), r as (select *, sum((not ok)::int) over (partition by session order by row_index) as run from i), s as (select *, count(*) filter (ok) over (partition by session, run order by row_index rows unbounded preceding) as streak from r)
    select session, row_index, streak::bigint as streak, streak >= 5 as paused from s""")
def debounce_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory.debounce(events(spark, sf_dir).withColumn("ok", F.col("value") < 60), "session", "row_index", "ok", 5).select("session", "row_index", "streak", "paused")


@query(f"""with {EV}, h as (select session, row_index, t // 3600000000 as h from ev where modality = 'signup'), l as (select *, lead(h) over (partition by session order by h, row_index) as nx from (select session, h, min(row_index) as row_index from h group by 1, 2))
    select session, row_index, unnest(range(h, greatest(h, coalesce(nx - 1, h)) + 1, 24))::bigint as grid_t from l""")
def densify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = of(events(spark, sf_dir), "signup").withColumn("h", F.expr("t div 3600000000")).groupBy("session", "h").agg(F.min("row_index").alias("row_index"))
    return trajectory.densify(rows, "session", "h", 24).select("session", "row_index", "grid_t")


@query("select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 5) as norm, label from embeddings")
def embed_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    norm = F.sqrt(F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(norm, 5).alias("norm"), "label")


@query("""with e as (select vec_id, vec_id // 32 as batch, embedding[1:32]::double[] as a, embedding[33:64]::double[] as p from embeddings where len(embedding) = 64), l as (select x.batch, x.vec_id as i, y.vec_id as j, list_cosine_similarity(x.a, y.p) / 0.07::double as l from e x join e y using (batch)),
    w as (select *, ln(sum(exp(l)) over (partition by batch, i)) - l as r, ln(sum(exp(l)) over (partition by batch, j)) - l as c from l) select batch, count(*)::bigint as n, round((avg(r) + avg(c)) / 2, 4) as loss from w where i = j group by 1""")
def contrastive_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contrastive loss in batches of 32 vectors, their halves taken as two views."""
    e = table(spark, sf_dir, "embeddings").filter("size(embedding) = 64").withColumn("e", F.col("embedding").cast("array<double>"))
    pairs = e.select("vec_id", F.expr("vec_id div 32").alias("batch"), F.slice("e", 1, 32).alias("a"), F.slice("e", 33, 32).alias("p"))
    return geometry.info_nce(pairs, "batch", "vec_id", "a", "p").withColumn("loss", F.round("loss", 4))


LINES = "l as (select doc_id, source, unnest(string_split(text, chr(10))) as line from documents where text is not null)"
NOISE = "((regexp_matches(line, '[0-9]{4}-[0-9]{2}') or starts_with(line, 'password') or contains(line, '@')) and not contains(line, 'http'))"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", "source", F.explode(F.split("text", "\n")).alias("line"))
    return lines.withColumn("noise", parse.is_noise(F.col("line"), ["http"], ["[0-9]{4}-[0-9]{2}"], ["password"], ["@"]))


@query(f"with {LINES} select doc_id, count(*)::bigint as n_lines, (count(*) filter (not {NOISE}))::bigint as n_kept from l group by 1")
def log_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(~F.col("noise")).alias("n_kept"))


@query(f"with {LINES} select source, count(*)::bigint as suppressed from l where {NOISE} group by 1")
def log_suppression_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).filter("noise").groupBy("source").agg(F.count("*").alias("suppressed"))


@query(f"with {EV} select modality, count(*)::bigint as n, (count(*) filter (code = 0))::bigint as zero, min(code)::bigint as least, max(code)::bigint as most from ev group by 1")
def json_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("modality").agg(F.count("*").alias("n"), F.count_if(F.col("code") == 0).alias("zero"), F.min("code").alias("least"), F.max("code").alias("most"))


@query("""with p as (select l_quantity - 25 as x, (l_discount - 0.05) * 300 as y, l_tax * 200 + 1 as z from lineitem), u as (select 30 * x / z + 112 as u, 30 * y / z + 112 as v from p)
    select least(23, greatest(0, floor(v * 3 / 28)))::int as row, least(23, greatest(0, floor(u * 3 / 28)))::int as col, (u >= 0 and u < 224 and v >= 0 and v < 224) as valid, count(*)::bigint as n from u group by all""")
def patch_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") - 25).alias("x"), ((F.col("l_discount") - 0.05) * 300).alias("y"), (F.col("l_tax") * 200 + 1).alias("z"))
    p = geometry.project(F.col("x"), F.col("y"), F.col("z"), 30.0, 30.0, 112.0, 112.0, 224, 224)
    return li.select(p.alias("p")).groupBy("p.row", "p.col", "p.valid").agg(F.count("*").alias("n"))


@query("select l_returnflag, round(avg(degrees(acos(least(1, greatest(-1, (l_discount * 30 + l_tax * 10 - 1) / 2))))), 6) as mean_deg, round(max(degrees(acos(least(1, greatest(-1, (l_discount * 30 + l_tax * 10 - 1) / 2))))), 6) as max_deg from lineitem group by 1")
def rot_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = geometry.rotation_error_deg(F.col("l_discount") * 30 + F.col("l_tax") * 10)
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(F.avg(e), 6).alias("mean_deg"), F.round(F.max(e), 6).alias("max_deg"))


@query("""with q as (select s_suppkey, s_nationkey - 12.0::double as w, s_suppkey % 7 + 1.0::double as x, s_suppkey % 5 - 2.0::double as y, s_suppkey % 3 - 1.0::double as z from supplier),
    n as (select *, sqrt(w * w + x * x + y * y + z * z) as n, sqrt(x * x + y * y + z * z) as m from q), a as (select *, 2 * atan2(m / n, abs(w) / n) / (m / n) * (case when w < 0 then -1 else 1 end) / n as k from n)
    select s_suppkey, round(k * x, 6) as rx, round(k * y, 6) as ry, round(k * z, 6) as rz from a""")
def quat_rotvec(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    v = geometry.quat_to_rotvec(F.col("s_nationkey") - F.lit(12.0), k % 7 + F.lit(1.0), k % 5 - F.lit(2.0), k % 3 - F.lit(1.0))
    return table(spark, sf_dir, "supplier").select("s_suppkey", *(F.round(c, 6).alias(n) for c, n in zip(v, ("rx", "ry", "rz"), strict=True)))


@query("""with g as (select l_orderkey % 10 as k, greatest(0.0::double, l_quantity - 30, 10 - (l_quantity + 5)) as gx, greatest(0.0::double, l_discount * 100 - 4, 1 - (l_discount * 100 + 1)) as gy from lineitem)
    select k, count(*) filter (sqrt(gx * gx + gy * gy) <= 5)::bigint as contacts, round(avg(sqrt(gx * gx + gy * gy)), 6) as mean_gap from g group by 1""")
def aabb_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, d = F.col("l_quantity"), F.col("l_discount") * 100
    gap = geometry.aabb_distance([q, d], [q + 5, d + 1], [F.lit(10.0), F.lit(1.0)], [F.lit(30.0), F.lit(4.0)])
    return table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 10).alias("k")).agg(F.count_if(gap <= 5).alias("contacts"), F.round(F.avg(gap), 6).alias("mean_gap"))


@query("""with s as (select c_nationkey, c_custkey, abs(c_acctbal) as score, count(*) over (partition by c_nationkey) as n, row_number() over (partition by c_nationkey order by abs(c_acctbal), c_custkey) as r from customer),
    k as (select * from s where r <= case when n >= 8 then greatest(4, round_even(n * (1 - 0.2::double), 0)) else n end) select c_nationkey, count(*)::bigint as n, round(avg(score), 4) as mean, round(median(score), 4) as median, max(score) as max from k group by 1""")
def calibration_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best samples of each group by score, then mean, median and largest error."""
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.abs("c_acctbal").alias("score"))
    kept = geometry.trimmed(rows, "c_nationkey", "score", "c_custkey")
    return kept.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("mean"), F.round(F.median("score"), 4).alias("median"), F.max("score").alias("max"))


@query("select c_nationkey, min_by(c_mktsegment, (m, c_mktsegment)) as method, round(min(m), 4) as error from (select c_nationkey, c_mktsegment, avg(c_acctbal) as m from customer group by 1, 2) group by 1")
def best_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.avg("c_acctbal").alias("m"))
    return means.groupBy("c_nationkey").agg(F.min_by("c_mktsegment", F.struct("m", "c_mktsegment")).alias("method"), F.round(F.min("m"), 4).alias("error"))


@query()
def average_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean rotation (an eigenvector, which SQL has not) and median translation by nation."""
    k = F.col("s_suppkey")
    q = [F.lit(10.0), (k % 7).cast("double"), (k % 5).cast("double"), (k % 3).cast("double")]
    n = F.sqrt(sum((x * x for x in q[1:]), q[0] * q[0]))
    poses = table(spark, sf_dir, "supplier").select("s_nationkey", *((x / n).alias(c) for x, c in zip(q, ("qw", "qx", "qy", "qz"), strict=True)), F.col("s_acctbal").alias("tx"), k.cast("double").alias("ty"), F.lit(0.0).alias("tz"))
    return geometry.average_pose(poses, "s_nationkey")


@query("select l_returnflag, count(*)::bigint as n, sum(round_even(least(65.535::double, greatest(0, l_tax * 10)) / 0.001::double, 0)::bigint)::bigint as total_mm from lineitem group by 1")
def depth_to_mm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum(clean.depth_to_mm(F.col("l_tax") * 10).cast("long")).alias("total_mm"))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    like = spark.read.parquet(f"{sf_dir}/events.parquet")
    return streaming.read_folder(spark, like, f"{sf_dir}/event[s].parquet")  # a pattern may name a file or a folder


@query("select epoch_us(time_bucket(interval 1 day, ts)) as start_us, event_type, count(*)::bigint as n, round(sum(value), 4) as total from events group by 1, 2")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = streaming.tumbling(streaming.with_event_time(_stream(spark, sf_dir)), "1 day", ["event_type"])
    return streaming.run_to_table(windows, shared_folder(spark)).withColumn("total", F.round("total", 4))


@query("""with l as (select user_id, epoch_us(ts) as t, coalesce((epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts) >= 21600000000)::int, 1) as cut from events), s as (select *, sum(cut) over (partition by user_id order by t) as k from l)
    select user_id, min(t)::bigint as start_us, count(*)::bigint as n from s group by user_id, k""")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.run_to_table(streaming.sessions(streaming.with_event_time(_stream(spark, sf_dir)), "6 hours", "user_id"), shared_folder(spark))


@query("select user_id, event_type, epoch_us(time_bucket(interval 1 day, ts)) as day, count(distinct props)::bigint as n from events group by all")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows equal in session, kind, day and code count once; counted from the stream's append-mode output."""
    s = _stream(spark, sf_dir).withColumn("day", F.unix_micros(F.date_trunc("day", F.col("ts").cast("timestamp"))))
    first, last = table(spark, sf_dir, "events").agg(F.min("ts").cast("timestamp").cast("long"), F.max("ts").cast("timestamp").cast("long")).first()
    late = f"{(last or 0) - (first or 0) + 86400} seconds"  # files come in any order, so no row may count as late
    kept = streaming.deduplicated(streaming.with_event_time(s, late=late), ["user_id", "event_type", "day", "props"])
    done = streaming.run_to_table(kept.select("user_id", "event_type", "day", "props"), shared_folder(spark), "append")
    return done.groupBy("user_id", "event_type", "day").agg(F.count("*").alias("n"))


@query("with e as (select user_id, event_id as row_index, epoch_us(ts) // 3600000000 as t, row_number() over (partition by user_id order by event_id) as rn from events) select user_id, row_index, (max(t - rn) over (partition by user_id order by rn) + rn)::bigint as clock from e")
def stream_monotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _stream(spark, sf_dir).select("user_id", F.col("event_id").alias("row_index"), F.expr("unix_micros(cast(ts as timestamp)) div 3600000000").alias("t"))
    return streaming.monotonic(streaming.run_to_table(s, shared_folder(spark), "append"), "user_id")
