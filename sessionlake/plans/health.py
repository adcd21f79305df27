"""Stream health: timing, order, fills, cells, issues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.functions import parse
from sessionlake.operators import clean, episodes, rules, stats, trajectory
from sessionlake.plans.registry import EV, events, query, r6, table, thousandths

HOUR_US = 3_600_000_000
#: Streams with faults put in: hours as times give duplicates, every 11th cell is empty.
DIRTY = "d as (select session, row_index, arrival, modality, t // 3600000000 as t, value, case when row_index % 11 = 0 then '' else value::varchar end as cell, code from ev)"
D = f"{EV}, {DIRTY}"


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return e.withColumn("t", F.expr(f"t div {HOUR_US}")).withColumn("cell", F.when(F.col("row_index") % 11 == 0, "").otherwise(F.col("value").cast("string")))


STATS_SQL = """l as (select *, t - lag(t) over (partition by session, modality order by arrival) as delta from d),
    st as (select session, modality, count(t)::bigint as n, (max(t) - min(t))::bigint as duration_us, median(case when delta > 0 then delta end) as m,
        (count(t) - count(distinct t))::bigint as duplicates, (count(*) filter (delta < 0))::bigint as reversals from l group by all)"""
HZ = "case when n >= 2 and duration_us > 0 then (n - 1) * 1e6 / duration_us end"


@query(f"with {D}, {STATS_SQL} select session, modality, n, duration_us, round({HZ}, 6) as hz_mean, round(1e6 / m, 6) as hz_median, duplicates, reversals from st")
def stream_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(stats.timing(dirty(spark, sf_dir), ["session", "modality"]), "hz_mean", "hz_median")


CHECK_SQL = """l as (select *, (t - lag(t) over (partition by session order by arrival)) as delta from ev), i as (select *, case when delta > 0 then delta / 1000.0::double end as ms from l),
    k as (select *, avg(ms) over (partition by session) as mean from i)"""


@query(f"""with {EV}, {CHECK_SQL} select session, count(*)::bigint as n, (max_by(t, arrival) - min_by(t, arrival))::bigint as duration_us, round(avg(ms), 3) as mean_ms, round(median(ms), 3) as median_ms,
    round(stddev_samp(ms), 3) as std_ms, round(min(ms), 3) as min_ms, round(max(ms), 3) as max_ms, round(1000 / avg(ms), 9) as mean_hz from k group by session""")
def stream_timing_checker(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.timing_checker(events(spark, sf_dir), ["session"]).drop("gaps", "max_gap_ms", "near_duplicates")
    return found.withColumns({c: thousandths(F.col(c)) for c in ("mean_ms", "median_ms", "std_ms", "min_ms", "max_ms")}).withColumn("mean_hz", F.round("mean_hz", 9))


@query(f"with {EV}, {CHECK_SQL} select session, (count(*) filter (ms > 2 * mean))::bigint as gaps, round(max(case when ms > 2 * mean then ms end), 3) as max_gap_ms from k group by session")
def gap_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.timing_checker(events(spark, sf_dir), ["session"]).select("session", "gaps", F.round("max_gap_ms", 3).alias("max_gap_ms"))


@query(f"with {EV}, l as (select *, t - lag(t) over (partition by session order by row_index) as delta from ev) select session, (count(*) filter (delta > 0 and delta < 3600000000))::bigint as near_duplicates from l group by session")
def near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.timing_checker(events(spark, sf_dir), ["session"], "row_index", HOUR_US).select("session", "near_duplicates")


@query(f"with {D}, l as (select *, t - lag(t) over (partition by session order by arrival) as delta from d) select session, (count(*) filter (delta < 0))::bigint as reversals, coalesce(bool_and(delta >= 0), true) as monotonic from l group by session")
def reversals(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = F.count_if(F.col("delta") < 0)
    return stats.deltas(dirty(spark, sf_dir), ["session"]).groupBy("session").agg(back.alias("reversals"), (back == 0).alias("monotonic"))


@query(f"""with {D}, a as (select session, t, row_number() over (partition by session order by arrival) as pos from d), b as (select session, t as s, row_number() over (partition by session order by t, arrival) as pos from d)
    select session, (count(*) filter (t <> s))::bigint as rows_reordered from a join b using (session, pos) group by session""")
def rows_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.reordered(dirty(spark, sf_dir), "session")


@query(f"""with {EV}, x as (select session, row_index, arrival, case when session % 10 = 0 and row_index % 11 = 0 then null else t end as t from ev), y as (select *, bool_and(t is not null) over (partition by session) as whole from x)
    select session, row_index, row_number() over (partition by session order by case when whole then t else 0 end, arrival)::int as pos from y""")
def stable_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("t", F.when(~((F.col("session") % 10 == 0) & (F.col("row_index") % 11 == 0)), F.col("t")))
    return clean.stable_sort(rows, "session").select("session", "row_index", "pos")


@query(f"with {D} select session, t, arg_min(row_index, arrival) as row_index from d group by session, t")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.dedupe_first(dirty(spark, sf_dir), ["session", "t"]).select("session", "t", "row_index")


FILLED = """coalesce(last_value(nullif(cell, '') ignore nulls) over (partition by session order by arrival rows unbounded preceding),
    first_value(nullif(cell, '') ignore nulls) over (partition by session order by arrival rows between unbounded preceding and unbounded following))"""


@query(f"with {D} select session, row_index, round({FILLED}::double, 6) as filled from d")
def ffill_bfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.fill(dirty(spark, sf_dir), "session", ["cell"]).select("session", "row_index", F.round(F.col("cell").cast("double"), 6).alias("filled"))


@query(f"""with {D}, k as (select * from d qualify row_number() over (partition by session, t order by arrival) = 1), c as (select session, {FILLED} as filled, cell from k), a as (select session, count(*) as n from d group by 1)
    select session, any_value(a.n)::bigint as rows_before, count(*)::bigint as rows_after, (count(*) filter (cell = ''))::bigint as cells_filled, round(sum(filled::double), 4) as total from c join a using (session) group by session""")
def gripper_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dirty(spark, sf_dir)
    kept = clean.dedupe_first(raw, ["session", "t"]).withColumn("filled", F.col("cell"))
    done = clean.fill(kept, "session", ["filled"]).groupBy("session").agg(F.count("*").alias("rows_after"), F.count_if(F.col("cell") == "").alias("cells_filled"), F.round(F.sum(F.col("filled").cast("double")), 4).alias("total"))
    return raw.groupBy("session").agg(F.count("*").alias("rows_before")).join(done, "session")


def _channels(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Quantity is the bad channel; price, discount and tax are its neighbours, the first two empty at times."""
    x = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").alias("bad"), F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("a"), F.when(F.col("l_linenumber") != 4, F.col("l_discount")).alias("b"), F.col("l_tax").alias("c"))
    x = x.withColumn("fixed", clean.repaired(F.col("bad"), [F.col("a"), F.col("b"), F.col("c")], mode)).withColumn("ok", F.col("a").isNotNull() & F.col("b").isNotNull())
    return x.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("failed"), F.count_if(F.col("fixed") != F.col("bad")).alias("changed"), F.round(F.sum("fixed"), 2).alias("total"))


def _channels_sql(fixed: str) -> str:
    return f"""with x as (select l_returnflag, l_quantity as bad, case when l_linenumber <> 3 then l_extendedprice end as a, case when l_linenumber <> 4 then l_discount end as b, l_tax as c from lineitem),
        y as (select *, {fixed} as fixed from x) select l_returnflag, count(*)::bigint as n, (count(*) filter (a is null or b is null))::bigint as failed, (count(*) filter (fixed <> bad))::bigint as changed, round(sum(fixed), 2) as total from y group by 1"""


@query(_channels_sql("coalesce(trunc((a + b + c) / 3), bad)"))
def channel_repair_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _channels(spark, sf_dir, "clean")


@query(_channels_sql("trunc((coalesce(a, 0) + coalesce(b, 0) + c) / ((a is not null)::int + (b is not null)::int + 1))"))
def channel_repair_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _channels(spark, sf_dir, "display")


@query(_channels_sql("(a + b + c) / 3"))
def channel_repair_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _channels(spark, sf_dir, "tensor")


CHANNELS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LONG = f"u as (unpivot (select l_linestatus, {', '.join(CHANNELS)} from lineitem) on {', '.join(CHANNELS)} into name channel value value)"


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.channels_long(table(spark, sf_dir, "lineitem"), ["l_linestatus"], CHANNELS)


@query(f"with {LONG} select channel, (count(*) filter (value not between 0 and 5007))::bigint as n_bad, min(value) as min, max(value) as max from u group by 1 having n_bad > 0")
def adc_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = stats.out_of_range(_long(spark, sf_dir))
    return bad.select("channel", "n_bad", "min", "max")


@query(f"with {LONG} select l_linestatus, channel, count(*)::bigint as n, round(avg(value), 4) as mean, max(value) as max, min(value) as min, round(coalesce(stddev_samp(value), 0), 4) as std from u group by grouping sets ((l_linestatus, channel), (channel))")
def channel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.channel_stats(_long(spark, sf_dir), "l_linestatus").withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query(f"with {D} select modality, (count(*) filter (cell = ''))::bigint as blank, count(*)::bigint as cells from d group by 1")
def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(spark, sf_dir).groupBy("modality").agg(F.count_if(parse.is_blank(F.col("cell"))).alias("blank"), F.count("*").alias("cells"))


@query(f"with {D} select session, (count(*) filter (cell = '' and code % 2 = 0))::bigint as allowed, (count(*) filter (cell = '' and code % 2 <> 0))::bigint as disallowed from d group by 1")
def allowed_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank, may = parse.is_blank(F.col("cell")), F.col("code") % 2 == 0
    return dirty(spark, sf_dir).groupBy("session").agg(F.count_if(blank & may).alias("allowed"), F.count_if(blank & ~may).alias("disallowed"))


@query("select l_orderkey, (max(l_linenumber) - min(l_linenumber) + 1 - count(distinct l_linenumber))::bigint as missing from lineitem group by 1")
def seq_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.missing_ids(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("with e as (select l_orderkey, unnest(range(1, max(l_linenumber) + 1)) as id, list(distinct l_linenumber) as seen from lineitem group by 1) select l_orderkey, id::int as id from e where not list_contains(seen, id)")
def expected_minus_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_linenumber").alias("top"), F.collect_set("l_linenumber").alias("seen"))
    return lines.select("l_orderkey", F.explode(F.array_except(F.sequence(F.lit(1), F.col("top")), "seen")).alias("id"))


@query(f"with {EV} select session, code from ev where modality in ('view', 'click', 'purchase') group by 1, 2 having count(distinct modality) = 3")
def stem_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).filter(F.col("modality").isin("view", "click", "purchase"))
    return episodes.intersection(rows, ["session", "code"], "modality", 3)


@query(f"""with {EV} select session, least(count(distinct code) filter (modality = 'view'), count(distinct code) filter (modality = 'click'))::bigint as complete_frames,
    greatest(count(distinct code) filter (modality = 'view'), count(distinct code) filter (modality = 'click'))::bigint as max_frames from ev group by 1""")
def complete_visual_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = events(spark, sf_dir).filter("modality in ('view', 'click')").groupBy("session", "modality").agg(F.countDistinct("code").alias("k"))
    n = {m: F.coalesce(F.max(F.when(F.col("modality") == m, F.col("k"))), F.lit(0)) for m in ("view", "click")}
    found = per.groupBy("session").agg(F.least(*n.values()).alias("complete_frames"), F.greatest(*n.values()).alias("max_frames"))
    return events(spark, sf_dir).select("session").distinct().join(found, "session", "left").na.fill(0)


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the four required modalities of every session, absent ones too."""
    d = dirty(spark, sf_dir)
    cells = d.groupBy("session", "modality").agg(F.count("*").alias("n_rows"), F.count_if(parse.is_blank(F.col("cell"))).alias("empty_cells"), F.count_if(~F.col("value").between(0, 300)).alias("bad_values"))
    found = stats.timing(d, ["session", "modality"]).join(cells, ["session", "modality"])
    wanted = d.filter("session % 7 <> 0 or modality <> 'click'")  # a session in seven is held to lack its robot
    modalities = F.explode(F.array(*map(F.lit, ("view", "click", "purchase", "signup")))).alias("modality")
    every = d.select("session").distinct().select("session", modalities)
    found = found.join(wanted.select("session", "modality").distinct(), ["session", "modality"], "left_semi")
    full = every.join(found, ["session", "modality"], "left")
    return full.withColumn("present", F.col("n_rows").isNotNull()).withColumn("required", F.lit(True)).withColumn("min_hz", F.when(F.col("modality") == "view", 20000.0).otherwise(10000.0))


FULL_SQL = f"""{D}, {STATS_SQL}, ce as (select session, modality, count(*) as n_rows, count(*) filter (cell = '') as empty_cells, count(*) filter (value not between 0 and 300) as bad_values from d group by all),
    fs as (select st.*, ce.n_rows, ce.empty_cells, ce.bad_values, {HZ} as hz_mean from st join ce using (session, modality) where session % 7 <> 0 or modality <> 'click'),
    full_ as (select s.session, m.modality, fs.* exclude (session, modality), fs.n_rows is not null as present, case when m.modality = 'view' then 20000.0 else 10000.0 end::double as min_hz
        from (select distinct session from d) s cross join (select unnest(['view', 'click', 'purchase', 'signup']) as modality) m left join fs using (session, modality)),
    iss as (select session, modality, 'non_monotonic_timestamps' as code, 'warn' as severity, reversals::bigint as found from full_ where reversals > 0
        union all select session, modality, 'duplicate_timestamps', 'warn', duplicates::bigint from full_ where duplicates > 0
        union all select session, modality, 'empty_cells', 'warn', empty_cells::bigint from full_ where empty_cells > 0
        union all select session, modality, 'low_frequency', 'warn', n::bigint from full_ where hz_mean < min_hz
        union all select session, modality, 'adc_out_of_range', 'warn', bad_values::bigint from full_ where bad_values > 0
        union all select session, modality, 'missing_required_modality', 'error', 0::bigint from full_ where not present)"""


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.issues(_stats(spark, sf_dir), rules.STREAM_RULES, ["session", "modality"])


@query(f"with {FULL_SQL} select * from iss")
def issue_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(spark, sf_dir)


@query(f"with {FULL_SQL} select 'modality' as kind, modality as key, count(*)::bigint as n from iss group by 2 union all select 'code', code, count(*)::bigint from iss group by 2 union all select 'severity', severity, count(*)::bigint from iss group by 2")
def issue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.counters(_issues(spark, sf_dir), ["modality", "code", "severity"])


@query(f"with {FULL_SQL} select session, (count(*) filter (severity = 'error'))::bigint as n_error, (count(*) filter (severity = 'warn'))::bigint as n_warn, (count(*) filter (severity = 'info'))::bigint as n_info from iss group by 1")
def severity_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.severity_pivot(_issues(spark, sf_dir), "session")


@query(f"""with {FULL_SQL} select modality, count(*)::bigint as sessions_present, sum(n)::bigint as total, min(n)::bigint as min_count, max(n)::bigint as max_count, round(avg(n), 6) as mean_count,
    round(avg(hz_mean), 4) as mean_hz, round(min(hz_mean), 4) as min_hz_seen, round(max(hz_mean), 4) as max_hz_seen from full_ where present group by 1""")
def modality_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.modality_rollup(_stats(spark, sf_dir)).withColumn("mean_count", F.round("mean_count", 6))
    return found.withColumns({c: F.round(c, 4) for c in ("mean_hz", "min_hz_seen", "max_hz_seen")})


@query(f"""with {EV} select session, coalesce(nullif(max(t) filter (modality = 'view') - min(t) filter (modality = 'view'), 0),
        greatest(max(t) filter (modality = 'click') - min(t) filter (modality = 'click'), max(t) filter (modality = 'purchase') - min(t) filter (modality = 'purchase')))::bigint as duration_us,
    round((count(*) filter (modality = 'error')) * 1e6 / nullif(coalesce(nullif(max(t) filter (modality = 'view') - min(t) filter (modality = 'view'), 0),
        greatest(max(t) filter (modality = 'click') - min(t) filter (modality = 'click'), max(t) filter (modality = 'purchase') - min(t) filter (modality = 'purchase'))), 0), 9) as image_hz from ev group by 1""")
def session_duration_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duration from frames, or else the longest of the other streams; and a count's rate over it."""

    def span(m: str):
        t = F.when(F.col("modality") == m, F.col("t"))
        return F.max(t) - F.min(t)

    chosen = F.coalesce(F.nullif(span("view"), F.lit(0)), F.greatest(span("click"), span("purchase")))
    found = events(spark, sf_dir).groupBy("session").agg(chosen.alias("duration_us"), F.count_if(F.col("modality") == "error").alias("_n"))
    return found.select("session", "duration_us", F.round(F.try_divide(F.col("_n") * 1e6, F.col("duration_us")), 9).alias("image_hz"))


@query(f"with {D} select session, row_index, (max(t - rn) over (partition by session order by rn) + rn)::bigint as clock from (select *, row_number() over (partition by session order by arrival) as rn from d)")
def monotonic_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory.monotonic_clock(dirty(spark, sf_dir), "session", "arrival").select("session", "row_index", "clock")


@query(f"""with {EV}, l as (select *, t - lag(t) over (partition by session order by t) as delta, max(t) over (partition by session) as fin from ev)
    select session, count(*)::bigint as n, round(1e6 / avg(delta), 9) as avg_hz, (count(*) filter (t >= fin - 86400000000))::bigint as recent, round(stddev_pop(delta), 0) as std_us,
    round(100 * stddev_pop(delta) / avg(delta), 4) as jitter_pct, greatest(0, floor((max(t) - min(t)) * 0.0001 / 1e6)::bigint - count(*))::bigint as dropped from l group by session""")
def rate_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.rate_snapshot(events(spark, sf_dir), "session", 0.0001, 86_400_000_000)
    return found.withColumns({"avg_hz": F.round("avg_hz", 9), "std_us": F.round("std_us", 0), "jitter_pct": F.round("jitter_pct", 4)})


@query("select least(9, greatest(0, floor((value - 10) / 20)))::int as bin, count(*)::bigint as n from events where value is not null group by 1")
def hist10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(events(spark, sf_dir), 10.0, 210.0)
