"""Files, versions and archives made of the driver's tables and read back; roots, calibration and session codes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.operators import clean, handeye, manifest, rules
from sessionlake.plans.registry import EV, events, query, table
from sessionlake.session import shared_folder
from sessionlake.sources import quoted_csv, recordings, tensors, versions


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("select doc_id, length(text)::bigint as n_chars, md5(coalesce(text, '')) as digest, coalesce(source, '') as source from documents")
def quoted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as CSV, with line ends, quotes and commas in quoted cells, and read back by splits."""
    folder = _folder(spark, "csv")
    docs = table(spark, sf_dir, "documents").select("doc_id", *(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "source")))
    docs.write.option("header", True).option("quoteAll", True).option("escape", '"').option("lineSep", "\n").csv(folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")  # several splits a file even of the small tables
    try:
        cells = F.col("cells")
        return quoted_csv.read_quoted_csv(spark, folder).select(cells["doc_id"].cast("long").alias("doc_id"), F.length(cells["text"]).cast("long").alias("n_chars"), F.md5(cells["text"]).alias("digest"), cells["source"].alias("source"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@query(f"""with {EV}, s as (select *, row_number() over (partition by session order by t, row_index) - 1 as i, count(*) over (partition by session) as n from ev where session % 3 = 1),
    w as (select a.session, a.i as window_id, a.t as start_us, max(b.t) as end_us, count(*) as k, round(sum(b.value * (b.i - a.i + 1)), 4) as total from s a join s b on b.session = a.session and b.i between a.i and a.i + 3 where a.i + 4 <= a.n group by 1, 2, 3)
    select session::varchar as session, window_id::bigint as window_id, start_us::bigint as start_us, end_us::bigint as end_us, total from w""")
def tensor_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of four samples written as an archive a session, and those of every third session read back."""
    spark.dataSource.register(tensors.Tensors)
    folder = _folder(spark, "tensors")
    rows = events(spark, sf_dir).select("session", "t", "row_index", "value")
    made = clean.windows(rows, ["session"], ["t", "row_index"], "value", size=4).select(
        F.col("session").cast("string").alias("session"), F.col("window_id").cast("long").alias("window_id"), F.col("start_t").alias("start_us"), F.col("end_t").alias("end_us"),
        F.col("center_t").cast("long").alias("center_us"), F.transform("tensor", lambda x: F.array(x)).alias("tensor"))
    made.repartition("session").sortWithinPartitions("session", "window_id").write.format("tensors").option("path", folder).mode("append").save()
    found = tensors.load(spark, folder).filter(F.col("session").cast("long") % 3 == 1)
    total = F.aggregate(F.zip_with("tensor", F.sequence(F.lit(1), F.lit(4)), lambda x, k: x[0] * k), F.lit(0.0), lambda a, x: a + x)
    return found.select("session", "window_id", "start_us", "end_us", F.round(total, 4).alias("total"))


@query("""with c as (select o_orderkey, o_totalprice * 2 as o_totalprice, 'new' as o_orderstatus, 2 as updated from orders where o_orderkey % 50 = 7
                     union all select o_orderkey + 100000000, 1.0, 'added', 2 from orders where o_orderkey % 500 = 3 union all select o_orderkey, -1.0, 'old', 0 from orders where o_orderkey % 50 = 9),
    a as (select o_orderkey, o_totalprice, o_orderstatus, 1 as updated from orders union all select * from c)
    select o_orderkey, max_by(o_orderstatus, updated) as o_orderstatus, round(max_by(o_totalprice, updated), 4) as o_totalprice, max(updated)::int as updated from a group by 1""")
def versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a table of versions, and changes put into the files that they touch: what changed, what is new, and what came too late."""
    folder = _folder(spark, "versions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    k = F.col("o_orderkey")
    versions.write(orders.withColumn("updated", F.lit(1)).repartitionByRange(8, "o_orderkey"), folder)
    changed = orders.filter(k % 50 == 7).select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("new").alias("o_orderstatus"), F.lit(2).alias("updated"))
    added = orders.filter(k % 500 == 3).select((k + 100_000_000).alias("o_orderkey"), F.lit(1.0).alias("o_totalprice"), F.lit("added").alias("o_orderstatus"), F.lit(2).alias("updated"))
    late = orders.filter(k % 50 == 9).select("o_orderkey", F.lit(-1.0).alias("o_totalprice"), F.lit("old").alias("o_orderstatus"), F.lit(0).alias("updated"))
    versions.upsert(changed.union(added).union(late), folder, "o_orderkey", "updated")
    return versions.read(spark, folder).withColumn("o_totalprice", F.round("o_totalprice", 4))


@query("select event_type, count(distinct user_id % 40)::bigint as folders, count(distinct user_id % 40)::bigint as files from events group by 1")
def folder_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of two levels, a file in each of the inner ones, found level by level."""
    folder = _folder(spark, "levels")
    rows = table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 40).alias("part"), "value")
    rows.repartition("event_type", "part").write.partitionBy("event_type", "part").parquet(folder)
    found = recordings.scan(spark, folder, "*.parquet")
    kind, inner = F.regexp_extract("path", "event_type=([^/]+)/", 1), F.regexp_extract("path", "part=([^/]+)/", 1)
    return found.groupBy(kind.alias("event_type")).agg(F.countDistinct(inner).alias("folders"), F.count("*").alias("files"))


@query("""with r as (select distinct regexp_replace(regexp_extract(url, '^(.*/)[^/]*$', 1), '/+$', '') as root from pages where page_id % 3 = 0 union select distinct regexp_extract(url, '^([a-z]+://[^/]*)', 1) from pages where page_id % 2 = 0),
    m as (select page_id, url, max_by(root, length(root)) as root from (select page_id, regexp_replace(url, '/+$', '') as url from pages) p join r on url = root or starts_with(url, root || '/') group by 1, 2)
    select p.page_id, coalesce(m.root, regexp_replace(regexp_replace(p.url, '/+$', ''), '/[^/]*$', '')) as root from pages p left join m on m.page_id = p.page_id""")
def deepest_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deepest of a table of roots (some pages' folders and hosts) that holds each page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    folders = pages.filter("page_id % 3 = 0").select(F.regexp_extract("url", "^(.*/)[^/]*$", 1).alias("root"))
    hosts = pages.filter("page_id % 2 = 0").select(F.regexp_extract("url", "^([a-z]+://[^/]*)", 1).alias("root"))
    return manifest.mapped_roots(pages, "page_id", "url", folders.union(hosts), "root").select("page_id", "root")


#: The planted X: a rotation of unit quaternion (0.5, 0.5, 0.5, 0.5), and a shift.
X_ROTATION, X_SHIFT = (0.0, 0.0, 1.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0), (0.1, -0.2, 0.3)


def _turn(axis: list, angle) -> list:
    """A rotation by an angle about a unit axis, row by row."""
    x, y, z = axis
    c, s = F.cos(angle), F.sin(angle)
    return [c + x * x * (1 - c), x * y * (1 - c) - z * s, x * z * (1 - c) + y * s, y * x * (1 - c) + z * s, c + y * y * (1 - c), y * z * (1 - c) - x * s, z * x * (1 - c) - y * s, z * y * (1 - c) + x * s, c + z * z * (1 - c)]


@query(f"""with s as (select c_nationkey % 4 as g, count(*) as n from customer group by 1) select g, n::bigint as n, case when n >= 8 then greatest(4, round_even(n * (1 - 0.2::double), 0)) else n end::bigint as n_used,
    {", ".join(f"{v:.1f}::double as r{k}" for k, v in enumerate(X_ROTATION))}, {", ".join(f"{v}::double as t{k}" for k, v in enumerate(X_SHIFT))} from s""")
def hand_eye(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planted X found from motions of which some are wrong; those are left out."""
    k = F.col("c_custkey").cast("double")
    raw = [k % 7 + 1, k % 5 - 2, k % 3 - 1]
    norm = F.sqrt(sum(v * v for v in raw))
    rb = _turn([v / norm for v in raw], (k % 11 + 3) / 8)
    tb = [k % 13 / 10, k % 17 / 20 - 0.4, k % 19 / 30]
    wrong = F.col("c_custkey") % 9 == 4
    x = X_ROTATION  # zeros are left out of the sums, else these would be very long
    turned = lambda i, of: sum(of[m] * x[3 * i + m] for m in range(3) if x[3 * i + m])
    ra = [turned(i, [turned(j, rb[3 * m : 3 * m + 3]) for m in range(3)]) for i in range(3) for j in range(3)]  # A = X B X^-1
    ta = [turned(i, tb) + X_SHIFT[i] - sum(ra[3 * i + m] * X_SHIFT[m] for m in range(3)) + F.when(wrong, F.lit(0.05)).otherwise(F.lit(0.0)) for i in range(3)]
    pairs = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 4).alias("g"), "c_custkey", *(F.array(*v).alias(n) for n, v in (("ra", ra), ("ta", ta), ("rb", rb), ("tb", tb))))
    found = handeye.hand_eye(pairs, "g", "c_custkey", rounds=3)
    return found.select("g", "n", "n_used", *(F.round(F.get("rx", F.lit(i)), 4).alias(f"r{i}") for i in range(9)), *(F.round(F.get("tx", F.lit(i)), 4).alias(f"t{i}") for i in range(3)))


_CODES = {
    "unknown_session_layout": ("error", "kind = 'unknown'", "0"), "missing_aligned_timesteps": ("warn", "kind = 'dual_realsense' and not aligned", "0"), "no_complete_visual_frames": ("error", "complete = 0", "0"),
    "visual_count_mismatch": ("warn", "most <> complete", "most - complete"), "frames_csv_count_mismatch": ("warn", "listed <> complete", "listed - complete"), "missing_frame_ids": ("warn", "missing > 0", "missing"),
    "zero_size_files": ("error", "empty > 0", "empty"), "known_incomplete_arm_view": ("info", "early", "0"),
}


@query(f"""with s as (select user_id, count(*) filter (event_type = 'view') as most, count(*) filter (event_type = 'view' and value >= 5) as complete, count(*) filter (event_type = 'click') as listed, count(*) filter (event_type = 'error') as missing,
    count(*) filter (value < 1) as empty, user_id % 5 = 1 as aligned, user_id % 4 = 2 as early, case user_id % 7 when 0 then 'unknown' when 1 then 'legacy_dji_realsense' else 'dual_realsense' end as kind from events group by 1)
    {" union all ".join(f"select user_id as session, '{c}' as code, '{v[0]}' as severity, ({v[2]})::bigint as found from s where {v[1]}" for c, v in _CODES.items())}""")
def session_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All session codes over counts by user."""
    kind = F.col("event_type")
    stats = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("session")).agg(
        F.count_if(kind == "view").alias("max_frames"), F.count_if((kind == "view") & (F.col("value") >= 5)).alias("complete_frames"), F.count_if(kind == "click").alias("frames_rows"),
        F.count_if(kind == "error").alias("missing_ids"), F.count_if(F.col("value") < 1).alias("zero_size"))
    layout = F.when(F.col("session") % 7 == 0, "unknown").when(F.col("session") % 7 == 1, "legacy_dji_realsense").otherwise("dual_realsense")
    stats = stats.withColumns({"has_aligned": F.col("session") % 5 == 1, "incomplete_arm_view": F.col("session") % 4 == 2, "data_format": layout})
    return rules.issues(stats, rules.SESSION_RULES, ["session"])
