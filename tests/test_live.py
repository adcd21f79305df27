"""Streams put in order, live alignment, packets, as-of brackets by cells and exact percentiles, against plain Python."""

import random
import zlib
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sessionlake.operators import asof, stats
from sessionlake.sources import packets
from sessionlake.streaming import operators as streaming
from sessionlake.streaming import ordered
from tests.compare import rows_of

SAMPLE = "session string, t long, row_index long, value double, code long"


def sessions(seed, spark, n=400):
    draw = random.Random(seed)
    rows = [(draw.choice(["a", "a", "a", "b", None]), draw.randrange(-500, 3000), k, float(draw.randrange(9)), draw.randrange(5)) for k in range(n)]
    return spark.createDataFrame(rows, SAMPLE)


@pytest.mark.parametrize("cell", [1, 7, 100, 10_000])
def test_brackets_by_cells_equal_brackets(spark, cell, monkeypatch):
    monkeypatch.setattr(asof, "FAN_BITS", 2)
    frames, streams = sessions(1, spark), {"robot": sessions(2, spark, 90), "none": sessions(3, spark).filter("false")}
    want = asof.brackets(frames, streams)
    got = asof.bucketed_brackets(frames, streams, cell).select(want.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.collect())


def test_one_long_session_is_spread_over_tasks(spark):
    n = 1_000_000
    rows = spark.range(n).select(F.lit("one").alias("session"), (F.col("id") * 1000).alias("t"), F.col("id").alias("row_index"), F.col("id").cast("double").alias("value"), F.col("id").alias("code"))
    frames = rows.filter("row_index % 3 = 0")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = asof.bucketed_brackets(frames, {"robot": rows.filter("row_index % 5 = 1")}, 10_000_000)
        by_task = got.select(asof.nearest("robot")["row_index"].alias("i"), "row_index", F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n"), F.sum(F.abs(F.col("i") - F.col("row_index"))).alias("d")).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    sizes = [r["n"] for r in by_task]
    assert sum(sizes) == -(-n // 3) and len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    assert sum(r["d"] for r in by_task) == sum(min(abs(k - m) for m in (k - (k - 1) % 5, k - (k - 1) % 5 + 5) if 0 <= m < n) for k in range(0, n, 3))


def test_window_groups_of_cells_are_small(spark):
    plan = asof.bucketed_brackets(sessions(1, spark), {"robot": sessions(2, spark)}, 100)._jdf.queryExecution().optimizedPlan().toString()
    parts = [line for line in plan.splitlines() if "Window [" in line and "last(robot#" in line]
    assert parts and all("cell" in line for line in parts)


@pytest.mark.parametrize(("sorted_", "ranges"), [(4096, 1024), (3, 4)])
def test_floor_percentile_is_exact(spark, sorted_, ranges, monkeypatch):
    monkeypatch.setattr(stats, "SORTED", sorted_)
    monkeypatch.setattr(stats, "RANGES", ranges)
    draw = random.Random(5)
    groups = {"ties": [1.0] * 50 + [2.0] * 3, "one": [4.0], "wide": [10.0 ** draw.randrange(-200, 200) for _ in range(80)], "many": [draw.gauss(0, 3) for _ in range(900)], "twenty": [float(k) for k in range(1, 21)]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("many", None), ("many", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    for share in (0.0, 0.5, 0.95, 1.0):
        got = {r["g"]: r["v"] for r in stats.floor_percentile(df, "g", "v", share).collect()}
        assert got == {g: sorted(v)[min(len(v) - 1, int(len(v) * share))] for g, v in groups.items()}
    assert stats.floor_percentile(df.limit(0), "g", "v", 0.5).count() == 0


T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)


def _fed(spark, tmp_path, parts, build, late="1 hour"):
    """Feed files one run after the other, all from one checkpoint, then close; rows (key, minutes, row_index, t)."""
    folder = str(tmp_path / "in")
    kind = "ts timestamp, session string, row_index long, t long"
    spark.createDataFrame([], kind).write.parquet(folder)
    like = spark.read.parquet(folder)
    stream = ordered.with_marks(streaming.read_folder(spark, like, folder), str(tmp_path / "marks"))
    timed = streaming.with_event_time(stream, late=late)
    run = ordered.Run(build(timed), str(tmp_path))
    for part in parts:
        rows = [(T0 + timedelta(minutes=m), k, i, t) for k, m, i, t in part]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(folder)
        run.go()
    ordered.mark(like, str(tmp_path / "marks"), "2100-01-01 00:00:00")
    return run.go().collect()


def test_strict_clock_over_restarts_and_disorder(spark, tmp_path):
    parts = [[("a", 5, 2, 9), ("a", 1, 1, 5), ("b", 3, 7, 5)], [("a", 2, 3, 5), ("a", 2, 4, 2), ("b", 3, 8, 5)], [("a", 90, 5, 1), ("a", 40, 6, 50), (None, 5, 9, 3)]]
    got = _fed(spark, tmp_path, parts, lambda s: ordered.strict_clock(s, "session"))
    want = {}
    last = {}
    for k, _, i, t in sorted((r for p in parts for r in p), key=lambda r: (r[0] or "", r[1], r[2])):
        last[k] = t if k not in last else max(t, last[k] + 1)
        want[k, i] = last[k]
    assert {(r["session"], r["row_index"]): r["clock"] for r in got} == want and len(got) == len(want)


def test_batches_end_by_size_and_idle_time(spark, tmp_path):
    parts = [[("a", m, m, 1) for m in (0, 1, 2, 3, 4)], [("a", 30, 30, 1), ("a", 31, 31, 1)], [("a", 200, 200, 1), ("b", 200, 1, 7)]]
    got = _fed(spark, tmp_path, parts, lambda s: ordered.batches(s, "session", 3, 10 * 60_000_000), late="5 minutes")
    minute = lambda us: (us - int(T0.timestamp() * 1_000_000)) // 60_000_000
    assert sorted((r["session"], minute(r["start_us"]), minute(r["end_us"]), r["n"], r["total"]) for r in got) == [("a", 0, 2, 3, 3), ("a", 3, 4, 2, 2), ("a", 30, 31, 2, 2), ("a", 200, 200, 1, 1), ("b", 200, 200, 1, 7)]


def test_packets_survive_splits_noise_and_short_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packets, "SPLIT", 500)
    draw = random.Random(2)
    folder = tmp_path / "p"
    folder.mkdir()
    good = [(k, [draw.randrange(-32768, 32768) for _ in range(64)]) for k in range(60)]
    data = b"noise" + packets.MARK
    for k, channels in good:
        data += packets.framed(packets.PACKET.pack(k, *channels)) + (packets.MARK if k % 7 == 0 else b"") + (packets.framed(b"short") if k % 5 == 0 else b"")
    broken = bytearray(packets.framed(packets.PACKET.pack(999, *good[0][1])))
    broken[20] ^= 1
    (folder / "a.pkt").write_bytes(data + bytes(broken))
    (folder / "b.txt").write_bytes(data)
    found = [p for r in packets.Batch(str(folder)).partitions() for p in packets.read_range(r)]
    assert found == good


def test_packet_stream_reads_each_once_while_a_file_grows(spark, tmp_path):
    spark.dataSource.register(packets.Packets)
    folder = tmp_path / "p"
    folder.mkdir()
    whole = [packets.framed(packets.PACKET.pack(k, *range(64))) for k in range(9)]
    run = ordered.Run(spark.readStream.format("packets").option("path", str(folder)).load(), str(tmp_path))
    seen = []
    for upto, torn in ((3, 10), (3, 30), (6, 1), (9, 0)):  # a record is being written while the stream reads
        (folder / "a.pkt").write_bytes(b"".join(whole[:upto]) + (whole[upto][:torn] if torn else b""))
        seen.append(sorted(r["sensor_timestamp_us"] for r in run.go().collect()))
    assert seen == [[0, 1, 2], [0, 1, 2], list(range(6)), list(range(9))]


def test_packet_sink_commits_whole_files(spark, tmp_path):
    spark.dataSource.register(packets.Packets)
    rows = spark.range(100).select(F.col("id").alias("sensor_timestamp_us"), F.transform(F.sequence(F.lit(1), F.lit(64)), lambda c: (c + F.col("id")).cast("int")).alias("channels"))
    rows.repartition(3).write.format("packets").option("path", str(tmp_path / "p")).mode("append").save()
    assert all(f.name.endswith(".pkt") for f in (tmp_path / "p").iterdir())
    back = spark.read.format("packets").option("path", str(tmp_path / "p")).load()
    assert rows_of(back.columns, back.collect()) == rows_of(rows.columns, rows.collect())
    bad = rows.withColumn("channels", F.when(F.col("sensor_timestamp_us") < 90, F.col("channels")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception):
        bad.repartition(3).write.format("packets").option("path", str(tmp_path / "p")).mode("append").save()
    assert back.count() == 100 and zlib.crc32(b"") == 0
