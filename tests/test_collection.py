"""Whole-file cleaning, manifests, poses and sinks against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlake.functions import parse
from sessionlake.operators import clean, episodes, manifest, pose, pressure
from sessionlake.sources import sinks


def test_channels_are_checked_and_ordered():
    assert pressure.check_channels(["ts", "CH2", "note", "CH1"], ["CH1", "CH2"]) == ["ts", "note", "CH1", "CH2"]
    for header in (["ts", "CH1"], ["CH1", "CH2", "CH3"]):
        with pytest.raises(ValueError):
            pressure.check_channels(header, ["CH1", "CH2"])


def test_pressure_files_against_plain_python(spark):
    draw = random.Random(6)
    rows = [(s, k, None if s == 3 and k == 7 else draw.randrange(20), float(draw.randrange(9)), draw.choice([None, 1.0, 4.0]), float(draw.randrange(5))) for s in range(5) for k in range(30)]
    df = spark.createDataFrame(rows, "s long, arrival long, t long, a double, b double, bad double")
    cleaned = pressure.clean_files(df, "s", {"bad": ["a", "b"]})
    details = {r["s"]: r for r in pressure.clean_details(cleaned, "s", ["bad"]).collect()}
    for s in range(5):
        own = [r for r in rows if r[0] == s]
        times = [r[2] for r in own]
        upto = times[: times.index(None)] if None in times else times
        done = own if None in times else sorted(own, key=lambda r: r[2])
        new = [r[5] if r[4] is None else float(int((r[3] + r[4]) / 2)) for r in done]
        got = cleaned.filter(F.col("s") == s).orderBy("pos").collect()
        assert [(r["arrival"], r["bad"]) for r in got] == [(r[1], x) for r, x in zip(done, new)]
        changed = sum(x != r[5] for r, x in zip(done, new) if r[4] is not None)
        want = (30, sum(b < a for a, b in zip(upto, upto[1:])), sum(a[2] != b[2] for a, b in zip(own, done)), sum(r[4] is not None for r in own), changed, sum(r[4] is None for r in own))
        assert tuple(details[s][c] for c in ("rows", "timestamp_reversals", "rows_reordered", "rows_replaced", "rows_changed", "rows_failed")) == want


def test_sheet_names(spark):
    rows = spark.createDataFrame([("s", x) for x in ("s_004", "sheet_004", " 4 ", "other")], "split string, sheet string")
    assert [r[0] for r in rows.select(manifest.sheet_name(F.col("split"), F.col("sheet"))).collect()] == ["s_004", "s_004", "s_004", "other"]


def matrix(roll, pitch, yaw):
    r, p, y = map(math.radians, (roll, pitch, yaw))
    x = np.array([[1, 0, 0], [0, math.cos(r), -math.sin(r)], [0, math.sin(r), math.cos(r)]])
    q = np.array([[math.cos(p), 0, math.sin(p)], [0, 1, 0], [-math.sin(p), 0, math.cos(p)]])
    z = np.array([[math.cos(y), -math.sin(y), 0], [math.sin(y), math.cos(y), 0], [0, 0, 1]])
    return z @ q @ x


def test_poses_against_numpy(spark):
    draw = random.Random(8)
    angles = [tuple(draw.uniform(-180, 180) for _ in range(3)) for _ in range(40)] + [(180.0, 0.0, 0.0), (0.0, 180.0, 0.0), (0.0, 0.0, 180.0), (180.0, 0.0, 60.0), (0.0, 180.0, 60.0), (0.0, 0.0, 0.0)]
    rows = spark.createDataFrame([(k, *a) for k, a in enumerate(angles)], "k long, r double, p double, y double")
    turn = rows.select("k", *pose.named(pose.from_rpy_deg(F.col("r"), F.col("p"), F.col("y")), "m"))
    m = [F.col(f"m{i}") for i in range(9)]
    quats = turn.select("k", *m, *pose.named(pose.to_quaternion(m), "q"))
    both = quats.select("k", *m, *pose.named(pose.from_quaternion(*(F.col(f"q{i}") for i in range(4))), "b"), F.col("q0"))
    for r in both.collect():
        want = matrix(*angles[r["k"]])
        assert np.allclose([r[f"m{i}"] for i in range(9)], want.ravel(), atol=1e-12) and r["q0"] >= 0
        assert np.allclose([r[f"b{i}"] for i in range(9)], want.ravel(), atol=1e-6)
    t = [F.lit(1.0), F.lit(-2.0), F.lit(0.5)]
    unit = pose.composed((m, t), pose.inverted((m, t)))
    for r in turn.select(*pose.named(unit[0], "r"), *pose.named(unit[1], "t")).collect():
        assert np.allclose(list(r), [1, 0, 0, 0, 1, 0, 0, 0, 1, 0, 0, 0], atol=1e-12)


def test_positional_cells(spark):
    rows = spark.createDataFrame([(["1", "2", "x"],), (["1"],), (["4", "5", "6"],)], "c array<string>")
    got = rows.select(*parse.positional(F.col("c"), {"a": 0, "b": 2}, 2), parse.channels_of(F.col("c"), 1, 2).alias("n")).collect()
    assert [tuple(r) for r in got] == [(1.0, None, None), (None, None, None), (4.0, 6.0, [5, 6])]


def test_idle_and_pressed_tensors(spark):
    """A file of idle rows, then presses: the baseline is that of the head, values stay in 0 to 1, windows are whole."""
    rows = spark.range(60).select(F.lit(1).alias("session"), F.col("id").alias("t"), F.when(F.col("id") < 50, 2070.0).otherwise(2070.0 - 35.0 * (F.col("id") - 49)).alias("value"))
    deltas = clean.baseline_deltas(rows, ["session"], "t", 50).withColumn("level", clean.normalised(F.col("delta")))
    got = clean.windows(deltas, ["session"], "t", "level", 16, 4).orderBy("window_id").collect()
    assert len(got) == (60 - 16) // 4 + 1 and got[0]["tensor"] == [0.0] * 16
    assert np.allclose(got[-1]["tensor"][-10:], [0.01 * k for k in range(1, 11)])
    parts = [clean.windows(deltas.withColumn("session", F.lit(s)), ["session"], "t", "level", 16, 4) for s in (1, 2)]
    assert episodes.merged_windows(parts, ["session"]).count() == 2 * len(got)


def test_views_links_and_nested_episodes(spark, tmp_path):
    splits = [*manifest.SPLITS, "unknown"]
    df = spark.createDataFrame([(s, f"x{k}") for k, s in enumerate(splits)], "split string, session string")
    sinks.write_split_views(df, str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v/all_manifest")).count() == 5
    assert {r["split"] for r in spark.read.parquet(str(tmp_path / "v/splits")).collect()} == set(manifest.SPLITS)
    links = sinks.link_manifest(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "name string, target string"), spark.createDataFrame([("a", "1"), ("b", "9")], "name string, target string"), "name")
    assert {r["name"]: r["status"] for r in links.collect()} == {"a": "already", "b": "conflict", "c": "would_link"}
    steps = spark.range(6).select((F.col("id") % 2).alias("episode"), F.expr("id div 2").alias("step"), F.lit(1.0).alias("pose"), F.lit("go").alias("text"))
    sinks.write_nested_episodes(steps, str(tmp_path / "e"), "episode", ["pose"], ["text"])
    read = spark.read.parquet(str(tmp_path / "e/steps"))
    assert read.filter("is_first").count() == 2 and read.filter("is_last and observation.pose = 1").count() == 2
    sinks.write_sync_index(df, df.limit(1), str(tmp_path / "s"))
    sinks.write_sync_index(df.limit(0), df.limit(0), str(tmp_path / "s0"))
    assert spark.read.parquet(str(tmp_path / "s/sync_index")).count() == 5 and spark.read.parquet(str(tmp_path / "s0/sync_index")).columns == ["split"]
    sinks.write_csv_export(df, str(tmp_path / "c"), ["session", "split"])
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["session", "split"]
