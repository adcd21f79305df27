import bisect
import random

import numpy as np
from pyspark.sql import functions as F

from sessionlake.functions import parse
from sessionlake.operators import asof, clean, geometry, rules, stats, trajectory
from sessionlake.sources import recordings, sinks


def nearest_model(t, times):
    if not times:
        return -1
    at = bisect.bisect_left(times, t)
    candidates = [i for i in (at - 1, at) if 0 <= i < len(times)]
    return min(candidates, key=lambda i: abs(times[i] - t))


def test_nearest_is_bisect(spark):
    draw = random.Random(4)
    frames, samples, wanted = [], [], {}
    for s in range(60):
        times = sorted(draw.randrange(40) for _ in range(draw.choice([0, 1, 5, 12])))
        samples += [(s, t, i, float(t), 1) for i, t in enumerate(times)]
        for k in range(10):
            t = draw.randrange(-3, 44)
            frames.append((s, t, k))
            wanted[s, k] = nearest_model(t, times)
    f = spark.createDataFrame(frames, "session long, t long, row_index long")
    g = spark.createDataFrame(samples, "session long, t long, row_index long, value double, code long")
    got = asof.brackets(f, {"g": g}).select("session", "row_index", *asof.nearest_columns("g", 5)).collect()
    assert {(r["session"], r["row_index"]): r["g_index"] for r in got} == wanted


def test_interpolation_edges(spark):
    f = spark.createDataFrame([(1, 0, 0), (1, 5, 1), (1, 10, 2), (1, 99, 3), (2, 5, 0)], "session long, t long, row_index long")
    g = spark.createDataFrame([(1, 0, 0, 1.0, 7), (1, 10, 1, 3.0, 8)], "session long, t long, row_index long, value double, code long")
    rows = asof.brackets(f, {"g": g}).select("session", "row_index", asof.interpolated("g").alias("v")).orderBy("session", "row_index").collect()
    assert [r["v"] for r in rows] == [1.0, 2.0, 3.0, 3.0, None]


def test_fill_and_dedupe(spark):
    rows = spark.createDataFrame([(1, i, c) for i, c in enumerate(["", "a", "", "b", None])] + [(2, 0, "")], "session long, arrival long, cell string")
    got = clean.fill(rows, "session", ["cell"]).orderBy("session", "arrival").collect()
    assert [r["cell"] for r in got] == ["a", "a", "a", "b", "b", None]
    assert clean.dedupe_first(rows, ["session"]).count() == 2


def test_tensor_windows_are_continuous(spark):
    rows = spark.range(20).select(F.lit(1).alias("session"), F.col("id").alias("t"), F.col("id").cast("double").alias("value"))
    got = clean.windows(rows, ["session"], "t", "value").orderBy("window_id").collect()
    assert [r["tensor"] for r in got] == [[float(i + k) for k in range(16)] for i in range(5)]
    assert [(r["start_t"], r["end_t"], r["center_t"]) for r in got[:1]] == [(0, 15, 7)]
    assert clean.windows(rows.filter("t < 15"), ["session"], "t", "value").count() == 0


def test_floor_percentile(spark):
    rows = spark.range(1, 21).select(F.lit(1).alias("s"), F.col("id").cast("double").alias("offset_ms"))
    assert stats.offset_quality(rows, "s").first()["p95_ms"] == 20.0


def test_repair_modes(spark):
    one = spark.createDataFrame([(9.0, 1.0, None, 4.0), (9.0, 1.0, 2.0, 5.0)], "x double, a double, b double, c double")
    n = [F.col(c) for c in "abc"]
    got = one.select(*(clean.repaired(F.col("x"), n, m).alias(m) for m in ("clean", "display", "tensor"))).collect()
    assert [tuple(r) for r in got] == [(9.0, 2.0, None), (2.0, 2.0, 8 / 3)]


def test_parsing(spark):
    cells = spark.createDataFrame([("",), ("2.7",), ("-2.7",), ("nan",), ("Infinity",), (None,)], "c string")
    assert [r[0] for r in cells.select(parse.safe_int(F.col("c"))).collect()] == [None, 2, -2, None, None, None]
    assert [r[0] for r in cells.select(parse.is_blank(F.col("c"))).collect()] == [True, False, False, True, False, True]


def test_clock_debounce_spans(spark):
    rows = spark.createDataFrame([(1, i, t) for i, t in enumerate([5, 5, 4, 9, 9])], "s long, n long, t long")
    assert [r["clock"] for r in trajectory.monotonic_clock(rows, "s", "n").orderBy("n").collect()] == [5, 6, 7, 9, 10]
    d = trajectory.debounce(rows.withColumn("ok", F.col("t") < 9), "s", "n", "ok", 2).orderBy("n").collect()
    assert [(r["streak"], r["paused"]) for r in d] == [(1, False), (2, True), (3, True), (0, False), (0, False)]
    assert [(r["phase"], r["n"]) for r in trajectory.phase_spans(rows, "s", "n", "t").orderBy("span").collect()] == [(5, 2), (4, 1), (9, 2)]


def test_session_rules(spark):
    row = spark.createDataFrame([("a", "unknown", False, 0, 3, 2, 1, 0, True)], "session string, data_format string, has_aligned boolean, complete_frames int, max_frames int, frames_rows int, missing_ids int, zero_size int, incomplete_arm_view boolean")
    codes = {r["code"] for r in rules.issues(row, rules.SESSION_RULES, ["session"]).collect()}
    assert codes == {"unknown_session_layout", "no_complete_visual_frames", "visual_count_mismatch", "frames_csv_count_mismatch", "missing_frame_ids", "known_incomplete_arm_view"}


def test_quaternion(spark):
    v = geometry.quat_to_rotvec(F.lit(-1.0), F.lit(0.0), F.lit(0.0), F.lit(-1.0))
    got = spark.range(1).select(*v).first()
    assert np.allclose(tuple(got), (0, 0, np.pi / 2))


def test_recordings(spark, tmp_path):
    root = tmp_path / "data" / "session_20260615_101500"
    for folder in ("world_camera", "wrist_camera"):
        (root / folder).mkdir(parents=True)
        (root / folder / "0001.jpg").write_bytes(b"x")
    (root / "wrist_camera" / "0002.jpg").write_bytes(b"")
    (root / "robot.csv").write_text("timestamp_us,x,y\n10,1,2\n\n20,3\nbad,5,6\n")
    (root / "gripper.csv").write_text("timestamp_us,y,x\n10,2,1\n")
    (root / "empty.csv").write_text("")
    (root / "meta.json").write_text('{"fps": 30}')
    (root / "broken.json").write_text("{")
    np.savez(root / "tensor.npz", data=np.arange(6.0).reshape(2, 3), center=np.array([5, 6]))
    base = str(tmp_path / "data")
    cells = recordings.read_csv_cells(spark, base)
    got = {(r["path"].rsplit("/", 1)[1], r["row_index"]): (r["cells"]["x"], r["cells"]["y"]) for r in cells.collect()}
    assert got == {("robot.csv", 0): ("1", "2"), ("robot.csv", 1): ("3", ""), ("robot.csv", 2): ("5", "6"), ("gripper.csv", 0): ("1", "2")}
    assert sorted(r["t"] for r in recordings.timestamps(cells, ["timestamp_us"]).collect()) == [10, 10, 20]
    assert sorted((r["n_rows"], r["path"].rsplit("/", 1)[1]) for r in recordings.csv_headers(spark, base).collect()) == [(0, "empty.csv"), (1, "gripper.csv"), (3, "robot.csv")]
    files = recordings.listing(spark, base)
    found = recordings.discover(files).first()
    assert (found["session"], found["data_format"], found["zero_size"], found["date"]) == ("session_20260615_101500", "dual_realsense", 2, "20260615")
    assert recordings.image_stems(files).count() == 3
    meta = {r["path"].rsplit("/", 1)[1]: (r["value"] and r["value"]["fps"], r["bad"]) for r in recordings.read_json(spark, base, "fps int").collect()}
    assert meta["meta.json"] == (30, False) and meta["broken.json"][1]
    rows = recordings.read_npz(spark, base, {"data": "array<double>", "center": "long", "none": "double"}).orderBy("i").collect()
    assert [(r["data"], r["center"], r["none"]) for r in rows] == [([0.0, 1.0, 2.0], 5, None), ([3.0, 4.0, 5.0], 6, None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "train"), ("a", 2, "train"), ("b", 1, "unknown")], "session string, updated int, split string")
    assert sinks.write_version(df, str(tmp_path / "v"), apply=False) is None
    assert spark.read.parquet(sinks.write_version(df, str(tmp_path / "v"))).count() == 3
    sinks.write_split_views(df, str(tmp_path / "s"), splits=("train", "val", "test"))
    assert spark.read.parquet(str(tmp_path / "s" / "splits")).count() == 2
    assert {(r["session"], r["updated"]) for r in sinks.latest(df, "session", "updated").collect()} == {("a", 2), ("b", 1)}
    sinks.write_reports(df, df, df, str(tmp_path / "r"))
    sinks.write_episodes(df.withColumn("step", F.col("updated")), str(tmp_path / "e"), "session", ["split"])
    assert spark.read.parquet(str(tmp_path / "e" / "episodes")).count() == 2
