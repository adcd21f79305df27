"""Quoted CSV by splits, archives, versions, folders, roots and calibration, against plain Python and numpy."""

import csv
import io
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlake.operators import clean, geometry, handeye, manifest, rules, stats
from sessionlake.sources import quoted_csv, recordings, sinks, tables, tensors, versions
from sessionlake.streaming import operators as streaming
from tests.compare import rows_of


def test_line_functions_compose():
    draw = random.Random(3)
    for _ in range(400):
        text = "".join(draw.choice(['"', '""', ",", "a", "\n", '"x,y"', " "]) for _ in range(draw.randrange(12)))
        ends = [quoted_csv.line_function(x) for x in text.split("\n")]
        state = 0
        for f in ends:
            state = {quoted_csv.SAME: state, quoted_csv.OTHER: 1 - state, quoted_csv.START: 0, quoted_csv.QUOTE: 1}[f]
        whole = list(csv.reader(io.StringIO(text + "\n", newline="")))
        closed = list(csv.reader(io.StringIO(text + "\nnext", newline="")))
        assert (state == 0) == (closed[len(whole) :] == [["next"]] or closed[-1] == ["next"])


@pytest.mark.parametrize("size", ["40", "1000", "1000000"])
def test_quoted_csv_equals_csv_module(spark, tmp_path, size):
    draw = random.Random(int(size))
    cells = ["a", "", 'say "hi"', "two\nlines", "x,y", "\r\nmixed\r\n", '"', "é 日", " pad ", 'in"side']
    files = {}
    for name, end in (("one.csv", "\n"), ("two.csv", "\r\n")):
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["k", " name ", "v"])
        for k in range(60):
            writer.writerow([k, draw.choice(cells), draw.choice(cells)][: draw.choice([1, 2, 3, 3, 3])])
            if k % 9 == 0:
                out.write(end)
        files[name] = "﻿" * (name == "two.csv") + out.getvalue()
    files["raw.csv"] = 'k,name\n1,in"side,more\n2,"closed" tail\n\n3,"open\nto the end'
    files["empty.csv"] = ""
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        if size == "40":
            assert spark.read.option("lineSep", "\n").text(str(tmp_path / "one.csv")).rdd.getNumPartitions() > 8
        got = quoted_csv.read_quoted_csv(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = []
    for name, text in files.items():
        rows = [r for r in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")) if r]
        for k, r in enumerate(rows[1:]):
            header = [h.strip() for h in rows[0]]
            want.append((name, k, {h: (r[i] if i < len(r) else "") for i, h in enumerate(header)}))
    order = lambda r: (r[0], r[1])
    assert sorted(((r["path"].rsplit("/", 1)[1], r["row_index"], r["cells"]) for r in got), key=order) == sorted(want, key=order)


def test_records_within_a_split_are_cut_by_the_task_that_reads_it(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    lines = [("f", 0, ["k,v", '1,"a, b"', "", '2,"open']), ("f", 40, ["still", 'end",x', "3,y"])]
    states = {("f", 0): (0, 0), ("f", 40): (1, 3)}
    batches = [pa.RecordBatch.from_pylist([{"path": p, "split": s, "entry": states[p, s][0], "records": states[p, s][1], "line": x} for x in ls]) for p, s, ls in lines]
    got = [(r["record"], r["text"], r["row"]) for b in quoted_csv._cut(iter(batches)) for r in b.to_pylist()]
    assert got == [(0, None, ["k", "v"]), (1, None, ["1", "a, b"]), (2, '2,"open', None), (2, 'still\nend",x', None), (3, None, ["3", "y"])]
    assert [tuple(r.values()) for b in quoted_csv._functions(b.select(["path", "split", "line"]) for b in batches) for r in b.to_pylist()] == [("f", 0, 1, 1, 3, 1), ("f", 40, 0, 0, 3, 1)]
    monkeypatch.setattr(quoted_csv, "BROADCAST_SPLITS", 0)  # the states of very many splits are joined by a shuffle
    monkeypatch.setattr(quoted_csv, "CSV_LIMIT", 3)
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("a,b\n" + "".join(f'{i},"{i}\n{k}"\n' for i in range(50)))
    found = quoted_csv.read_quoted_csv(spark, str(tmp_path)).collect()
    assert sorted((r["path"][-5], r["row_index"], r["cells"]["b"]) for r in found) == sorted((str(k), i, f"{i}\n{k}") for k in range(3) for i in range(50))


def _tensors(spark, n=6):
    return spark.range(n * 5).select(F.concat(F.lit("s/ _"), (F.col("id") % n).cast("string")).alias("session"), F.col("id").alias("window_id"), *(F.col("id").alias(c) for c in ("start_us", "end_us", "center_us")), F.array(F.array(F.col("id") * 0.5, F.lit(1.0))).alias("tensor"))


def test_tensor_archives_round_trip_and_prune(spark, tmp_path, monkeypatch):
    spark.dataSource.register(tensors.Tensors)
    monkeypatch.setattr(tensors, "WINDOWS", 2)
    folder = str(tmp_path / "t")
    rows = _tensors(spark)
    rows.repartition(2, "session").sortWithinPartitions("session", "window_id").write.format("tensors").option("path", folder).mode("append").save()
    back = spark.read.format("tensors").option("path", folder).load()
    assert rows_of(back.columns, back.collect()) == rows_of(rows.columns, rows.collect())
    reader = tensors.PruningReader(folder)
    left = list(reader.pushFilters([tensors.EqualTo(("session",), "s/ _3"), tensors.EqualTo(("window_id",), 3)]))
    assert [f.attribute for f in left] == [("window_id",)] and {p.session for p in reader.partitions()} == {"s/ _3"} and len(reader.partitions()) < len(tensors.TensorReader(folder).partitions()) / 3
    one = tensors.load(spark, folder).filter("session = 's/ _3' and window_id > 5")
    assert sorted(r["window_id"] for r in one.collect()) == [9, 15, 21, 27]
    assert one.rdd.getNumPartitions() < 6


def test_tensor_write_that_fails_leaves_nothing_to_read(spark, tmp_path):
    spark.dataSource.register(tensors.Tensors)
    folder = str(tmp_path / "t")
    rows = _tensors(spark)
    rows.write.format("tensors").option("path", folder).mode("append").save()
    bad = rows.withColumn("start_us", F.when(F.col("window_id") < 25, F.col("start_us")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception):
        bad.repartition(4).write.format("tensors").option("path", folder).mode("append").save()
    assert spark.read.format("tensors").option("path", folder).load().count() == 30


def test_two_writers_and_one_loses(spark, tmp_path):
    folder = str(tmp_path / "v")
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(1).alias("u"))
    assert versions.current(spark, folder) == 0
    assert versions.write(rows.repartitionByRange(5, "k"), folder) == 1
    change = lambda v, where: rows.filter(where).select("k", F.lit(v).alias("v"), F.lit(2).alias("u"))
    assert versions.upsert(change("b", "k < 10"), folder, "k", "u") == 2
    with pytest.raises(versions.Conflict):
        versions.upsert(change("c", "k > 90"), folder, "k", "u", base=1)
    assert {r["v"]: r["n"] for r in versions.read(spark, folder).groupBy("v").agg(F.count("*").alias("n")).collect()} == {"a": 90, "b": 10}
    assert versions.read(spark, folder, 1).filter("v = 'a'").count() == 100
    kept = set(versions.files(spark, folder, 1)) & set(versions.files(spark, folder, 2))
    assert len(kept) == 4
    assert versions.upsert(change("c", "k > 90"), folder, "k", "u") == 3
    assert versions.upsert(rows.filter("false"), folder, "k", "u") == 4 and versions.read(spark, folder).count() == 100
    assert not [f for f in os.listdir(f"{folder}/_versions") if f.startswith("_")]


def test_scan_by_levels_with_links(spark, tmp_path):
    base = tmp_path / "data"
    deep = base
    for k in range(6):
        deep = deep / f"session_20260101_00000{k}"
        deep.mkdir(parents=True)
        (deep / "f.csv").write_text("x" * k)
    for k in range(20):
        (base / f"wide{k}").mkdir()
        (base / f"wide{k}" / "g.txt").write_text("y")
    (deep / "up").symlink_to(base)
    (base / "again").symlink_to(base / "wide3")
    got = recordings.scan(spark, str(base)).collect()
    assert sorted(r["path"] for r in got) == sorted(str(p) for p in base.rglob("*") if p.is_file() and "again" not in p.parts and "up" not in p.parts)
    assert recordings.scan(spark, str(base), "*.csv").count() == 6 and {r["length"] for r in got if r["path"].endswith("csv")} == set(range(6))


def test_mapped_roots(spark):
    paths = spark.createDataFrame([(1, "/a/b/c"), (2, "/a/bc/d/"), (3, "/x/y"), (4, None), (5, "/a/b"), (6, "rel/z")], "k long, path string")
    roots = spark.createDataFrame([("/a",), ("/a/b/",), ("/a/b",), (None,), ("rel",), ("/q",)], "root string")
    got = {r["k"]: r["root"] for r in manifest.mapped_roots(paths, "k", "path", roots, "root").collect()}
    assert got == {1: "/a/b", 2: "/a", 3: "/x", 4: None, 5: "/a/b", 6: "rel"}


def _rotation(draw):
    q = draw.normal(size=4)
    w, x, y, z = q / np.linalg.norm(q)
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])


def test_hand_eye_against_numpy(spark):
    draw = np.random.default_rng(4)
    rows, planted = [], {}
    for g in ("p", "q", None):
        x, t = _rotation(draw), draw.normal(size=3)
        planted[g] = x, t
        for k in range(30):
            rb, tb = _rotation(draw), draw.normal(size=3)
            ra = x @ rb @ x.T
            ta = x @ tb + t - ra @ t + (draw.normal(size=3) if g and k % 10 == 3 else 0)
            rows.append((g, k, ra.reshape(-1).tolist(), ta.tolist(), rb.reshape(-1).tolist(), tb.tolist()))
    df = spark.createDataFrame(rows, "g string, k long, ra array<double>, ta array<double>, rb array<double>, tb array<double>").repartition(5)
    clean = {r["g"]: r for r in handeye.solve(df.filter("g is null"), "g").collect()}
    assert np.allclose(clean[None]["rx"], planted[None][0].reshape(-1), atol=1e-9) and np.allclose(clean[None]["tx"], planted[None][1], atol=1e-9)
    for r in handeye.hand_eye(df.filter("g is not null"), "g", "k", rounds=3).collect():
        x, t = planted[r["g"]]
        assert (r["n"], r["n_used"]) == (30, 24) and np.allclose(r["rx"], x.reshape(-1), atol=1e-6) and np.allclose(r["tx"], t, atol=1e-6)


def test_typed_cells_and_manifest_pair(spark, tmp_path):
    (tmp_path / "f.csv").write_text('step,phase,phase_name,finger1_fx\n1,0,"a,b",2.5\nx,1.9,,nan\n')
    got = tables.read_table(spark, str(tmp_path), tables.FORCES).orderBy("row_index").collect()
    assert [(r["step"], r["phase"], r["phase_name"], r["finger1_fx"], r["finger2_fz"]) for r in got] == [(1, 0, "a,b", 2.5, None), (None, 1, "", None, None)]
    row = {c: (f'n"{k},\nx' if c == "notes" else str(k)) for k, c in enumerate(manifest.COLUMNS)}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    tables.write_manifest(df.withColumn("more", F.lit(1)), str(tmp_path / "m"))
    back = tables.read_table(spark, str(tmp_path / "m" / "manifest_csv"), tables.MANIFEST).drop("path", "row_index").collect()
    assert [r["notes"] for r in back] == [row["notes"]] and back[0]["pressure_hz"] == float(row["pressure_hz"])
    assert spark.read.json(str(tmp_path / "m" / "manifest_json")).first()["notes"] == row["notes"]


def test_channel_mapping_and_aligned_repair(spark):
    text = '{"LEFT_CHANNEL": 5, "RIGHT_CHANNEL": 6, "LEFT_MATRIX_CHANNELS": [[1, 2]], "RIGHT_MATRIX_CHANNELS": [[3]], "INTERPOLATE_CHANNELS": {"2": [1, 3], "9": [1]}}'
    ch = tables.Channels.parse(text)
    assert ch.order == (5, 6, 1, 2, 3) and [r["neighbours"] for r in ch.table(spark).orderBy("place").collect()] == [[], [], [], [1, 3], []]
    rows = spark.createDataFrame([(7, 10.0, 2.0, 3.0), (8, 10.0, None, 3.0), (9, 10.0, -2.0, -3.0)], "k int, pressure_CH2 double, pressure_CH1 double, pressure_CH3 double")
    assert [r["pressure_CH2"] for r in tables.repaired_aligned(rows, ch).orderBy("k").collect()] == [2.0, 10.0, -2.0]
    one = spark.range(1).select(*(ch.value(F.array(*map(F.lit, (50, 60, 10))), F.lit(c), -1).alias(f"c{c}") for c in (5, 1, 2, 77))).first()
    assert tuple(one) == (50, 10, -1, -1)


def test_bands_at_their_limits(spark):
    at = lambda *c: spark.range(1).select(*c).first()
    assert tuple(at(*(rules.status("camera_hz", F.lit(v)) for v in (27.0, 26.9, 20.0, 19.9)), rules.status("robot_hz", F.lit(1.0)))) == ("good", "fair", "fair", "poor", "fair")
    assert tuple(at(*(rules.error_status("hand_eye", F.lit(a), F.lit(b)) for a, b in ((1.9, 9.9), (2.0, 9.9), (4.9, 29.0), (4.9, 30.0)))))  == ("good", "fair", "fair", "poor")


def test_losses_against_numpy(spark):
    draw = np.random.default_rng(2)
    point, patch = draw.normal(size=(9, 4)), draw.normal(size=(5, 4))
    at = [int(k) for k in draw.integers(0, 5, 9)]
    unit = lambda m: m / np.linalg.norm(m, axis=-1, keepdims=True)
    good = [k for k in range(9) if k % 4]
    logits = unit(point[good]) @ unit(patch[[at[k] for k in good]]).T / 0.07
    ce = lambda x, want: np.mean(np.log(np.exp(x - x.max(1, keepdims=True)).sum(1)) + x.max(1) - x[np.arange(len(x)), want])
    own = np.arange(len(good))
    points = spark.createDataFrame([("b", k, at[k], point[k].tolist()) for k in range(9)], "b string, i long, patch long, f array<double>")
    patches = spark.createDataFrame([("b", k, patch[k].tolist()) for k in range(5)], "b string, patch long, f array<double>")
    got = geometry.gathered_info_nce(points, patches, "b", "i", "patch", "f", F.col("i") % 4 != 0).first()
    assert got["n"] == len(good) and got["loss"] == pytest.approx((ce(logits, own) + ce(logits.T, own)) / 2)
    anchors = points.withColumn("point", F.col("i") % 5)
    numbered = patches.withColumnRenamed("patch", "k")
    got = geometry.tactile_info_nce(anchors, numbered, numbered, "b", "i", "f", "k").first()
    all_logits = unit(point) @ unit(patch).T / 0.07
    assert got["loss"] == pytest.approx((ce(all_logits, [k % 5 for k in range(9)]) + ce(all_logits, at)) / 2)


def test_audits_and_pose_log(spark, tmp_path):
    rows = spark.createDataFrame([("a", 60.0, None), ("a", -3.0, -70.0), ("a", None, None), ("b", 1.0, 2.0)], "s string, x double, y double")
    assert {r["s"]: tuple(r)[1:] for r in stats.offset_audit(rows, "s", ["x", "y"]).collect()} == {"a": (2, 70.0, 2), "b": (1, 2.0, 0)}
    cells = spark.createDataFrame([("m", "", True), ("m", "x", True), ("m", "", False), ("m", "5", True)], "m string, c string, t boolean")
    assert tuple(stats.null_audit(cells, ["m"], F.col("c"), F.col("t")).first()) == ("m", 4, 4)
    poses = spark.createDataFrame([("s1", 2, [0.0], [1.0], "w"), ("s1", 1, [0.5], [2.0], "a")], "session string, t long, joints array<double>, pose array<double>, key string")
    tables.write_pose_log(poses, str(tmp_path / "p"))
    assert [r["key"] for r in spark.read.json(str(tmp_path / "p" / "session=s1")).orderBy("t").collect()] == ["a", "w"]


def test_report_is_one_text_in_order(spark, tmp_path):
    facts = spark.createDataFrame([(0, "Sessions", 3)], "place int, name string, value long")
    counters = spark.createDataFrame([("By kind", f"k{k:02}", k) for k in range(30)], "section string, key string, n long")
    kinds = spark.createDataFrame([("robot", 1, None)], "modality string, sessions long, hz double")
    samples = spark.createDataFrame([(0, "warn", "s", "robot", "code", 4)], "place int, severity string, session string, modality string, code string, found long")
    tables.write_lines(tables.summary_lines("Audit", facts, counters, kinds, samples), str(tmp_path / "r"))
    lines = next((tmp_path / "r").glob("part-*")).read_text().splitlines()
    assert lines[:4] == ["# Audit", "- Sessions: 3", "## By kind", "- k29: 29"] and lines[22:] == ["- k10: 10", "## Modality summary", "| modality | sessions | hz |", "|---|---:|---:|", "| robot | 1 |  |", "- [warn] s robot code: 4"]


def test_tensor_table_and_live_appends(spark, tmp_path):
    rows = spark.range(40).select((F.col("id") % 2).alias("session"), F.col("id").alias("t"), F.col("id").cast("double").alias("value"))
    sinks.write_tensors(clean.windows(rows, ["session"], "t", "value"), str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w" / "windows")).count() == 10
    rows.write.parquet(str(tmp_path / "in"))
    stream = streaming.read_folder(spark, rows, str(tmp_path / "in"))
    query = streaming.write_versions(stream, str(tmp_path / "out"), str(tmp_path / "c"))
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40
