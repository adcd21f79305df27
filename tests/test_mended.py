"""Cases that failed before: sheets of one id, rows that arrive at once, sources that moved row by row."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sessionlake.operators import clean, manifest, stats, trajectory
from sessionlake.sources import packets, tensors


def test_sheets_of_one_id_have_all_their_rows(spark):
    sessions = spark.createDataFrame([("s", f"a{k}", "", "") for k in range(4)], "split string, session string, date string, time string")
    sheets = spark.createDataFrame([("s", "s_100", "a0", "a1", 2), ("s", "s_100", "a2", "a3", 2)], "split string, sheet_id string, start_session string, end_session string, session_count int")
    got = manifest.sheet_sessions(sessions, sheets).collect()
    assert sorted(r["session"] for r in got if r["ok"]) == ["a2", "a3"]  # the greatest last session of the id's sheets, as in the SQL


def test_rows_that_arrive_at_once_keep_their_order(spark):
    # every two rows arrive at once; t falls within each pair by row_index
    rows = [(1, k, k // 2, 10 * (k // 2) + 5 - k % 2, "" if k % 2 else str(k)) for k in range(40)]
    for order in (rows, rows[::-1]):
        stream = spark.createDataFrame(order, "session long, row_index long, arrival long, t long, cell string").coalesce(1)
        assert stats.deltas(stream, ["session"]).filter("delta < 0").count() == 20
        assert stats.timing_checker(stream, ["session"]).first()["duration_us"] == 189
        assert stats.reordered(stream, "session").first()["rows_reordered"] == 40
        filled = {r["row_index"]: r["cell"] for r in clean.fill(stream, "session", ["cell"]).collect()}
        assert filled == {k: str(k - k % 2) for k in range(40)}
        same = stream.withColumn("t", F.lit(1).cast("long"))
        assert all(r["pos"] == r["row_index"] + 1 for r in clean.stable_sort(same, "session").collect())
        assert all(r["row_index"] % 2 == 0 for r in clean.dedupe_first(stream, ["session", "arrival"]).collect())
        clock = {r["row_index"]: r["clock"] for r in trajectory.monotonic_clock(stream, "session", "arrival").collect()}
        assert [clock[0], clock[1], clock[2], clock[3]] == [5, 6, 15, 16]


def test_packets_and_tensors_move_in_batches(spark, tmp_path, monkeypatch):
    channels = [[(k * c) % 9000 - 1000 for c in range(64)] for k in range(10)]
    rows = pa.RecordBatch.from_arrays([pa.array([*range(10), None, 3]), pa.array([*channels, channels[0], channels[1][:5]], pa.list_(pa.int32()))], ["sensor_timestamp_us", "channels"])
    data = packets.framed_batch(rows)
    assert data == b"".join(packets.framed(packets.PACKET.pack(k, *channels[k])) for k in range(10))
    (tmp_path / "a.pkt").write_bytes(data)
    back = list(packets.read_batches(packets.Range(str(tmp_path / "a.pkt"), 0, len(data))))
    assert [b.to_pydict() for b in back] == [{"sensor_timestamp_us": list(range(10)), "channels": channels}]

    monkeypatch.setattr(tensors, "WINDOWS", 3)
    monkeypatch.setattr(tensors, "TASKS", 2)
    made = [tensors.batch_of(s, [np.arange(n)] * 4, np.arange(n * 8.0).reshape(n, 4, 2)) for s, n in (("a", 4), ("a", 1), ("b", 2))]
    writer = tensors.TensorWriter(str(tmp_path / "t"))
    writer.commit([writer.write(iter(made))])
    parts = tensors.TensorReader(str(tmp_path / "t")).partitions()
    assert len(parts) == 2 and sum(1 + len(p.more) for p in parts) == 3  # a in two archives, b in one; a task reads several
    read = [row for p in parts for b in tensors.TensorReader(str(tmp_path / "t")).read(p) for row in b.to_pylist()]
    assert sorted(map(repr, read)) == sorted(repr(row) for b in made for row in b.to_pylist())
