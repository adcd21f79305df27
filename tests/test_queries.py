import pytest

import __spark_entry__ as entry
from sessionlake import plans
from tests.compare import assert_same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert_same(spark, SF, plans.QUERIES[name], plans.ORACLE_SQL[name])


def test_average_pose_against_numpy(spark):
    import numpy as np

    rows = {r["s_nationkey"]: r for r in plans.QUERIES["average_pose"](spark, SF).collect()}
    raw = spark.read.parquet(f"{SF}/supplier.parquet").collect()
    for nation in rows:
        q = np.array([[10.0, r["s_suppkey"] % 7, r["s_suppkey"] % 5, r["s_suppkey"] % 3] for r in raw if r["s_nationkey"] == nation])
        q /= np.linalg.norm(q, axis=1, keepdims=True)
        top = np.linalg.eigh(q.T @ q)[1][:, -1]
        got = np.array([rows[nation][c] for c in ("qw", "qx", "qy", "qz")])
        assert abs(abs(top @ got) - 1) < 1e-9


def test_entry(spark):
    assert entry.entry(spark).columns == ["session", "frames", "valid_frames", "mean_abs_dt_us", "max_abs_dt_us", "idx_sum"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_streams_do_not_depend_on_files(spark, tmp_path):
    from datetime import timedelta

    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{SF}/events.parquet").sort_by("event_id")
    at = rows.schema.get_field_index("ts")
    ts = pa.array([t + timedelta(days=10 * k) for k, t in zip((12 * i // rows.num_rows for i in range(rows.num_rows)), rows["ts"].to_pylist())], rows.schema.field(at).type)
    rows = rows.set_column(at, rows.schema.field(at), ts)
    for name in ("one", "many"):
        (tmp_path / name / "events.parquet").mkdir(parents=True)
    pq.write_table(rows, tmp_path / "one/events.parquet/part.parquet")
    step = -(-rows.num_rows // 12)
    for k in reversed(range(12)):
        pq.write_table(rows.slice(k * step, step), tmp_path / f"many/events.parquet/{11 - k:02}.parquet")
    for name in ("stream_monotonic", "stream_dedupe"):
        one, many = (sorted(map(tuple, plans.QUERIES[name](spark, str(tmp_path / k)).collect())) for k in ("one", "many"))
        assert one == many
