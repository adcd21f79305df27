"""stream_timing_checker: medians halfway between two thousandths are rounded as the SQL does."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from sessionlake import plans
from tests.compare import TABLES, assert_same

SF = Path("/root/testdata/sf0.001")


def test_halves_of_thousandths(spark, tmp_path):
    for t in TABLES:
        if t != "events":
            (tmp_path / f"{t}.parquet").symlink_to(SF / f"{t}.parquet")
    draw, like = random.Random(1), pq.read_schema(SF / "events.parquet")
    rows = [{"event_id": k, "ts": datetime(2024, 1, 1) + timedelta(microseconds=draw.randrange(30 * 86_400_000_000)), "user_id": k % 2000, "event_type": "view", "value": 1.0, "props": '{"k": 1}'} for k in range(10_000)]
    pq.write_table(pa.Table.from_pylist(rows, like), tmp_path / "events.parquet")
    assert_same(spark, str(tmp_path), plans.QUERIES["stream_timing_checker"], plans.ORACLE_SQL["stream_timing_checker"])
