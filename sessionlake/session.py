"""Sessions, the folder that a cluster shares, and tables staged there."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ensure_importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; on a cluster it is submitted with --py-files instead."""
    here = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if here not in paths:
        env["PYTHONPATH"] = ":".join([*paths, here])


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one local folder a session where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    folder = getattr(spark, "_sessionlake_folder", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="sessionlake-")
        spark.sparkContext.setCheckpointDir(folder)
        spark._sessionlake_folder = folder
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: cuts the lineage and survives lost executors.

    What was shuffled for it is deleted at once, as only the table is read from then on.
    """
    path, conf, before = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}", df.sparkSession.conf, df.sparkSession.conf.get(CLEANUP)
    conf.set(CLEANUP, True)
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, a table of narrow rows, marked for broadcast if it has at most so many; counted first, so df should be staged."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
