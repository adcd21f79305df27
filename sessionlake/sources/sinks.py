"""Sinks: versioned tables, reports, episode tables and split views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.operators.manifest import SPLITS



def write_version(df: DataFrame, base: str, apply: bool = True) -> str | None:
    """A new version of a cleaned table beside the old ones; the source is never changed. Nothing is written without apply."""
    if not apply:
        return None
    path = f"{base}/version-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def flattened(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for CSV."""
    return df.select(*(F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes))


def write_reports(sessions: DataFrame, issues: DataFrame, summary: DataFrame, folder: str) -> None:
    """Sessions as JSON lines and CSV, issues as CSV, the summary as JSON."""
    sessions.write.json(f"{folder}/sessions_json")
    flattened(sessions).write.option("header", True).csv(f"{folder}/sessions_csv")
    flattened(issues).write.option("header", True).csv(f"{folder}/issues_csv")
    summary.write.json(f"{folder}/summary_json")


def write_episodes(steps: DataFrame, folder: str, episode: str, fields: list[str]) -> None:
    """Steps as rows, clustered by episode, and episodes with their number of steps."""
    steps.repartition(episode).sortWithinPartitions(episode, "step").select(episode, "step", *fields).write.parquet(f"{folder}/steps")
    steps.groupBy(episode).agg(F.count("*").alias("n_steps")).write.parquet(f"{folder}/episodes")


def write_split_views(manifest: DataFrame, folder: str, split: str = "split", splits: tuple[str, ...] = SPLITS) -> None:
    """All rows in all_manifest; those of known splits also under a folder for each split."""
    manifest.write.parquet(f"{folder}/all_manifest")
    manifest.filter(F.col(split).isin(*splits)).write.partitionBy(split).parquet(f"{folder}/splits")


def latest(rows: DataFrame, key: str, updated: str) -> DataFrame:
    """Upserts: of each key the row that was updated last."""
    newest = F.max_by(F.struct(*rows.columns), updated)
    return rows.groupBy(key).agg(newest.alias("_r")).select("_r.*")


def write_nested_episodes(steps: DataFrame, folder: str, episode: str, observation: list[str], fields: list[str]) -> None:
    """Steps with their observation as one struct, is_first and is_last by their place, and episodes beside them."""
    w = Window.partitionBy(episode)
    marked = steps.withColumns({"is_first": F.col("step") == F.min("step").over(w), "is_last": F.col("step") == F.max("step").over(w)})
    rows = marked.select(episode, "step", F.struct(*observation).alias("observation"), *fields, "is_first", "is_last")
    rows.write.parquet(f"{folder}/steps")
    rows.groupBy(episode).agg(F.count("*").alias("n_steps")).write.parquet(f"{folder}/episodes")


def write_sync_index(rows: DataFrame, summary: DataFrame, folder: str, session: str = "session") -> None:
    """Aligned rows by session, and the summary as JSON; without rows an empty table with the schema."""
    if rows.isEmpty():
        rows.drop(session).write.parquet(f"{folder}/sync_index")
    else:
        rows.write.partitionBy(session).parquet(f"{folder}/sync_index")
    summary.write.json(f"{folder}/summary_json")


def write_tensors(windows: DataFrame, folder: str, session: str = "session") -> None:
    """Tensor windows of all sessions in one table, sorted by session and window, so one session is read by its files' statistics."""
    windows.repartitionByRange(session).sortWithinPartitions(session, "window_id").write.parquet(f"{folder}/windows")


def link_manifest(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """What a view of links would hold, by status: already (same target), conflict (another target) or would_link."""
    there = present.select(key, F.col("target").alias("_target"))
    status = F.when(F.col("_target").isNull(), "would_link").when(F.col("_target") == F.col("target"), "already").otherwise("conflict")
    return wanted.join(there, key, "left").withColumn("status", status).drop("_target")


def write_csv_export(rows: DataFrame, folder: str, columns: list[str]) -> None:
    """Columns in the order given, with a header."""
    flattened(rows.select(*columns)).write.option("header", True).csv(folder)
