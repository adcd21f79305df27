"""Readers of recording folders: header-aware CSV, file listings, session discovery, JSON metadata, arrays."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.session import stage

#: The session folder in a path: the part that holds a camera folder, a sensor file or a log.
SESSION = r"^(.*?/(session_[^/]+))/"


def read_csv_cells(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """CSV files read by their own headers: path, row_index (from 0), header, cells (map of column to text).

    Columns are bound by name in each file, not by position over all files. Rows shorter than the header lack the last
    columns; blank lines are skipped without a number; a missing cell is an empty text. Quoted cells aren't supported.
    """
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    lines = whole.select(F.col("_metadata.file_path").alias("path"), F.filter(F.split(F.regexp_replace("value", "\r", ""), "\n"), lambda x: F.trim(x) != "").alias("lines"))
    lines = lines.select("path", F.transform(F.split(F.regexp_replace(F.get("lines", F.lit(0)), "^﻿", ""), ","), lambda x: F.trim(x)).alias("header"), F.posexplode_outer(F.slice("lines", 2, 2**31 - 1)).alias("row_index", "line"))
    cells = F.split("line", ",", -1)
    padded = F.transform("header", lambda _, i: F.coalesce(F.get(cells, i), F.lit("")))
    return lines.filter("line is not null").select("path", F.col("row_index").cast("long"), "header", F.map_from_arrays("header", padded).alias("cells"))


def csv_headers(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """path, header and n_rows of every CSV file, those without rows too; an empty file has an empty header."""
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    lines = F.filter(F.split(F.regexp_replace("value", "\r", ""), "\n"), lambda x: F.trim(x) != "")

    read = whole.select(F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias("path"), F.split(F.get(lines, F.lit(0)), ",").alias("header"), F.size(lines).alias("n"))
    files = listing(spark, path, glob)  # reading whole texts passes over empty files
    return files.select("path").join(read, "path", "left").select("path", F.coalesce("header", F.array().cast("array<string>")).alias("header"), F.greatest(F.lit(0), F.coalesce("n", F.lit(0)) - 1).alias("n_rows"))


def timestamp_column(header: Column, preferred: list[str], fallback: str | None = None) -> Column:
    """First of the preferred names in a file's header; else the fallback name if it is there, "first" the first column."""
    out = F.lit(None).cast("string")
    if fallback == "first":
        out = F.get(header, F.lit(0))
    elif fallback:
        out = F.when(F.array_contains(header, fallback), fallback)
    for name in reversed(preferred):
        out = F.when(F.array_contains(header, name), name).otherwise(out)
    return out


def timestamps(cells: DataFrame, preferred: list[str], fallback: str | None = None) -> DataFrame:
    """path, row_index, t of the rows whose timestamp parses."""
    from sessionlake.functions.parse import safe_int

    t = safe_int(F.element_at("cells", timestamp_column(F.col("header"), preferred, fallback)))
    return cells.select("path", "row_index", t.alias("t")).filter("t is not null")


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path (without the scheme), length, session and root of files, empty ones too; contents are never read.

    The folders right below the path are dealt to tasks, each of which lists its own; Spark's file readers would pass
    over files without bytes.
    """

    def listed(recursive: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyarrow import fs

            for batch in batches:
                for place, folder, size in zip(batch["path"], batch["folder"], batch["length"], strict=True):
                    if not folder:
                        yield pd.DataFrame({"path": [place], "folder": [False], "length": [size]})
                        continue
                    store, inner = fs.FileSystem.from_uri(place)
                    found = store.get_file_info(fs.FileSelector(inner, recursive=recursive))
                    scheme = place[: len(place) - len(inner)]
                    yield pd.DataFrame({"path": [scheme + f.path for f in found], "folder": [f.type == fs.FileType.Directory for f in found], "length": [f.size or 0 for f in found]})

        return run

    kind = "path string, folder boolean, length long"
    top = spark.createDataFrame([(path, True, 0)], kind).mapInPandas(listed(False), kind)
    files = top.repartition("path").mapInPandas(listed(True), kind).filter("not folder").select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")
    name = F.regexp_extract("path", "([^/]+)$", 1)
    like = "".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in glob)
    return files.filter(name.rlike(f"^{like}$")).select("path", "length", F.regexp_extract("path", SESSION, 2).alias("session"), F.regexp_extract("path", SESSION, 1).alias("root"))


def scan(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """listing() for folders of any depth and shape: path, length, session and root, a level of folders at a time.

    The folders of a level are dealt over tasks, each of which lists single folders, so one deep or very wide tree is no
    task's alone. Folders are known by their resolved paths: a link to one that has been seen, its own parent too, is not
    listed again. Folders are tables in the shared folder between levels; nothing of them comes to the driver.
    """

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        from pyarrow import fs

        for batch in batches:
            for place in batch["path"]:
                store, inner = fs.FileSystem.from_uri(place) if "://" in place or place.startswith("file:") else (fs.LocalFileSystem(), place)
                scheme = place[: len(place) - len(inner)]
                local = isinstance(store, fs.LocalFileSystem)
                rows = []
                for f in store.get_file_info(fs.FileSelector(inner)):
                    folder = f.type == fs.FileType.Directory
                    rows.append((scheme + (os.path.realpath(f.path) if local and folder else f.path), folder, f.size or 0))
                yield pd.DataFrame(rows, columns=["path", "folder", "length"])

    level = stage(spark.createDataFrame([(path.rstrip("/"),)], "path string"), "folders")
    seen, parts = level, []
    while True:
        found = stage(level.repartition(spark.sparkContext.defaultParallelism, "path").mapInPandas(listed, "path string, folder boolean, length long"), "level")
        parts.append(found.filter("not folder").select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length"))
        level = stage(found.filter("folder").select("path").distinct().join(seen, "path", "left_anti"), "folders")
        if level.isEmpty():
            break
        seen = seen.union(level)
    files = parts[0]
    for p in parts[1:]:
        files = files.union(p)
    like = "".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in glob)
    files = files.filter(F.regexp_extract("path", "([^/]+)$", 1).rlike(f"^{like}$"))
    return files.select("path", "length", F.regexp_extract("path", SESSION, 2).alias("session"), F.regexp_extract("path", SESSION, 1).alias("root"))


def discover(files: DataFrame) -> DataFrame:
    """Sessions and what they hold: data_format by the camera folders, files, bytes, junk and empty files."""
    from sessionlake.functions.parse import data_format, session_date, session_time

    def has(part: str) -> Column:
        return F.bool_or(F.col("path").contains(f"/{part}/"))

    found = files.filter("session <> ''").groupBy("root", "session").agg(
        has("world_camera").alias("world"), has("wrist_camera").alias("wrist"), has("dji").alias("dji"), has("realsense").alias("realsense"),
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.count_if(F.col("length") == 0).alias("zero_size"), F.count_if(F.col("path").endswith(".uploading.cfg")).alias("junk_files"))
    kind = data_format(F.col("world") & F.col("wrist"), F.col("dji"), F.col("realsense"))
    return found.withColumn("data_format", kind).withColumn("date", session_date(F.col("session"))).withColumn("time", session_time(F.col("session")))


def image_stems(files: DataFrame) -> DataFrame:
    """session, stream (folder) and stem of image files."""
    images = files.filter(F.col("path").rlike(r"\.(jpg|jpeg|png|npy)$"))
    return images.select("session", F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("stream"), F.regexp_extract("path", r"/([^/]+)\.[^./]+$", 1).alias("stem"), "length")


def read_json(spark: SparkSession, path: str, schema: str, glob: str = "*.json") -> DataFrame:
    """path, value (struct of the schema) and bad (true where the text is no JSON); unknown fields are left out."""
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    return whole.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", schema).alias("value"), F.try_parse_json("value").isNull().alias("bad"))


def frame_states(texts: DataFrame, stems: DataFrame, least: int = 6) -> DataFrame:
    """session, frame, code, joints and pose of the arm's per-frame JSON texts (session, text).

    Kept are those with a pose of at least so many numbers whose frame has an image (stems: session, stem); texts that are
    no JSON go with them that lack a pose.
    """
    state = F.from_json("text", "frame string, state struct<code:int,data:struct<joint:array<double>,pose:array<double>>>")
    rows = texts.select("session", state.alias("s")).select("session", "s.frame", "s.state.code", F.col("s.state.data.joint").alias("joints"), "s.state.data.pose")
    return rows.filter(F.size("pose") >= least).join(stems.select("session", F.col("stem").alias("frame")).distinct(), ["session", "frame"], "left_semi")


def read_npz(spark: SparkSession, path: str, names: dict[str, str], glob: str = "*.npz") -> DataFrame:
    """Arrays of npz files of a session each: a row per leading index with path, i and the named arrays.

    names: array to Spark type, "double" for one axis or "array<double>" for two; an absent array gives nulls.
    """
    schema = "path string, i long, " + ", ".join(f"{n} {t}" for n, t in names.items())

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place, content in zip(batch["path"], batch["content"], strict=True):
                with np.load(io.BytesIO(content), allow_pickle=False) as z:
                    n = max((len(z[k]) for k in names if k in z), default=0)
                    out = {"path": [place] * n, "i": np.arange(n)}
                    for k in names:
                        out[k] = [x.reshape(-1).tolist() if x.ndim else x.item() for x in z[k]] if k in z else [None] * n
                yield pd.DataFrame(out)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInPandas(rows, schema)


def episode_of(path: Column) -> list[Column]:
    """Numbers in a name like ep001_env02_step000003."""
    return [F.regexp_extract(path, rf"{n}(\d+)", 1).try_cast("int").alias(n) for n in ("ep", "env", "step")]
