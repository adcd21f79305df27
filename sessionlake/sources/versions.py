"""Tables of versions: a version names its files, and the next one is made only if none came meanwhile."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.sources.sinks import latest


class Conflict(Exception):
    """Another writer has made the version that this one was to be."""


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str, end: str) -> list[str]:
    path, store = _hadoop(spark, folder)
    return sorted(f.getPath().getName() for f in store.listStatus(path) if f.getPath().getName().endswith(end)) if store.exists(path) else []


def current(spark: SparkSession, folder: str) -> int:
    """The newest version's number; 0 where there is none."""
    return max((int(n.partition(".")[0]) for n in _names(spark, f"{folder}/_versions", ".json") if not n.startswith(("_", "."))), default=0)


def files(spark: SparkSession, folder: str, version: int) -> list[str]:
    """A version's files, below the folder."""
    if not version:
        return []
    return json.loads("".join(r[0] for r in spark.read.text(f"{folder}/_versions/{version:09}.json", wholetext=True).collect()))


def read(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A version's rows, the newest one's by default; every version stays readable."""
    found = files(spark, folder, current(spark, folder) if version is None else version)
    if not found:
        raise ValueError(f"no such version in {folder}")
    return spark.read.parquet(*(f"{folder}/{f}" for f in found))


def _commit(spark: SparkSession, folder: str, base: int, names: list[str]) -> int:
    """Make version base + 1 of these files; its file is renamed into place, which fails if it is there."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(_hadoop(spark, folder)[0].toUri(), spark._jsc.hadoopConfiguration())
    temp, store = _hadoop(spark, f"{folder}/_versions/_{uuid.uuid4().hex}")
    out = store.create(temp, False)
    out.write(bytearray(json.dumps(names).encode()))
    out.close()
    to = _hadoop(spark, f"{folder}/_versions/{base + 1:09}.json")[0]
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(temp, to, options)
    except Exception as e:
        store.delete(temp, False)
        if "FileAlreadyExists" not in str(e):
            raise
        raise Conflict(f"version {base + 1} of {folder} is another writer's") from None
    return base + 1


def _written(df: DataFrame, folder: str) -> list[str]:
    spark, part = df.sparkSession, f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{part}")
    return [f"{part}/{n}" for n in _names(spark, f"{folder}/{part}", ".parquet")]


def write(df: DataFrame, folder: str, base: int | None = None) -> int:
    """All rows as the version after base (the newest one, if not given)."""
    spark = df.sparkSession
    base = current(spark, folder) if base is None else base
    return _commit(spark, folder, base, _written(df, folder))


def upsert(changes: DataFrame, folder: str, key: str, updated: str, base: int | None = None) -> int:
    """The version after base with the changes in it: of each key the row that was updated last.

    Only files that hold a changed key are read whole and written anew; the next version names the others as they are. If
    another writer has made a version since base, Conflict is raised and nothing is changed; files that were written are
    named by no version. A table of many files is best sorted by key, so that changes touch few. Changes are read
    twice; rows with a null key in them are new rows, one of them stays.
    """
    spark = changes.sparkSession
    base = current(spark, folder) if base is None else base
    old = files(spark, folder, base)
    table = read(spark, folder, base)
    keys = changes.select(key).distinct()
    hit = table.select(key, F.col("_metadata.file_path").alias("_file")).join(keys, key, "left_semi").select("_file").distinct()
    ends = {"/".join(r["_file"].split("/")[-2:]) for r in hit.collect()}  # a row a file
    touched = [f for f in old if "/".join(f.split("/")[-2:]) in ends]
    rows = changes.select(table.columns)
    if touched:
        rows = spark.read.schema(table.schema).parquet(*(f"{folder}/{f}" for f in touched)).unionByName(rows)
    new = _written(latest(rows, key, updated), folder)
    return _commit(spark, folder, base, [f for f in old if f not in touched] + new)
