"""Staged tables leave no shuffle files behind, keys of lines are dealt once, and tiles without a pair stay where they are."""

import re
import time
from glob import glob

import pytest
from pyspark.sql import functions as F

from sessionlake import session
from sessionlake.llm import line_dedup, ngram_join
from tests.compare import rows_of

WORDS = [f"word{k}" for k in range(60)]


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in glob(f"{folder}/*/shuffle_*.data")}


def test_stage_deletes_what_it_shuffled(spark):
    before, conf = shuffle_files(spark), spark.conf.get(session.CLEANUP)
    got = session.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "shuffled")
    for _ in range(100):  # files go in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and spark.conf.get(session.CLEANUP) == conf
    assert {r["k"]: r["count"] for r in got.collect()} == {k: 1000 // 7 + (k < 1000 % 7) for k in range(7)}


@pytest.fixture
def plans(monkeypatch):
    """The executed plans of what the operators stage, by name."""
    found = {}

    def kept(df, name):
        found.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return session.stage(df, name)

    monkeypatch.setattr(line_dedup, "stage", kept)
    monkeypatch.setattr(ngram_join, "stage", kept)
    return found


def lines(spark):
    made = [" ".join(WORDS[(k * 7 + i * i) % 60] for i in range(12)) for k in range(20)]
    rows = [(k, "\n".join([made[k], made[(k + 1) % 20], made[0] if k % 2 else made[k].replace("word1 ", "work1 ")])) for k in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_keys_of_lines_are_dealt_once(spark, plans, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    line_dedup.dedup_lines(lines(spark))
    assert sum(len(re.findall("Exchange hashpartitioning", p)) for name in ("shared-keys", "live-lines") for p in plans.get(name, ())) == 1


def test_copies_of_a_line_stand_once_and_change_nothing(spark, monkeypatch):
    docs = lines(spark)
    want = line_dedup.dedup_lines(docs)
    monkeypatch.setattr(line_dedup, "OFTEN", 2)
    seen = line_dedup.occurrences(docs)
    times = seen.groupBy("id").agg(F.count("*").alias("times"))
    left = {r["id"]: r["count"] for r in line_dedup.thinned(seen, times).groupBy("id").count().collect()}
    assert left == {r["id"]: r["times"] if r["times"] <= 2 else 1 for r in times.collect()}
    got = line_dedup.dedup_lines(docs)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.collect())


def test_tiles_are_joined_to_few_pairs_where_they_are(spark, plans):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    try:
        base = [[f"w{(k // 4) * 50 + i}" for i in range(50)] for k in range(40)]
        rows = [(k, " ".join(w if i != k % 4 * 12 else "other" for i, w in enumerate(base[k]))) for k in range(40)]
        ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), width=1, percent=80, tile_rows=2).count()
    finally:
        spark.conf.set(name, before)
    assert plans["opened"] and not any(re.search(r"hashpartitioning\(a#\d+L, ta#\d+L", p) for p in plans["opened"])
