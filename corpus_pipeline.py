"""A training corpus from raw documents: quality, language, repeated lines, near copies, packing.

Every stage works on all rows that the stage before it kept, with all their columns; only labels are read besides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm import langid, line_dedup, ngram_join, packing, quality
from sessionlake.llm.common import drop_staged, lean, stage


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the quality score quantile that parts the labelled documents as their labels do.

    Null texts are scored as empty ones; without labels all stay; an empty table stays empty.
    """
    lean(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    return quality.keep(docs, model, quality.quantile_threshold(docs, labels, model, between=(0.05, 0.5)))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; null texts and those without a letter go; where nothing can be learned, all go."""
    lean(spark)
    return langid.keep(docs, langid.fit(docs, F.lit(True)))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat another document's or their own; n_chars follows the text."""
    lean(spark)
    left = line_dedup.dedup_lines(docs)
    return left.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose five-word shingles have a Jaccard similarity of 0.8 or more, one of each connected group.

    The row with the smallest doc_id stays, null ids last; rows with a null text or without words all stay.
    """
    lean(spark)
    return ngram_join.without_near_copies(docs, width=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 2048 tokens; a null text is an empty document; an empty table gives no row."""
    lean(spark)
    return packing.pack_documents(docs)


STAGES = [("quality", good), ("language", known_language), ("lines", without_repeated_lines), ("near_copies", without_near_copies), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; what a stage has read is deleted once its rows are there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        before, docs = docs, step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
            if k:
                drop_staged(before)
    return docs
