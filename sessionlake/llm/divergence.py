"""Divergence of the term distributions of a language's sources from each other and from the language."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import drop_staged, shuffle_partitions, slices, small, stage

#: A term is a run of ASCII letters and of bytes of other characters; only A-Z are lowered, all else parts terms.
LOWERED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Counts of (source, term) that a task holds before it hands them on, and bytes of text that they may come from.
HELD_COUNTS, HELD_BYTES = 800_000, 64 << 20
#: Groups that are joined by broadcast.
SMALL = 50_000


def by_term(lang: str, docs: Counter, counts: dict[str, Counter]) -> pa.RecordBatch:
    """A row for each term of a language: its documents, and the sources that have it with their occurrences."""
    place = {w: k for k, w in enumerate(docs)}
    at = np.concatenate([np.fromiter(map(place.__getitem__, c), "i8", len(c)) for c in counts.values()])
    n = np.concatenate([np.fromiter(c.values(), "i8", len(c)) for c in counts.values()])
    source = np.repeat(np.arange(len(counts)), [len(c) for c in counts.values()])
    order = np.argsort(at, kind="stable")
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(place)))]).astype("i4"))
    columns = [
        pa.array([lang]).take(pa.array(np.zeros(len(place), "i4"))), pa.array(list(place), pa.binary()).cast(pa.string()), pa.array(np.fromiter(docs.values(), "i8", len(docs))),
        pa.ListArray.from_arrays(ends, pa.array(list(counts), pa.string()).take(pa.array(source[order]))), pa.ListArray.from_arrays(ends, pa.array(n[order])),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "term", "docs", "sources", "ns"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, term, docs, sources, ns: rows that have a term, and its occurrences by source, as a task has counted them.

    A task sums what it reads before anything is shuffled, so a term is a row a task, and hands its sums on when they grow
    past a bound; long texts are counted whole, one at a time.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)
        counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, found in seen.items():
                whole = by_term(lang, found, counts[lang])
                for k in range(0, whole.num_rows, 20_000):
                    yield whole.slice(k, 20_000)
            seen.clear()
            counts.clear()

        for batch in slices(batches, 64):
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                words = text.translate(LOWERED).split()
                if words:
                    counts[lang][source].update(words)
                    seen[lang].update(set(words))
                size += len(text)
            if size > HELD_BYTES or sum(len(c) for x in counts.values() for c in x.values()) > HELD_COUNTS:
                yield from flush()
                size = 0
        yield from flush()

    return rows.mapInArrow(count, "lang string, term string, docs long, sources array<string>, ns array<long>")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exact for every count that a long holds."""
    part = (F.lit(1_000_000_000).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")).cast("decimal(38,0)")
    return 1 + F.call_function("div", part, (total + 2 * kept).cast("decimal(20,0)"))


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of longs up to 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: part "pair" holds each source against every other of its language, part
    "term" a source's terms that most exceed their share of the language.

    A language keeps the terms that at least min_docs of its rows have; shares are smoothed and exact integers. A pair's
    distance over all kept terms is put together by inclusion and exclusion: a constant for the terms that neither side
    has, each side's histogram of counts for the terms of its support as if the other had none, and a correction for
    the terms of both, from joining the postings of terms with each other. Postings are summed in tasks and then by
    term, so a term's are as many as its sources, whatever its rows; a source that holds most rows is one posting a
    term, too. A null text, language or source is an empty one; an empty text adds its group, no terms; an
    empty table gives no row; repeated rows count each; other columns are ignored.
    """
    # Dealt by term once: what keeps a term, and the sums of those that stay, need no other exchange. Both ask for all columns, so
    # that Spark finds one exchange for both and counts the texts once.
    counts = term_counts(docs).repartition(shuffle_partitions(docs.sparkSession), "lang", "term")
    kept = counts.groupBy("lang", "term").agg(F.sum(F.aggregate("ns", F.lit(0).cast("long"), lambda a, x: a + x)).alias("lang_n"), F.sum("docs").alias("_d"), F.max(F.size("sources")).alias("_s"))
    kept = kept.filter((F.col("_d") >= min_docs) & (F.col("_s") > 0)).drop("_d", "_s")
    some = counts.join(kept.hint("shuffle_hash"), ["lang", "term"]).select("lang", "term", "docs", "lang_n", F.explode(F.arrays_zip("sources", "ns")).alias("x"))
    postings = stage(some.groupBy("lang", "term", F.col("x.sources").alias("source")).agg(F.sum("x.ns").alias("n"), F.first("lang_n").alias("lang_n"), F.sum("docs").alias("rows")), "postings")
    kept = postings.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    langs = stage(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "langs")
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("support"))
    zero = F.lit(0).cast("long")
    groups = stage(
        named.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "support", "v", "lang_total"])
        .withColumn("p0", F.when(F.col("v") > 0, share(zero, F.col("total"), F.col("v"))).otherwise(zero + 1)),
        "groups",
    )
    known = small(groups, SMALL)
    priced = stage(
        postings.join(known, ["lang", "source"]).select(
            "lang", "term", "source", "n", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), "p0",
            share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")),
        "priced",
    )
    drop_staged(postings)

    one, other = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("pa"), "v"), groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("pb"))
    neither = one.join(small(other, SMALL), "lang").filter("a <> b")
    zeros = neither.select("lang", "a", "b", (F.col("v") * distance(F.col("pa"), F.col("pb"))).alias("f"))
    histogram = priced.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count("*").alias("k"))
    # in place of what the constant counts for the terms of one side's support
    sided = histogram.join(small(neither, SMALL), ["lang", "a"]).withColumn("f", F.col("k") * (distance(F.col("p"), F.col("pb")) - distance(F.col("pa"), F.col("pb"))))
    sided = sided.groupBy("lang", "a", "b").agg(F.sum("f").alias("f"))
    left = priced.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("x"), F.col("p0").alias("pa"))
    right = priced.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("y"), F.col("p0").alias("pb"))
    both = left.join(right, ["lang", "term"]).filter("a < b")
    both = both.withColumn("f", distance(F.col("x"), F.col("y")) - distance(F.col("x"), F.col("pb")) - distance(F.col("pa"), F.col("y")) + distance(F.col("pa"), F.col("pb")))
    both = stage(both.groupBy("lang", "a", "b").agg(F.sum("f").alias("f")), "overlaps")
    turned = lambda x: x.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "f")
    pairs = zeros.union(sided).union(turned(sided)).union(both).union(turned(both)).groupBy("lang", "a", "b").agg(F.sum("f").alias("value"))
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")

    terms = priced.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = terms.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(by)).union(best)
