"""Fingerprints of documents: sets of content-defined chunks, weighted by length."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import range_column, shuffle_partitions, slices, small
from sessionlake.llm.shingles import mix

#: Bytes of a chunk: at least, usual, at most; the last of a text may be shorter.
LEAST, USUAL, MOST = 16, 48, 192
#: Leading bits of the gear hash that are zero at a boundary, before the usual length and after it.
STRICT, LOOSE = 7, 5
#: The hash is of so many bytes before a boundary.
WINDOW = 32
#: One random 32-bit number for each byte, from a rule.
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
#: Bytes that are hashed at once.
BLOCK = 1 << 20
#: A chunk in a fingerprint: its 64-bit digest and its length; as written, and as computed with.
WRITTEN, CHUNK = np.dtype([("digest", ">u8"), ("length", ">u2")]), np.dtype([("digest", "u8"), ("length", "u2")])


def gear(data: bytes) -> np.ndarray:
    """The gear hash h = 2h + GEAR[byte] modulo 2^32 after each byte, which is that of the last 32 bytes."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < WINDOW:
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h, step = more, 2 * step
    return h


def candidates(data: bytes) -> tuple[list[int], list[int]]:
    """Ends of chunks that the strict and the loose mask allow; the strict ones are among the loose ones."""
    strict, loose = [], []
    for at in range(0, len(data), BLOCK):
        start = max(0, at - WINDOW + 1)
        h = gear(data[start : at + BLOCK])[at - start :]
        ends = np.flatnonzero(h >> np.uint32(32 - LOOSE) == 0)
        strict += (ends[h[ends] >> np.uint32(32 - STRICT) == 0] + (at + 1)).tolist()
        loose += (ends + (at + 1)).tolist()
    return strict, loose


def chunk_ends(data: bytes, start: int = 0, skip: int = 0) -> list[int]:
    """Ends of a text's chunks from one that starts at start; the first skip bytes, WINDOW or more before start, are not hashed."""
    strict, loose = candidates(data[skip:])
    out, n = [], len(data) - skip
    start -= skip
    a = b = 0
    while start < n:
        limit = min(n, start + MOST)
        a = bisect_left(strict, start + LEAST, a)
        if a < len(strict) and strict[a] < start + USUAL:
            start = min(limit, strict[a])
        else:
            b = bisect_left(loose, start + USUAL, b)
            start = min(limit, loose[b]) if b < len(loose) else limit
        out.append(start + skip)
    return out


def chunk_set(data: bytes, ends: list[int]) -> np.ndarray:
    """The distinct chunks, by digest."""
    out = np.empty(len(ends), CHUNK)
    starts = [0, *ends][: len(ends)]
    digest = xxhash.xxh3_64_intdigest
    out["digest"] = [digest(data[a:b]) for a, b in zip(starts, ends, strict=True)]
    out["length"] = np.subtract(ends, starts)
    return out[np.unique(out["digest"], return_index=True)[1]]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of a's bytes that lie in chunks of b; an empty fingerprint is like an empty one alone."""
    if not len(a):
        return float(not len(b))
    return float(a["length"][np.isin(a["digest"], b["digest"])].sum(dtype=np.int64) / a["length"].sum(dtype=np.int64))


def written(chunks: np.ndarray) -> str:
    """Hexadecimal digests and lengths of distinct chunks, ascending: 20 digits a chunk; empty for an empty text."""
    return chunks.astype(WRITTEN).tobytes().hex()


def fingerprint(text: str | None) -> str:
    data = (text or "").encode()
    return written(chunk_set(data, chunk_ends(data)))


class Fingerprinted:
    """A document with its chunks."""

    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.data = self.text.encode()
        self.ends = chunk_ends(self.data)
        self.chunks = chunk_set(self.data, self.ends)

    def edited(self, other: Fingerprinted) -> tuple[bytes, np.ndarray]:
        """The text whose last half of code points is the other's first ones, and its chunks; those before the edit are known."""
        n = len(self.text)
        kept = len(self.text[: n - n // 2].encode())
        data = self.data[:kept] + other.text[: n // 2].encode()
        same = self.ends[: bisect_left(self.ends, kept)]
        start = same[-1] if same else 0
        return data, chunk_set(data, same + chunk_ends(data, start, max(0, start - WINDOW)))

    def compared(self, other: Fingerprinted) -> tuple:
        data, chunks = self.edited(other)
        return (
            self.doc_id, len(self.text), hashlib.sha256(data).hexdigest(), written(self.chunks), written(chunks),
            containment(self.chunks, chunks), containment(self.chunks, other.chunks))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: every whole text against its
    edited text and against the next one in descending doc_id.

    Normalised gear-hash boundaries split a text by what it says, so an edit or a shift changes the chunks around it
    alone; the likeness of two fingerprints is the share of the first one's bytes in chunks of the second. Documents are
    dealt out in ranges of doc_id, each sorted and read in one pass that holds two texts; every range also gets the first
    document of the next one, and the last range that of all. A null text is an empty one, like an empty one (1) and
    nothing else (0); null ids come last, rows of one id are ordered by their texts' hashes and stand in one range; an
    empty table gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = range_column(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id", 4 * shuffle_partitions(spark), "range")
    tops = [(r["range"], r["top"]) for r in rows.groupBy("range").agg(F.max("doc_id").alias("top")).orderBy(F.desc("range")).collect()]  # a row a range
    if not tops:
        return spark.createDataFrame([], RESULT)
    heads = spark.createDataFrame([(after[1], here[0]) for here, after in zip(tops, [*tops[1:], tops[0]], strict=True)], "top long, range int")
    found = rows.drop("range").join(small(heads, 1_000_000), F.col("doc_id").eqNullSafe(F.col("top")))
    found = found.groupBy("range").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "doc_id", "text")).alias("x"))
    found = found.select("range", F.lit(True).alias("head"), "x.doc_id", "x.text")
    met = rows.select("range", F.lit(False).alias("head"), "doc_id", "text").union(found)
    met = met.repartition(shuffle_partitions(spark), "range").sortWithinPartitions("range", "head", F.desc_nulls_last("doc_id"), F.xxhash64("text"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = at = None
        for batch in slices(batches, 64):
            out = []
            for part, head, doc, text in zip(*(batch.column(c) for c in ("range", "head", "doc_id", "text")), strict=True):
                now = Fingerprinted(doc.as_py(), text.as_py())
                if part == at:
                    out.append(last.compared(now))
                last, at = now, part
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), KINDS, strict=True)], NAMES)

    return met.mapInArrow(compare, RESULT)


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
