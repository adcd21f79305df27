"""Best-fit packing of token sequences."""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import extended, slices, stage
from sessionlake.llm.words import default_tokenizer, encoder

#: Pieces of one length that one window group ranks, about.
RANKED_TOGETHER = 20_000


def cut(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Tokenise whole texts (null: empty), append end_id and cut what is longer than capacity.

    Rows: doc_id, piece, start, length, ids_crc32 and, with_ids, the ids as little-endian unsigned 32-bit bytes. Every
    document gives a row, the empty one the end id alone.
    """
    path = tokenizer or default_tokenizer()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, width = encoder(path), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in slices(batches, 2048):
            cols: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = enc.encode(text) + end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    for col, value in zip(cols, (doc, k, at // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                        col.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            n = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:n], kinds[:n], strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:n])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pieces, schema)


def plan(lengths: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for a histogram of lengths: (number of alike bins, [(length, times), ...]).

    Items above a third of the capacity first: from the longest down, each takes the longest other one that still fits,
    two at most in a bin. Smaller items then go, from the longest down, to the fullest bin with room, and open new bins
    when there is none. Alike bins are handled together, so the work depends on the number of lengths, not of items.
    """
    left = {n: c for n, c in lengths.items() if c}
    if any(n > capacity or n < 1 for n in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    groups: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)  # by room
    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            k = bisect.bisect_right(large, min(n, capacity - n)) - 1
            while k >= 0 and (left[large[k]] == 0 or large[k] == n and left[n] < 2):
                k -= 1
            if k < 0:
                groups[capacity - n].append((left[n], [(n, 1)]))
                left[n] = 0
            else:
                m = large[k]
                count = left[n] // 2 if m == n else min(left[n], left[m])
                left[n] -= count
                left[m] -= count
                groups[capacity - n - m].append((count, [(n, 1), (m, 1)]))
    rooms = sorted(groups)

    def put(room: int, count: int, items: list[tuple[int, int]]) -> None:
        if count:
            if not groups[room]:
                bisect.insort(rooms, room)
            groups[room].append((count, items))

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[n]
        while count:
            k = bisect.bisect_left(rooms, n)
            if k < len(rooms):
                room = rooms[k]
                bins, items = groups[room].pop()
                if not groups[room]:
                    rooms.pop(k)
            else:
                room, bins, items = capacity, -(-count // (capacity // n)), []
            each = room // n
            full = min(bins, count // each)
            rest = min(count - full * each, each) if full < bins else 0
            put(room - each * n, full, [*items, (n, each)])
            if rest:
                put(room - rest * n, 1, [*items, (n, rest)])
            put(room, bins - full - (rest > 0), items) if items else None
            count -= full * each + rest
    return [x for room in sorted(groups) for x in groups[room]]


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Give each row with a length (1 to capacity) a sequence_id and an offset; no sequence exceeds the capacity.

    The plan is made from the histogram of lengths alone, at most capacity rows, so neither it nor what the tasks get of
    it grows with the data. The n-th row of a length takes that length's n-th place: ranks are counted in hashed
    buckets, whose sizes are summed first, so no length is ranked in one task. Rows need doc_id, piece and length.
    """
    spark = pieces.sparkSession
    held = stage(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    starts, firsts, bases, offsets = [], [], [], []
    taken: dict[int, int] = defaultdict(int)
    base = 0
    for count, items in plan(histogram, capacity):
        at = 0
        for n, times in items:
            for _ in range(times):
                starts.append((n << 44) + taken[n])
                firsts.append(taken[n])
                bases.append(base)
                offsets.append(at)
                taken[n] += count
                at += n
        base += count
    order = np.argsort(np.array(starts, "i8"), kind="stable")
    table = spark.sparkContext.broadcast(tuple(np.array(x, "i8")[order] for x in (starts, firsts, bases, offsets)))
    buckets = max(1, -(-sum(histogram.values()) // RANKED_TOGETHER))
    salted = held.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = salted.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")) - 1).join(sizes, ["length", "_bucket"])
    names = held.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, firsts, bases, offsets = table.value
        for batch in batches:
            rank = batch.column("_at").to_numpy(zero_copy_only=False)
            k = np.searchsorted(starts, (batch.column("length").to_numpy(zero_copy_only=False) << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(bases[k] + rank - firsts[k]), pa.array(offsets[k])], [*names, "sequence_id", "offset"])

    schema = extended(held, "sequence_id long, offset long")
    return ranked.select(*names, (F.col("_rank") + F.col("_before")).alias("_at")).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Cut and pack documents (doc_id, text; other columns are left out): see cut() and pack().

    Null and empty texts become one end id, repeated rows are packed one by one, an empty table gives no row.
    """
    return pack(cut(docs, capacity, tokenizer, end_id, with_ids), capacity)


