"""Byte-level BPE over overlapping chunks, and decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import extended, slices, stage

#: Characters of a chunk, characters that it reads on into the next one, and pieces that a task remembers.
CHUNK, OVERLAP, REMEMBERED = 16_384, 512, 200_000


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def token_bytes(ranks: str) -> list[bytes | None]:
    """The bytes of each token at its rank; None at ranks that the vocabulary leaves free."""
    with open(ranks, "rb") as f:
        found = [(int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f)]
    table: list[bytes | None] = [None] * (max(found)[0] + 1)
    for rank, token in found:
        table[rank] = token
    return table


class PieceEncoder:
    """Encodes texts, or their pre-tokens one by one, with the ranks of a public vocabulary; remembers frequent pre-tokens."""

    def __init__(self, ranks: str, pattern: str):
        import regex
        import tiktoken

        self.bpe = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={b: i for i, b in enumerate(token_bytes(ranks)) if b is not None}, special_tokens={})
        self.match = regex.compile(pattern)
        self.seen: dict[str, tuple[int, ...]] = {}

    def _new(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.bpe.encode_ordinary(piece))
        if len(piece) <= 32:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[piece] = ids
        return ids

    def encode(self, pieces: list[str]) -> list[int]:
        seen = self.seen
        try:
            return list(chain.from_iterable([seen[p] for p in pieces]))
        except KeyError:
            return list(chain.from_iterable([seen[p] if p in seen else self._new(p) for p in pieces]))

    def encode_first(self, text: str, n: int) -> list[int]:
        """Of the pre-tokens of text that start before n; tiktoken finds those of a whole text up to CHUNK characters, for which its matching has the stack."""
        if n == len(text) <= CHUNK:
            return self.bpe.encode_ordinary(text)
        if n == len(text):
            return self.encode(self.match.findall(text))
        return self.encode([m[0] for m in takewhile(lambda m: m.start() < n, self.match.finditer(text))])


_encoders: dict[tuple[str, str], PieceEncoder] = {}


def encoder(ranks: str, pattern: str) -> PieceEncoder:
    if (ranks, pattern) not in _encoders:
        _encoders[ranks, pattern] = PieceEncoder(ranks, pattern)
    return _encoders[ranks, pattern]


def encode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Token ids of whole texts (null: empty): one row per document, doc_id, n_tokens, ids (little-endian uint32 bytes).

    A text of up to chunk characters is encoded where it lies. Longer ones are cut into chunks that read on into the next
    one and are pre-tokenised in parallel, each from an arbitrary start. A chunk and the one before it both list the
    pre-token ends in the characters they share; from the first common end on they agree, so there they are stitched.
    The texts between such ends are then encoded one by one and their ids joined in order. A document whose shared
    characters hold no common end (one run longer than the overlap) is encoded as one text instead.
    Other columns are left out; repeated rows give repeated rows; an empty table gives no row.
    """
    ranks, pattern = ranks or default_ranks(), pattern or default_pattern()
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    short = rows.filter(F.length("text") <= chunk)
    long = rows.filter(F.length("text") > chunk).withColumn("key", F.xxhash64("text"))
    numbers = F.expr(f"sequence(0, (length(text) - 1) div {chunk})")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks, pattern)
        for batch in slices(batches):
            heads, tails = [], []
            for n, part, text in zip(*(batch.column(c).to_pylist() for c in ("n", "part", "text")), strict=True):
                at = [m.end() for m in enc.match.finditer(text)]
                if part * chunk + len(text) < n:  # the last matches could go on in the whole text
                    at = [x for x in at[:-1] if x < len(text) - 1]
                heads.append([x for x in at if x <= overlap])
                tails.append([x - chunk for x in at if x > chunk])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "key", "part")), pa.array(heads, kind), pa.array(tails, kind)], ["doc_id", "key", "part", "head", "tail"])

    chunks = long.select("doc_id", "key", F.length("text").alias("n"), "text", F.explode(numbers).alias("part"))
    chunks = chunks.withColumn("part", F.col("part").cast("int")).withColumn("text", F.expr(f"substring(text, part * {chunk} + 1, {chunk + overlap})")).repartition("doc_id", "key", "part")
    marks = chunks.mapInArrow(ends, "doc_id long, key long, part int, head array<int>, tail array<int>")
    shared = marks.select("doc_id", "key", "part", "head", F.lit(None).cast("array<int>").alias("tail")).union(marks.select("doc_id", "key", F.col("part") + 1, F.lit(None).cast("array<int>"), "tail"))
    joints = (
        shared.filter("part > 0").groupBy("doc_id", "key", "part").agg(F.max("head").alias("head"), F.max("tail").alias("tail")).filter("head is not null")
        .select("doc_id", "key", F.struct("part", F.expr("array_min(array_intersect(head, tail))").alias("at")).alias("joint"))
        .groupBy("doc_id", "key").agg(F.array_sort(F.collect_list("joint")).alias("joints"))
    )
    joints = stage(joints, "joints")
    stitched = long.join(joints, ["doc_id", "key"], "left").withColumn("whole", F.expr("joints is null or exists(joints, j -> j.at is null)"))
    starts = F.expr(f"if(whole, array(0), array_insert(transform(joints, j -> j.part * {chunk} + j.at), 1, 0))")
    stitched = stitched.withColumn("starts", starts).select("doc_id", "key", "text", "starts", F.posexplode("starts").alias("part", "start"))
    stitched = stitched.withColumn("stop", F.expr("if(part + 1 < size(starts), starts[part + 1], length(text))"))
    # some characters past the end, for patterns that look ahead
    parts = stitched.select("doc_id", "key", "part", F.expr("stop - start").alias("n"), F.expr(f"substring(text, start + 1, stop - start + {overlap})").alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks, pattern)
        for batch in slices(batches):
            ids = []
            for n, text in zip(batch.column("n").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(np.array(enc.encode_first(text, n), "<u4"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), batch.column("part"), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())], ["doc_id", "key", "part", "n_tokens", "ids"])

    schema = "doc_id long, key long, part int, n_tokens long, ids binary"
    done = parts.mapInArrow(encoded, schema).groupBy("doc_id", "key").agg(F.count_if(F.col("part") == 0).alias("rows"), F.array_sort(F.collect_set(F.struct("part", "n_tokens", "ids"))).alias("parts"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            docs, counts, ids = [], [], []
            for doc, times, parts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "rows", "parts")), strict=True):
                for _ in range(times):
                    docs.append(doc)
                    counts.append(sum(p["n_tokens"] for p in parts))
                    ids.append(b"".join(p["ids"] for p in parts))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    out = "doc_id long, n_tokens long, ids binary"
    at_once = short.select("doc_id", F.lit(0).cast("long").alias("key"), F.lit(0).alias("part"), F.length("text").alias("n"), "text").mapInArrow(encoded, schema)
    return at_once.select("doc_id", "n_tokens", "ids").union(done.mapInArrow(joined, out))


def with_decoded(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[pa.RecordBatch]:
    """Arrow batches with ids, and their raw bytes as a further column."""
    of = token_bytes(ranks).__getitem__
    for batch in slices(batches):
        raw = [None if x is None else b"".join(map(of, np.frombuffer(x, "<u4").tolist())) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [*batch.schema.names, "decoded"])


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """Raw bytes of encode()'s rows, its columns and decoded (in place of a column so named); null ids decode to null."""
    path, encoded = ranks or default_ranks(), encoded.drop("decoded")
    return encoded.mapInArrow(lambda batches: with_decoded(batches, path), extended(encoded, "decoded binary"))


def digests(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """Per row of encode(): doc_id, n_tokens, the SHA-256 of the decimal ids and of the decoded bytes, in one pass."""
    path = ranks or default_ranks()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = list(map(str, range(len(token_bytes(path))))).__getitem__
        for batch in with_decoded(batches, path):
            ids = [hashlib.sha256(" ".join(map(decimal, np.frombuffer(x, "<u4").tolist())).encode()).hexdigest() for x in batch.column("ids").to_pylist()]
            raw = [hashlib.sha256(x).hexdigest() for x in batch.column("decoded").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), pa.array(ids, pa.string()), pa.array(raw, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(hashed, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
