"""Token ids as length-delimited binary records with a separate offset index."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import shared_folder, shuffle_partitions, stage
from sessionlake.llm.words import default_tokenizer, encoder

#: Payload before the ids: document id (or its absence), number of ids, bytes of an id.
HEAD = struct.Struct("<?qQB")
LENGTH, CHECK = struct.Struct("<Q"), struct.Struct("<I")


def masked(data: bytes) -> int:
    """CRC-32, rotated right by 15 bits plus a constant, so that a checksum of data holding checksums stays useful."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """Length, its masked checksum, the payload, its masked checksum; all little-endian."""
    length = LENGTH.pack(len(payload))
    return b"".join((length, CHECK.pack(masked(length)), payload, CHECK.pack(masked(payload))))


def record(doc_id: int | None, ids: np.ndarray, kind: str) -> bytes:
    """The framed record of a document's ids, each of the given little-endian kind."""
    return frame(HEAD.pack(doc_id is not None, doc_id or 0, len(ids), int(kind[2])) + ids.astype(kind).tobytes())


def contents(framed: bytes) -> tuple[int | None, int, bytes]:
    """doc_id, number of ids and ids as unsigned 32-bit bytes of a framed record."""
    payload = unframe(framed)
    known, doc, n, width = HEAD.unpack_from(payload)
    return doc if known else None, n, np.frombuffer(payload, f"<u{width}", n, HEAD.size).astype("<u4").tobytes()


def unframe(framed: bytes) -> bytes:
    """The payload of one framed record; raises ValueError where a length or checksum is wrong."""
    (n,) = LENGTH.unpack_from(framed)
    if CHECK.unpack_from(framed, 8)[0] != masked(framed[:8]) or len(framed) != n + 16:
        raise ValueError("damaged record length")
    payload = framed[12 : 12 + n]
    if CHECK.unpack_from(framed, 12 + n)[0] != masked(payload):
        raise ValueError("damaged record")
    return payload


def write_records(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, end_id: int = 1, files: int | None = None) -> DataFrame:
    """Encode whole texts (null: empty), append end_id and write a record per row, in ascending doc_id order.

    Files in a new folder below the shared one; ids take two bytes where the vocabulary allows it. Returns the offset
    index, itself a Parquet table beside the files: doc_id, file, record (number in the file), offset, size. A task
    writes files under names of its own and the index names those of the tasks that succeeded, so a lost executor
    leaves at most files that nothing refers to. Null doc_ids come first; repeated rows are written one by one; an
    empty table gives an empty index.
    """
    spark = docs.sparkSession
    path, base = tokenizer or default_tokenizer(), folder or f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # equal ids may go to several files, in order; the hash only splits them
    rows = rows.repartitionByRange(files or shuffle_partitions(spark), F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        enc = encoder(path)
        kind = "<u2" if enc.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        at, number, out = 0, 0, None
        name = f"{base}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.records"
        try:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                if out is None:
                    store, place = fs.FileSystem.from_uri(name)
                    store.create_dir(place.rpartition("/")[0])
                    out = store.open_output_stream(place)
                offsets, sizes, first = [], [], number
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = np.frombuffer(enc.encode(text) + end, "<u4")
                    framed = record(doc, ids, kind)
                    out.write(framed)
                    offsets.append(at)
                    sizes.append(len(framed))
                    at += len(framed)
                    number += 1
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([name] * len(sizes)), pa.array(range(first, number), pa.int64()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "file", "record", "offset", "size"])
        finally:
            if out is not None:
                out.close()

    return stage(rows.mapInArrow(write, "doc_id long, file string, record long, offset long, size long"), "records-index")


def read_records(index: DataFrame) -> DataFrame:
    """Read the records that rows of the index name, any of them in any order: file, record, doc_id, n_tokens, ids.

    ids are little-endian unsigned 32-bit bytes. Every checksum is held against its bytes.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        name, source = None, None
        for batch in batches:
            docs, counts, ids = [], [], []
            for file, offset, size in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "size")), strict=True):
                if file != name:
                    if source is not None:
                        source.close()
                    store, place = fs.FileSystem.from_uri(file)
                    name, source = file, store.open_input_file(place)
                for col, value in zip((docs, counts, ids), contents(source.read_at(size, offset)), strict=True):
                    col.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("record"), pa.array(docs, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], ["file", "record", "doc_id", "n_tokens", "ids"])
        if source is not None:
            source.close()

    wanted = index.select("file", "record", "offset", "size")
    return wanted.mapInArrow(read, "file string, record long, doc_id long, n_tokens long, ids binary")


def with_starts(read: DataFrame) -> DataFrame:
    """Add start, the ids of all records before; files are in the order of their names, so only sums per file are global."""
    totals = read.groupBy("file").agg(F.sum("n_tokens").alias("_total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    totals = totals.select("file", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("file").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    return read.withColumn("_within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(totals, "file").withColumn("start", F.col("_before") + F.col("_within")).drop("_before", "_within")


def digests(index: DataFrame) -> DataFrame:
    """Per record read back: doc_id, start, n_tokens, ids_crc32."""
    read = read_records(index).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return with_starts(read).select("doc_id", "start", "n_tokens", "ids_crc32")
