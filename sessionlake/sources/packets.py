"""Tactile packets as a source and sink: framed binary records in append-only files, read in batches or as a stream.

A record is a mark, the payload's length, its CRC-32 and the payload: a sensor clock and 64 channels. The mark and checksum let
a reader start anywhere in a file, so a file is split by bytes like text; broken bytes between records are passed over.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: The sensor's packet.
CHANNELS, PACKET = 64, struct.Struct("<Q64h")
MARK, HEAD = b"\xa5\x5aPK", struct.Struct("<4sHI")
#: The payload and the whole record as arrays.
PAYLOAD = np.dtype([("clock", "<u8"), ("channels", "<i2", (CHANNELS,))])
RECORD = np.dtype([("mark", "S4"), ("n", "<u2"), ("check", "<u4"), ("payload", PAYLOAD)])
#: Records that a task gives at once.
ROWS = 4096
#: Longest record; bytes of a file that one task reads at most.
LONGEST, SPLIT = HEAD.size + 65535, 8 << 20
SCHEMA = "sensor_timestamp_us long, channels array<int>"


def framed(payload: bytes) -> bytes:
    return HEAD.pack(MARK, len(payload), zlib.crc32(payload)) + payload


def store_of(path: str):
    """The file system of a path and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def records(data: bytes, stop: int) -> Iterator[tuple[int, int, bytes | None]]:
    """(start, end, payload) of the whole records that start before stop; a mark whose checksum fails is passed over."""
    at = 0
    while 0 <= (at := data.find(MARK, at)) < stop:
        if len(data) - at < HEAD.size:
            return
        _, n, check = HEAD.unpack_from(data, at)
        payload = data[at + HEAD.size : at + HEAD.size + n]
        if len(payload) == n and zlib.crc32(payload) == check:
            yield at, at + HEAD.size + n, payload
            at += HEAD.size + n
        else:
            at += 1


def whole_end(file, size: int, known: int) -> int:
    """End of the last whole record; what comes after it may still be being written."""
    start = max(known, size - 2 * LONGEST)
    file.seek(start)
    return max([start + end for _, end, _ in records(file.read(size - start), size)], default=known)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


def ranges(path: str, start: int, end: int) -> list[Range]:
    return [Range(path, a, min(end, a + SPLIT)) for a in range(start, end, SPLIT)]


def payloads(part: Range) -> Iterator[bytes]:
    """Packets of the records that start in the range, as bytes; payloads shorter than a packet are passed over."""
    store, inner = store_of(part.path)
    with store.open_input_file(inner) as file:
        file.seek(part.start)
        data = file.read(part.end - part.start + LONGEST)
    for _, _, payload in records(data, part.end - part.start):
        if len(payload) >= PACKET.size:
            yield payload[: PACKET.size]


def read_range(part: Range) -> Iterator[tuple[int, list[int]]]:
    """Packets of the records that start in the range."""
    for payload in payloads(part):
        clock, *channels = PACKET.unpack(payload)
        yield clock, channels


def read_batches(part: Range) -> Iterator[pa.RecordBatch]:
    """The same in batches."""
    found = payloads(part)
    while some := list(islice(found, ROWS)):
        x = np.frombuffer(b"".join(some), PAYLOAD)
        channels = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype="i4") * CHANNELS), pa.array(x["channels"].reshape(-1).astype("i4")))
        yield pa.RecordBatch.from_arrays([pa.array(x["clock"].astype("i8")), channels], ["sensor_timestamp_us", "channels"])


def framed_batch(batch: pa.RecordBatch) -> bytes:
    """The records of a batch's packets; rows without a clock or with another number of channels are passed over."""
    clock, channels = batch.columns
    batch = batch.filter(pc.fill_null(pc.and_(clock.is_valid(), pc.equal(pc.list_value_length(channels), CHANNELS)), False))
    if not batch.num_rows:
        return b""
    clock, values = batch.column(0).to_numpy(), batch.column(1).flatten()
    if values.null_count:
        raise ValueError("a packet lacks a channel")
    values = values.to_numpy()
    if clock.min() < 0 or values.min() < -32768 or values.max() > 32767:
        raise ValueError("a clock below 0, or a channel beyond 16 bits")
    out = np.zeros(batch.num_rows, RECORD)
    out["mark"], out["n"], out["payload"]["clock"], out["payload"]["channels"] = MARK, PACKET.size, clock, values.reshape(-1, CHANNELS)
    packed, size = out["payload"].tobytes(), PACKET.size
    out["check"] = [zlib.crc32(packed[k : k + size]) for k in range(0, len(packed), size)]
    return out.tobytes()


def packet_files(path: str) -> dict[str, int]:
    from pyarrow import fs

    store, inner = store_of(path)
    scheme = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    found = store.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))
    return {scheme + f.path: f.size for f in found if f.type == fs.FileType.File and f.path.endswith(".pkt")}


class Stream(DataSourceStreamReader):
    """Offsets are the bytes of each file that have been read."""

    def __init__(self, path: str):
        self.path, self.known = path, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        for path, size in packet_files(self.path).items():
            if size > self.known.get(path, 0):
                store, inner = store_of(path)
                with store.open_input_file(inner) as file:
                    self.known[path] = whole_end(file, size, self.known.get(path, 0))
        return dict(self.known)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [r for path, size in sorted(end.items()) for r in ranges(path, start.get(path, 0), size)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_batches(partition)


class Batch(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> Sequence[InputPartition]:
        return [r for path, size in sorted(packet_files(self.path).items()) for r in ranges(path, 0, size)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_batches(partition)


@dataclass
class Written(WriterCommitMessage):
    path: str


class Writer(DataSourceArrowWriter):
    """A task writes a hidden file; the commit gives those of the tasks that succeeded their names."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, inner = store_of(self.path)
        store.create_dir(inner, recursive=True)
        name = f"{inner}/_{uuid.uuid4().hex}"
        with store.open_output_stream(name) as out:
            for batch in iterator:
                out.write(framed_batch(batch))
        return Written(name)

    def commit(self, messages: list[Written]) -> None:
        store, inner = store_of(self.path)
        for m in messages:
            if m is not None:
                store.move(m.path, f"{inner}/{m.path.rpartition('/_')[2]}.pkt")

    def abort(self, messages: list[Written]) -> None:
        store, _ = store_of(self.path)
        for m in messages:
            if m is not None:
                store.delete_file(m.path)


class Packets(DataSource):
    """Format "packets"; the option path is a folder that the driver and all executors see."""

    @classmethod
    def name(cls) -> str:
        return "packets"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Batch:
        return Batch(self.options["path"])

    def streamReader(self, schema: StructType) -> Stream:
        return Stream(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"])
