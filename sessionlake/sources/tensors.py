"""Tensor windows as a source and sink of npz archives: one archive a session, read by partitions that filters prune."""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from sessionlake.sources.packets import store_of

SCHEMA = "session string, window_id long, start_us long, end_us long, center_us long, tensor array<array<double>>"
#: Windows of an archive, and rows that a task gives at once; tasks that read one archive each, beyond which a task reads several.
WINDOWS, TASKS = 4096, 512
NUMBERS = ("window_id", "start_us", "end_us", "center_us")
COMMITTED = "_committed"


def archive_name(session: str, part: str) -> str:
    return f"{quote(session, safe='')}__{part}.npz"


def session_of(name: str) -> str:
    return unquote(name.rpartition("__")[0])


@dataclass
class Archive(InputPartition):
    path: str
    session: str
    more: tuple[tuple[str, str], ...] = ()


def batch_of(session: str, numbers: Sequence[np.ndarray], data: np.ndarray) -> pa.RecordBatch:
    """Windows of a session with their tensors, windows by rows by channels."""
    n, rows, channels = data.shape
    inner = pa.ListArray.from_arrays(pa.array(np.arange(n * rows + 1, dtype="i4") * channels), pa.array(data.reshape(-1).astype("f8")))
    tensor = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="i4") * rows), inner)
    return pa.RecordBatch.from_arrays([pa.array([session] * n, pa.string()), *(pa.array(x.astype("i8")) for x in numbers), tensor], ["session", *NUMBERS, "tensor"])


def tensors_of(column: pa.Array) -> np.ndarray:
    """The tensors of a column as windows by rows by channels; a missing number is NaN, unlike shapes are an error."""
    rows = column.flatten()
    values = rows.flatten().to_numpy(zero_copy_only=False).astype("f8")
    tall, wide = column.value_lengths().unique(), rows.value_lengths().unique()
    if len(tall) != 1 or len(wide) > 1 or column.null_count or rows.null_count:
        raise ValueError("tensors of unlike shapes in one archive")
    return values.reshape(len(column), tall[0].as_py(), wide[0].as_py() if len(wide) else 0)


class TensorReader(DataSourceReader):
    """A partition an archive, or several where there are very many."""

    def __init__(self, path: str):
        self.path, self.wanted = path, None

    def partitions(self) -> Sequence[InputPartition]:
        found = [(p, s) for p, s in committed(self.path) if self.wanted is None or s in self.wanted]
        each = -(-len(found) // TASKS) or 1
        return [Archive(*found[k], tuple(found[k + 1 : k + each])) for k in range(0, len(found), each)]

    def read(self, partition: Archive | None) -> Iterator[pa.RecordBatch]:
        for path, session in ((partition.path, partition.session), *partition.more) if partition else ():
            store, inner = store_of(path)
            with store.open_input_file(inner) as file, np.load(io.BytesIO(file.readall()), allow_pickle=False) as z:
                yield batch_of(session, [z[c] for c in NUMBERS], z["data"])


class PruningReader(TensorReader):
    """session = and session in (...) leave the other archives unopened."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("session",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f


def committed(path: str) -> list[tuple[str, str]]:
    """Archives and their sessions that a committed write names; others are left by tasks that failed."""
    from pyarrow import fs

    store, inner = store_of(path)
    scheme = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    out = []
    for f in store.get_file_info(fs.FileSelector(f"{inner}/{COMMITTED}", allow_not_found=True)):
        with store.open_input_file(f.path) as file:
            out += [(f"{scheme}{inner}/{name}", session_of(name)) for name in json.loads(file.readall())]
    return sorted(out)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class TensorWriter(DataSourceArrowWriter):
    """Rows come clustered by session; archives of failed or repeated tasks are never named in a commit."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        names: list[str] = []
        held: list[pa.RecordBatch] = []
        session, n = None, 0
        for batch in iterator:
            at, keys = 0, batch.column(0).to_pylist()
            while at < len(keys):
                if held and (keys[at] != session or n == WINDOWS):
                    names.append(self._archive(session, held))
                    held, n = [], 0
                session, start = keys[at], at
                while at < len(keys) and keys[at] == session and n < WINDOWS:
                    at, n = at + 1, n + 1
                held.append(batch.slice(start, at - start))
        if held:
            names.append(self._archive(session, held))
        return Written(names)

    def _archive(self, session: str, held: list[pa.RecordBatch]) -> str:
        store, inner = store_of(self.path)
        store.create_dir(inner, recursive=True)
        name = archive_name(session, uuid.uuid4().hex)
        arrays = {c: np.concatenate([b.column(k).to_numpy() for b in held]) for k, c in enumerate(NUMBERS, 1)}
        out = io.BytesIO()
        np.savez(out, data=np.concatenate([tensors_of(b.column(5)) for b in held]), **arrays)
        with store.open_output_stream(f"{inner}/{name}") as file:
            file.write(out.getvalue())
        return name

    def commit(self, messages: list[Written]) -> None:
        store, inner = store_of(self.path)
        store.create_dir(f"{inner}/{COMMITTED}", recursive=True)
        temp = f"{inner}/_{uuid.uuid4().hex}"
        with store.open_output_stream(temp) as file:
            file.write(json.dumps([n for m in messages if m is not None for n in m.names]).encode())
        store.move(temp, f"{inner}/{COMMITTED}/{uuid.uuid4().hex}.json")

    def abort(self, messages: list[Written]) -> None:
        store, inner = store_of(self.path)
        for m in messages:
            for name in m.names if m is not None else ():
                store.delete_file(f"{inner}/{name}")


class Tensors(DataSource):
    """Format "tensors"; the option path is a folder that the driver and all executors see, prune = true takes filters (see load)."""

    @classmethod
    def name(cls) -> str:
        return "tensors"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TensorReader:
        return (PruningReader if self.options.get("prune") == "true" else TensorReader)(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> TensorWriter:
        return TensorWriter(self.options["path"])


def load(spark: SparkSession, path: str) -> DataFrame:
    """All archives of committed writes, pruned by filters on session; Spark asks for a session setting to pass filters on."""
    spark.dataSource.register(Tensors)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("tensors").option("path", path).option("prune", "true").load()
