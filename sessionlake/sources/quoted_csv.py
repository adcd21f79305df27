"""CSV with quoted cells, line ends in them too, where one file is read by many tasks.

Spark's reader splits files at line ends, and whether a line end is one of a record depends on all quotes before it. A line
takes a reader that is at a record's start, or in an open quote, to one of the two again; that is a function of two values, and
functions of lines are put together: within a split by the task that reads it, over the splits of a file by a scan of one
function each. A second pass over the files then knows each split's state and cuts its records where they lie; only
records that lie in several splits are shuffled.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlake.session import small, stage

#: The rest of a quoted cell after its opening quote, with what follows it up to the comma; cells after each other.
REST = r'[^"]*+(?:""[^"]*+)*+"[^,]*+'
CELLS = rf'(?:"{REST}|(?:[^",][^,]*+)?+)(?:,(?:"{REST}|(?:[^",][^,]*+)?+))*+'
FROM_START, FROM_QUOTE = re.compile(CELLS, re.S), re.compile(rf'{REST}(?:,(?:{CELLS}))?+', re.S)
CELL = re.compile(r'"([^"]*+(?:""[^"]*+)*+)(?:"([^,]*+))?|([^,]*+)', re.S)
#: Functions of the state (0: at a record's start, 1: in a quote): the same, the other, always 0, always 1.
SAME, OTHER, START, QUOTE = 0, 1, 2, 3
#: Splits whose states may be broadcast, a path and some numbers each.
BROADCAST_SPLITS = 20_000
#: Characters of a line that Python's csv module may read at once.
CSV_LIMIT = 100_000


def line_function(line: str) -> int:
    """Where a line takes a reader from either state."""
    if '"' not in line:
        return SAME
    after = (0 if FROM_START.fullmatch(line) else 1, 0 if FROM_QUOTE.fullmatch(line) else 1)
    return {(0, 1): SAME, (1, 0): OTHER, (0, 0): START, (1, 1): QUOTE}[after]


def split_record(text: str) -> list[str]:
    """The cells of a record: a quote at a cell's start opens it, doubled ones are one, what follows the closing one belongs to it."""
    if '"' not in text:
        return text.split(",")
    out, at = [], 0
    while True:
        m = CELL.match(text, at)
        out.append(m[3] if m[1] is None else m[1].replace('""', '"') + (m[2] or ""))
        at = m.end() + 1
        if at > len(text):
            return out


def line_functions(lines: pa.Array) -> list[int]:
    """line_function of each line; it depends on where quotes, commas and anything else stand, and few lines differ in that."""
    forms = pc.dictionary_encode(pc.replace_substring_regex(lines, '[^",]+', "x"))
    of = [line_function(form) for form in forms.dictionary.to_pylist()]
    return [of[k] for k in forms.indices.to_pylist()]


def _after(state: int, f: int) -> int:
    return (state, 1 - state, 0, 1)[f]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(path, split) and the rows of it that a batch has; a task reads the lines of a split one after the other."""
    for batch in batches:
        ends = sorted({e for c in ("path", "split") for e in pc.run_end_encode(batch.column(c)).run_ends.to_pylist()})
        for start, end in zip([0, *ends], ends):
            part = batch.slice(start, end - start)
            yield (part.column("path")[0].as_py(), part.column("split")[0].as_py()), part


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split: e0, e1, the state after it, and n0, n1, the records that begin in it, if a reader comes to it in state 0 or 1."""
    names = ["path", "split", "e0", "e1", "n0", "n1"]
    row = lambda at, e, n: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*at, *e, *n), (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names)
    now, e, n = None, [0, 1], [0, 0]
    for at, part in _segments(batches):
        if at != now:
            if now:
                yield row(now, e, n)
            now, e, n = at, [0, 1], [0, 0]
        lines = part.column("line")
        filled = pc.invert(pc.is_in(lines, pa.array(["", "\r"]))).to_pylist()
        for s in (0, 1):
            state, begun = e[s], 0
            for f, some in zip(line_functions(lines), filled, strict=True):
                if state == 0:
                    begun += some
                if f:
                    state = _after(state, f)
            e[s], n[s] = state, n[s] + begun
    if now:
        yield row(now, e, n)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, record, row of the records that lie in one split, and path, record, split, text (without row) of the parts of others."""
    names, kinds = ["path", "record", "split", "text", "row"], (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()))

    def made(at: tuple, rows: list[tuple]) -> pa.RecordBatch:
        columns = ([at[0]] * len(rows), [r[0] for r in rows], [at[1]] * len(rows), [r[1] for r in rows], [r[2] for r in rows])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    now, state, record, held, whole = None, 0, -1, [], False
    for at, part in _segments(batches):
        if at != now:
            if held:
                yield made(now, [(record, "\n".join(held), None)])
            now, state, record, held, whole = at, part.column("entry")[0].as_py(), part.column("records")[0].as_py() - 1, [], False
        lines = part.column("line")
        functions = line_functions(lines)
        plain = state == 0 and record >= 0 and not {OTHER, QUOTE} & set(functions)  # each line is a record
        if plain and pc.max(pc.binary_length(lines)).as_py() <= CSV_LIMIT and not pc.any(pc.match_substring(lines, "\r")).as_py():
            rows = list(csv.reader(lines.filter(pc.not_equal(lines, "")).to_pylist()))
            columns = [pa.repeat(at[0], len(rows)), pa.array(range(record + 1, record + 1 + len(rows)), pa.int64()), pa.repeat(pa.scalar(at[1], pa.int64()), len(rows)), pa.nulls(len(rows), pa.string()), pa.array(rows, pa.list_(pa.string()))]
            record += len(rows)
            yield pa.RecordBatch.from_arrays(columns, names)
            continue
        rows = []
        for line, f in zip(lines.to_pylist(), functions, strict=True):
            if state == 0:
                if line in ("", "\r"):
                    continue
                record, whole = record + 1, True
            held.append(line)
            state = _after(state, f)
            if state == 0:
                text = "\n".join(held)
                rows.append((record, None, _cells(text, record)) if whole else (record, text, None))
                held = []
        yield made(at, rows)
    if held:
        yield made(now, [(record, "\n".join(held), None)])


def _cells(text: str, record: int) -> list[str]:
    return split_record((text.removeprefix("\ufeff") if record == 0 else text).removesuffix("\r"))


def _state(before: Column, turns: Column, last: Column) -> Column:
    """The state after lines: `last` is their last constant function with the turns up to it, `turns` all of them."""
    return F.coalesce(F.pmod(last["to"] + turns - last["turns"], F.lit(2)), F.pmod(before + turns, F.lit(2)))


def read_records(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """path, record (from 0), row (its cells) of CSV files, as Python's csv module reads them.

    Doubled quotes in quoted cells are one, quotes within unquoted cells stay as they are, empty lines between records are
    skipped without a number, an open quote at the end of a file ends with it. A file is as many tasks as
    spark.sql.files.maxPartitionBytes makes of it; files are read twice, and the rows are staged.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "\n").text(path)
    lines = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    sums = lines.drop("at").mapInArrow(_functions, "path string, split long, e0 int, e1 int, n0 long, n1 long")
    # over a file's splits, a row each: the function of all before as the states that it makes of 0 and, if constant, of anything
    order = Window.partitionBy("path").orderBy("split")
    moved = (F.col("e0") == 1) & (F.col("e1") == 0)
    sums = sums.withColumn("turns", F.sum(moved.cast("int")).over(order)).withColumn("to", F.when(F.col("e0") == F.col("e1"), F.struct(F.col("e0").alias("to"), F.col("turns").alias("turns"))))
    sums = sums.withColumn("to", F.last("to", True).over(order)).withColumn("end", _state(F.lit(0), F.col("turns"), F.col("to")))
    sums = sums.withColumn("entry", F.coalesce(F.lag("end").over(order), F.lit(0))).withColumn("n", F.when(F.col("entry") == 0, F.col("n0")).otherwise(F.col("n1")))
    entries = sums.select("path", "split", "entry", (F.sum("n").over(order) - F.col("n")).alias("records"))

    entries = stage(entries, "split-entries")
    known = small(entries, BROADCAST_SPLITS)
    placed = lines.join(known, ["path", "split"])
    if known is entries:  # a join that shuffles leaves a split's lines in any order
        placed = placed.repartition("path", "split").sortWithinPartitions("path", "split", "at")
    placed = stage(placed.select("path", "split", "entry", "records", "line").mapInArrow(_cut, "path string, record long, split long, text string, row array<string>"), "record-parts")
    parts = placed.filter("row is null").groupBy("path", "record").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "text"))), lambda x: x["text"]), "\n").alias("text"))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_cells(text, n) for text, n in zip(batch.column("text").to_pylist(), batch.column("record").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("record"), pa.array(rows, pa.list_(pa.string()))], ["path", "record", "row"])

    return placed.filter("row is not null").select("path", "record", "row").union(parts.mapInArrow(cells, "path string, record long, row array<string>"))


def read_quoted_csv(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """CSV files by their own headers: path, row_index (from 0), header (trimmed), cells (map of column to text).

    A file's first record is its header, of columns of one name the last counts; short rows have empty cells, cells beyond
    the header are left out.
    """
    parsed = read_records(spark, path, glob)
    names = F.transform(F.col("row"), lambda x: F.trim(x))
    headers = parsed.filter("record = 0").select("path", names.alias("header"))
    named = F.arrays_zip(F.col("header").alias("k"), F.sequence(F.lit(0), F.size("header") - 1).alias("i"))
    headers = headers.withColumn("last", F.filter(named, lambda x: ~F.array_contains(F.slice(F.col("header"), x["i"] + 2, F.size("header")), x["k"])))
    rows = parsed.filter("record > 0").join(headers, "path")
    cells = F.map_from_entries(F.transform("last", lambda x: F.struct(x["k"], F.coalesce(F.get("row", x["i"]), F.lit("")))))
    return rows.select("path", (F.col("record") - 1).alias("row_index"), "header", cells.alias("cells"))


def read_quoted_columns(spark: SparkSession, path: str, names: list[str], glob: str = "*.csv") -> DataFrame:
    """path, row_index and a text column for each name, as read_quoted_csv finds it in cells; null where a file lacks it."""
    parsed = read_records(spark, path, glob)
    trimmed = parsed.filter("record = 0").select("path", F.transform("row", lambda x: F.trim(x)).alias("header"))
    headers = trimmed.select("path", *(F.when(F.array_contains("header", name), F.size("header") - F.array_position(F.reverse("header"), name).cast("int")).alias(f"_place{k}") for k, name in enumerate(names)))
    cell = lambda k: F.when(F.col(f"_place{k}").isNotNull(), F.coalesce(F.get("row", F.col(f"_place{k}")), F.lit("")))
    return parsed.filter("record > 0").join(headers, "path").select("path", (F.col("record") - 1).alias("row_index"), *(cell(k).alias(name) for k, name in enumerate(names)))
