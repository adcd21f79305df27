"""Typed tables of recordings, channel configuration, and reports for people."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.functions import parse
from sessionlake.operators.manifest import COLUMNS
from sessionlake.sources.quoted_csv import read_quoted_columns

#: Columns of the simulated gripper's force log, of preview sheets and of range annotations.
FORCES = "step long, phase int, phase_name string, finger1_fx double, finger1_fy double, finger1_fz double, finger2_fx double, finger2_fy double, finger2_fz double"
SHEETS = "sheet_id string, split string, sheet_index int, sheet_path string, session_count int, start_session string, end_session string, start_date string, start_time string, end_date string, end_time string"
NOTES = "split string, sheet_id string, row_start int, row_end int, task_id string, confidence string, evidence string, notes string"
#: The manifest's whole and decimal numbers.
_LONGS = frozenset("usable_for_rgb usable_for_rgbd usable_for_aligned_training visual_complete_frames frames_rows aligned_rows pressure_rows pressure_channel_count robot_rows gripper_rows".split())
_DOUBLES = frozenset("pressure_hz robot_hz gripper_hz".split())
MANIFEST = ", ".join(f"{c} {'long' if c in _LONGS else 'double' if c in _DOUBLES else 'string'}" for c in COLUMNS)


def _value(text: Column, kind: str) -> Column:
    if kind in ("bigint", "int"):
        return parse.safe_int(text).cast(kind)
    return parse.safe_float(text) if kind == "double" else text.cast(kind)


def typed(cells: DataFrame, schema: str) -> DataFrame:
    """path, row_index and columns of the schema from cells (map of column to text): a missing column and a number that is none are null."""
    return cells.select("path", "row_index", *(_value(F.try_element_at("cells", F.lit(f.name)), f.dataType.simpleString()).alias(f.name) for f in StructType.fromDDL(schema)))


def read_table(spark: SparkSession, path: str, schema: str, glob: str = "*.csv") -> DataFrame:
    """CSV files bound to the schema by their headers, with quoted cells: path, row_index and the schema's columns, as typed() has them."""
    fields = list(StructType.fromDDL(schema))
    rows = read_quoted_columns(spark, path, [f.name for f in fields], glob)
    return rows.select("path", "row_index", *(_value(F.col(f.name), f.dataType.simpleString()).alias(f.name) for f in fields))


def grip_forces(rows: DataFrame, by: str = "path", rest: int = 0) -> DataFrame:
    """Adds grip, the two fingers' |fx| less their mean over the rest phase; null without such rows."""
    base = rows.filter(F.col("phase") == rest).groupBy(F.col(by).alias("_by")).agg(F.avg("finger1_fx").alias("_b1"), F.avg("finger2_fx").alias("_b2"))
    met = rows.join(base, F.col(by) == F.col("_by"), "left")
    return met.withColumn("grip", F.abs(F.col("finger1_fx") - F.col("_b1")) + F.abs(F.col("finger2_fx") - F.col("_b2"))).drop("_by", "_b1", "_b2")


@dataclass(frozen=True)
class Channels:
    """A sensor's channels in the order of their columns, and the neighbours of those that are broken."""

    order: tuple[int, ...]
    neighbours: dict[int, tuple[int, ...]]

    @classmethod
    def parse(cls, text: str) -> Channels:
        """From the mapping's JSON: a left and a right channel, two matrices of channels, and channels to interpolate."""
        m = json.loads(text)
        flat = [int(m["LEFT_CHANNEL"]), int(m["RIGHT_CHANNEL"]), *(int(c) for side in ("LEFT", "RIGHT") for row in m[f"{side}_MATRIX_CHANNELS"] for c in row)]
        return cls(tuple(flat), {int(k): tuple(map(int, v)) for k, v in m.get("INTERPOLATE_CHANNELS", {}).items()})

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Channels:
        """A mapping file, which is one small text."""
        return cls.parse(spark.read.text(path, wholetext=True).first()[0])

    def value(self, values: Column, channel: Column, default: int = 0) -> Column:
        """A channel's value in an array in column order, by its number; the default for other channels and short arrays."""
        place = F.array_position(F.array(*map(F.lit, self.order)), channel)
        return F.coalesce(F.when(place > 0, F.get(values, (place - 1).cast("int"))), F.lit(default))

    def table(self, spark: SparkSession) -> DataFrame:
        """channel, place, neighbours (empty where it is sound)."""
        return spark.createDataFrame([(c, k, list(self.neighbours.get(c, ()))) for k, c in enumerate(self.order)], "channel int, place int, neighbours array<int>")


def repaired_aligned(rows: DataFrame, channels: Channels, prefix: str = "pressure_CH") -> DataFrame:
    """Aligned rows whose broken channels are their neighbours' mean, cut to an integer, once more after interpolation.

    A row in which any neighbour is missing keeps what it has; channels that the rows lack are passed over.
    """
    there, made = set(rows.columns), {}
    for bad, near in channels.neighbours.items():
        name, of = f"{prefix}{bad}", [f"{prefix}{n}" for n in near]
        if name in there and of and set(of) <= there:
            mean = sum((F.col(c) for c in of[1:]), F.col(of[0])) / float(len(of))
            made[name] = F.coalesce(mean.cast("long").cast("double"), F.col(name).cast("double"))
    return rows.withColumns(made) if made else rows


def summary_lines(title: str, facts: DataFrame, counters: DataFrame, modalities: DataFrame, samples: DataFrame) -> DataFrame:
    """The audit's summary as lines of Markdown: place, line.

    facts (place, name, value), counters (section, key, n), modalities (modality and six numbers), samples (place, severity,
    session, modality, code, found); of counters the 20 greatest of each section, of samples the first 25 are given. All
    are small tables of counts, but none is gathered in the driver.
    """
    from pyspark.sql import Window

    sections = counters.withColumn("_n", F.row_number().over(Window.partitionBy("section").orderBy(F.desc("n"), "key"))).filter("_n <= 20")
    head = facts.sparkSession.createDataFrame([(0, 0, "", 0, f"# {title}")], "part int, at long, key string, k long, line string")
    fact = facts.select(F.lit(1).alias("part"), F.col("place").cast("long").alias("at"), F.lit("").alias("key"), F.lit(0).cast("long").alias("k"), F.concat(F.lit("- "), "name", F.lit(": "), F.col("value").cast("string")).alias("line"))
    titles = sections.select("section").distinct().select(F.lit(2).alias("part"), F.lit(0).cast("long").alias("at"), F.col("section").alias("key"), F.lit(0).cast("long").alias("k"), F.concat(F.lit("## "), "section").alias("line"))
    counts = sections.select(F.lit(2).alias("part"), F.lit(0).cast("long").alias("at"), F.col("section").alias("key"), F.col("_n").cast("long").alias("k"), F.concat(F.lit("- "), "key", F.lit(": "), F.col("n").cast("string")).alias("line"))
    columns = [c for c in modalities.columns if c != "modality"]
    table = modalities.sparkSession.createDataFrame([(3, 0, "", 0, "## Modality summary"), (3, 0, "", 1, "| modality | " + " | ".join(columns) + " |"), (3, 0, "", 2, "|---|" + "---:|" * len(columns))], head.schema)
    cells = modalities.select(F.lit(3).alias("part"), F.lit(1).cast("long").alias("at"), F.col("modality").alias("key"), F.lit(0).cast("long").alias("k"), F.concat(F.lit("| "), F.concat_ws(" | ", "modality", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit(" |")).alias("line"))
    shown = samples.filter("place < 25").select(F.lit(4).alias("part"), (F.col("place") + 1).cast("long").alias("at"), F.lit("").alias("key"), F.lit(0).cast("long").alias("k"), F.concat(F.lit("- ["), "severity", F.lit("] "), F.col("session").cast("string"), F.lit(" "), "modality", F.lit(" "), "code", F.lit(": "), F.col("found").cast("string")).alias("line"))
    lines = head.union(fact).union(titles).union(counts).union(table).union(cells).union(shown)
    # a report of some hundred lines at most
    return lines.select((F.row_number().over(Window.orderBy("part", "at", "key", "k")) - 1).alias("place"), "line")


def write_lines(lines: DataFrame, folder: str) -> None:
    """The lines of a report in order, as one text."""
    lines.coalesce(1).sortWithinPartitions("place").select("line").write.text(folder)


def write_manifest(manifest: DataFrame, folder: str) -> None:
    """The clean manifest as a pair: CSV in the manifest's columns, and JSON lines of the same rows."""
    rows = manifest.select(*COLUMNS)
    rows.write.option("header", True).option("quote", '"').option("escape", '"').csv(f"{folder}/manifest_csv")
    rows.write.option("ignoreNullFields", False).json(f"{folder}/manifest_json")


def write_pose_log(poses: DataFrame, folder: str, session: str = "session") -> None:
    """Poses by session as JSON lines: time, joints, pose and the key that moved the arm."""
    poses.select(session, "t", "joints", "pose", "key").repartition(session).sortWithinPartitions(session, "t").write.partitionBy(session).json(folder)
