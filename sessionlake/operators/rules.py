"""Issue rules over statistics: each is a code, a severity, a condition and what it found."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lowest and wanted rates in Hz by kind of stream.
RATES = {"visual": (20.0, 30.0), "visual_legacy": (6.0, 8.0), "pressure": (80.0, 200.0), "robot": (10.0, 100.0), "gripper": (10.0, 100.0)}


@dataclass(frozen=True)
class Rule:
    code: str
    severity: str
    when: str
    found: str = "0"


#: Stream rules, over columns of a statistics row of (session, modality).
STREAM_RULES = (
    Rule("empty_csv", "error", "present and n_rows = 0"),
    Rule("missing_timestamp_column", "warn", "n_rows > 0 and n = 0", "n_rows"),
    Rule("non_monotonic_timestamps", "warn", "reversals > 0", "reversals"),
    Rule("duplicate_timestamps", "warn", "duplicates > 0", "duplicates"),
    Rule("empty_cells", "warn", "empty_cells > 0", "empty_cells"),
    Rule("low_frequency", "warn", "hz_mean < min_hz", "n"),
    Rule("adc_out_of_range", "warn", "bad_values > 0", "bad_values"),
    Rule("missing_required_modality", "error", "required and not present"),
    Rule("csv_decode_error", "error", "undecodable"),
    Rule("csv_parse_error", "error", "unparsable and not undecodable"),
    Rule("nonstandard_pressure_schema", "warn", "modality = 'pressure' and (channels <> 20 or missing_channels > 0 or extra_channels > 0)", "channels"),
    Rule("large_sync_offset", "warn", "modality = 'aligned_timesteps' and rows_over_offset > 0", "rows_over_offset"),
)
#: Rules of image folders and of JSON files.
IMAGE_RULES = (
    Rule("empty_image_dir", "error", "present and images = 0"),
    Rule("zero_size_files", "error", "zero_size > 0", "zero_size"),
    Rule("missing_frame_ids", "warn", "missing_ids > 0", "missing_ids"),
    Rule("low_frequency", "warn", "hz_mean < min_hz", "images"),
)
JSON_RULES = (Rule("json_parse_error", "error", "unparsable"),)
#: Session rules: frames, images and layout.
SESSION_RULES = (
    Rule("unknown_session_layout", "error", "data_format = 'unknown'"),
    Rule("missing_aligned_timesteps", "warn", "data_format = 'dual_realsense' and not has_aligned"),
    Rule("no_complete_visual_frames", "error", "complete_frames = 0"),
    Rule("visual_count_mismatch", "warn", "max_frames <> complete_frames", "max_frames - complete_frames"),
    Rule("frames_csv_count_mismatch", "warn", "frames_rows <> complete_frames", "frames_rows - complete_frames"),
    Rule("missing_frame_ids", "warn", "missing_ids > 0", "missing_ids"),
    Rule("zero_size_files", "error", "zero_size > 0", "zero_size"),
    Rule("known_incomplete_arm_view", "info", "incomplete_arm_view"),
)


def issues(stats: DataFrame, rules: tuple[Rule, ...], keys: list[str]) -> DataFrame:
    """A row (keys, code, severity, found) for each rule that holds; rules over columns that stats lacks are left out."""
    columns = set(stats.columns)
    usable = [r for r in rules if not {w for w in _words(r.when + " " + r.found) if w not in columns}]
    made = F.array(*(F.when(F.expr(r.when), F.struct(F.lit(r.code).alias("code"), F.lit(r.severity).alias("severity"), F.expr(r.found).cast("long").alias("found"))) for r in usable))
    return stats.select(*keys, F.explode(F.array_compact(made)).alias("i")).select(*keys, "i.code", "i.severity", "i.found")


def _words(condition: str) -> set[str]:
    import re

    return set(re.findall(r"[a-z_]+", re.sub(r"'[^']*'", "", condition))) - {"and", "or", "not", "is", "null"}


def severity_pivot(found: DataFrame, by: str) -> DataFrame:
    return found.groupBy(by).agg(*(F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in ("error", "warn", "info")))


def counters(found: DataFrame, columns: list[str]) -> DataFrame:
    """Counts by each column on its own, in one pass: kind, key, n."""
    sets = found.groupingSets([[F.col(c)] for c in columns], *(F.col(c) for c in columns)).agg(F.grouping_id().alias("_g"), F.count("*").alias("n"))
    full = (1 << len(columns)) - 1
    kind, key = F.lit(None), F.lit(None)
    for k, c in enumerate(columns):
        mask = full - (1 << (len(columns) - 1 - k))
        kind = F.when(F.col("_g") == mask, F.lit(c)).otherwise(kind)
        key = F.when(F.col("_g") == mask, F.col(c).cast("string")).otherwise(key)
    return sets.select(kind.alias("kind"), key.alias("key"), "n")


def modality_rollup(stats: DataFrame) -> DataFrame:
    """Over sessions where the modality is present: sessions, total, least, most and mean rows, mean/min/max rate."""
    present = stats.filter("present")
    return present.groupBy("modality").agg(
        F.count("*").alias("sessions_present"), F.sum("n").alias("total"), F.min("n").alias("min_count"), F.max("n").alias("max_count"), F.avg("n").alias("mean_count"),
        F.avg("hz_mean").alias("mean_hz"), F.min("hz_mean").alias("min_hz_seen"), F.max("hz_mean").alias("max_hz_seen"))


#: Lowest good and fair values by kind; of errors, for which less is better, what they must stay below.
BANDS = {"rate_share": (0.9, 0.7), "camera_hz": (27.0, 20.0), "robot_hz": (108.0, None), "gripper_hz": (108.0, None), "pressure_hz": (180.0, 120.0), "success_pct": (80.0, 50.0)}
ERROR_BANDS = {"reprojection_px": ((0.5,), (1.0,)), "hand_eye": ((2.0, 10.0), (5.0, 30.0))}


def status(kind: str, value: Column) -> Column:
    """good, fair or poor by the kind's table; a kind without a fair value has good and fair only. Null is poor."""
    good, fair = BANDS[kind]
    rest = F.lit("fair") if fair is None else F.when(value >= fair, "fair").otherwise("poor")
    return F.when(value >= good, "good").otherwise(rest)


def error_status(kind: str, *values: Column) -> Column:
    """good, fair or poor: every value below the kind's limits."""
    out = F.lit("poor")
    for name, limits in (("fair", ERROR_BANDS[kind][1]), ("good", ERROR_BANDS[kind][0])):
        below = [v < x for v, x in zip(values, limits, strict=True)]
        whole = below[0]
        for b in below[1:]:
            whole = whole & b
        out = F.when(whole, name).otherwise(out)
    return out


def band(value: Column, good: float, fair: float) -> Column:
    return F.when(value >= good, "good").when(value >= fair, "fair").otherwise("poor")
