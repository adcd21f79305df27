"""Parsing of cells, names and log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cells that count as empty.
BLANK = ("", "nan", "null", "none")

#: The 20 channels of the 64 that a tactile sensor has, in the order of their columns.
VALID_CHANNELS = (51, 50, 63, 60, 57, 64, 61, 58, 49, 62, 59, 47, 44, 41, 48, 45, 42, 33, 46, 43)


def safe_float(c: Column) -> Column:
    """A number, or null for what is none, NaN or infinite."""
    x = c.try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def safe_int(c: Column) -> Column:
    """A whole number cut towards zero, or null."""
    return safe_float(c).cast("long")


def is_blank(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(*BLANK)


def session_date(name: Column) -> Column:
    return F.regexp_extract(name, r"session_(\d{8})_(\d{6})", 1)


def session_time(name: Column) -> Column:
    return F.regexp_extract(name, r"session_(\d{8})_(\d{6})", 2)


def data_format(dual: Column, world: Column, wrist: Column) -> Column:
    """Layout of a session by the folders that are there."""
    return F.when(dual, "dual_realsense").when(world & wrist, "legacy_dji_realsense").when(wrist, "legacy_dji_realsense_rgb_only").otherwise("unknown")


def phase_of(kind: Column, date: Column, cut: str = "20260615", legacy: tuple[str, ...] = ("legacy_dji_realsense",)) -> Column:
    """pre_0615 for the legacy layouts named and for sessions dated before the cut, else post_0615."""
    return F.when(kind.isin(*legacy) | ((date != "") & (date < cut)), "pre_0615").when(date >= cut, "post_0615").otherwise("unknown")


def is_noise(line: Column, keep: list[str], patterns: list[str], prefixes: list[str], parts: list[str]) -> Column:
    """Lines that match a noise pattern, prefix or part, unless a word to keep is in them."""
    bad = F.lit(False)
    for x in patterns:
        bad = bad | line.rlike(x)
    for x in prefixes:
        bad = bad | line.startswith(x)
    for x in parts:
        bad = bad | line.contains(x)
    kept = F.lit(False)
    for x in keep:
        kept = kept | line.contains(x)
    return bad & ~kept


def prompt(template: str, **values: Column) -> Column:
    """A template with {names} filled in from columns."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def is_channel(name: Column) -> Column:
    """CH and digits."""
    return name.rlike("^CH[0-9]+$")


def is_offset(name: Column) -> Column:
    return F.endswith(name, F.lit("_offset_ms"))


def channel_or_zero(channels: Column, number: Column) -> Column:
    """A channel of a map by its number, or 0."""
    return F.coalesce(F.try_element_at(channels, number), F.lit(0.0))


def fixed_text(value: Column, places: int = 6) -> Column:
    """A number with so many decimals; whole ones and ends without zeros."""
    return F.regexp_replace(F.regexp_replace(F.format_string(f"%.{places}f", value), "0+$", ""), r"\.$", "")


def positional(cells: Column, places: dict[str, int], least: int) -> list[Column]:
    """Numbers from the cells of a row by their place; all null for a row with fewer cells than `least`."""
    return [F.when(F.size(cells) >= least, safe_float(F.get(cells, F.lit(k)))).alias(name) for name, k in places.items()]


def channels_of(cells: Column, first: int, count: int) -> Column:
    """The whole numbers of `count` cells from `first` on; null unless every one is there and is a number."""
    numbers = F.transform(F.slice(cells, first + 1, count), lambda c: safe_int(c))
    return F.when((F.size(numbers) == count) & F.forall(numbers, lambda x: x.isNotNull()), numbers)
