"""Named queries over the driver's tables with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with DuckDB SQL for the same rows where there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream: session, row_index, t, arrival (a shuffled order of arrival), value, code, modality."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("session"), F.col("event_id").alias("row_index"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t"),
        ((F.col("event_id") * 7919) % 1000003).alias("arrival"), "value", F.get_json_object("props", "$.k").cast("long").alias("code"), F.col("event_type").alias("modality"))


#: The same in SQL.
EV = """ev as (select user_id as session, event_id as row_index, epoch_us(ts) as t, (event_id * 7919) % 1000003 as arrival, value,
    (props->>'$.k')::bigint as code, event_type as modality from events)"""


def of(stream: DataFrame, modality: str) -> DataFrame:
    return stream.filter(F.col("modality") == modality)


def r6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def rounded(c: Column, places: int = 6) -> Column:
    return F.round(c, places)


def thousandths(c: Column) -> Column:
    """A double that isn't negative, rounded to thousandths as SQL rounds it: the whole number next to 1000 times the double, not to its shortest decimal text."""
    return F.floor(c * 1000 + 0.5) / 1000
