"""The lake: parquet extracts of the source tables, partitioned by extract date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.schemas import EXTRACT_COLUMNS, SourceTable


def path_of(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def read_if_exists(reader, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at exactly this path, or None when there is nothing."""
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def extracted_on(date: dt.date) -> Column:
    """Condition on the partition columns, so that other days are not even listed."""
    year, month, day = EXTRACT_COLUMNS
    return (F.col(year) == date.year) & (F.col(month) == date.month) & (F.col(day) == date.day)


def extracted_before(date: dt.date) -> Column:
    year, month, day = (F.col(c) for c in EXTRACT_COLUMNS)
    return (year < date.year) | (
        (year == date.year)
        & ((month < date.month) | ((month == date.month) & (day < date.day)))
    )


def extracted_between(after: dt.date | None, until: dt.date) -> Column:
    """Condition on the partition columns: days after one (all, if None) up to another."""
    upto = extracted_before(until + dt.timedelta(days=1))
    return upto if after is None else upto & ~extracted_before(after + dt.timedelta(days=1))


def read_lake(
    spark: SparkSession, root: str, table: SourceTable, extract_date: dt.date | None = None
) -> DataFrame | None:
    """Rows of one extract day, or of the whole history; None when the table does not exist."""
    df = read_if_exists(spark.read.schema(table.lake_schema), path_of(root, table.name))
    if df is None or extract_date is None:
        return df
    return df.where(extracted_on(extract_date))


def missing_or_empty(df: DataFrame | None) -> bool:
    """Whether a step that needs these rows is to be skipped."""
    return df is None or df.isEmpty()


def high_watermark(lake: DataFrame, incremental_col: str) -> dt.date | None:
    """Latest day in the lake; only the one column is read."""
    return lake.agg(F.max(incremental_col).cast("date").alias("day")).first()["day"]


@dataclass(frozen=True)
class Extract:
    """What is noted of an extract: its day, the latest day of change in it (None without any), its rows."""

    day: dt.date
    latest: dt.date | None
    n: int


def note_extract(spark: SparkSession, root: str, table: SourceTable, date: dt.date) -> Extract:
    """Note an extract that was written; only its own rows are read, of one column."""
    rows = read_lake(spark, root, table, date)
    row = rows.agg(F.max(table.incremental_col).cast("date").alias("latest"), F.count(F.lit(1)).alias("n")).first()
    noted = spark.createDataFrame([(date, row["latest"], row["n"])], "day date, latest date, n long")
    noted.coalesce(1).write.mode("overwrite").parquet(f"{path_of(root, 'extracts')}/{table.name}/{date:%Y%m%d}")
    return Extract(date, row["latest"], row["n"])


def noted_extracts(spark: SparkSession, root: str, table: SourceTable, before: dt.date) -> list[Extract]:
    """What is noted of the extracts before a day: one row each."""
    noted = read_if_exists(spark.read.schema("day date, latest date, n long"), f"{path_of(root, 'extracts')}/{table.name}/*")
    if noted is None:
        return []
    rows = noted.where(F.col("day") < F.lit(before)).collect()
    return sorted((Extract(*row) for row in rows), key=lambda e: e.day)


def held_rows(spark: SparkSession, root: str, table: SourceTable, before: dt.date) -> tuple[DataFrame | None, dt.date | None]:
    """Rows of the extracts before a day among which those of the latest day lie, and that day.

    By what is noted of them, only extracts that reach the latest day are read. Extracts of a lake that has no notes are
    all read.
    """
    lake = read_lake(spark, root, table)
    if lake is None:
        return None, None
    dated = [e for e in noted_extracts(spark, root, table, before) if e.latest is not None]
    if not dated:
        held = lake.where(extracted_before(before))
        return held, high_watermark(held, table.incremental_col)
    latest = max(e.latest for e in dated)
    return lake.where(reduce(or_, [extracted_on(e.day) for e in dated if e.latest == latest])), latest


def incremental_rows(
    source: DataFrame,
    lake: DataFrame | None,
    incremental_col: str,
    keys: Sequence[str] = (),
    strict: bool = False,
    latest: dt.date | None = None,
) -> DataFrame:
    """The source rows that the lake lacks; ``latest`` is the latest day in the lake where it is known.

    Without a lake table, or without any date in it, these are all rows. ``strict`` takes days
    after the latest day in the lake only, so rows changed later on that day are lost.
    Otherwise that day is read again, and what the lake already holds of it is left out by
    ``keys`` and change time.
    """
    if latest is None and lake is not None:
        latest = high_watermark(lake, incremental_col)
    if latest is None:
        return source
    day_after = F.lit(dt.datetime.combine(latest, dt.time()) + dt.timedelta(days=1))
    # a comparison of the bare column reaches the scan of the source
    if strict:
        return source.where(F.col(incremental_col) >= day_after)
    latest_day = F.lit(dt.datetime.combine(latest, dt.time()))
    held = lake.where(F.col(incremental_col) >= latest_day).select(*keys, incremental_col)
    # the lake holds nothing of later days, so their rows are not shuffled to be compared
    later = source.where(F.col(incremental_col) >= day_after)
    again = source.where((F.col(incremental_col) >= latest_day) & (F.col(incremental_col) < day_after))
    again = again.join(held, [*keys, incremental_col], "left_anti").select(*source.columns)
    return later.unionByName(again)


def stamp_extract_date(df: DataFrame, date: dt.date) -> DataFrame:
    """Add the three partition columns of the lake."""
    parts = (date.year, date.month, date.day)
    return df.withColumns({c: F.lit(v) for c, v in zip(EXTRACT_COLUMNS, parts)})


def write_extract(df: DataFrame, root: str, table: str, partition_by: Sequence[str] = ()) -> None:
    """Add an extract; a second run for the same day replaces the rows of that day."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(partition_by or EXTRACT_COLUMNS))
        .parquet(path_of(root, table))
    )


def append_rows(df: DataFrame, root: str, table: str, partition_by: Sequence[str] = ()) -> None:
    """Plain append, for callers that guard against repeats themselves."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path_of(root, table))
