"""Daily extract of the source tables into the lake."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tonearm.schemas import SOURCE_TABLES, SourceTable
from tonearm.session import side_by_side
from tonearm.sources import lake

logger = logging.getLogger(__name__)


def ingest_table(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    table: SourceTable,
    extract_date: dt.date,
    strict: bool = False,
) -> int:
    """Write the new rows of one table and return their number; nothing new, nothing written.

    Only extracts of earlier days count as held, so a repeated run of a day writes that day
    anew and whole.
    """
    held, latest = lake.held_rows(spark, root, table, extract_date)
    columns = source.select(*table.schema.fieldNames())
    if held is None or latest is None:  # nothing to compare with
        rows = columns
    else:
        rows = lake.incremental_rows(columns, held, table.incremental_col, table.keys, strict, latest)
    # without rows this touches no partition, so the extract is computed once, not first tested
    lake.write_extract(lake.stamp_extract_date(rows, extract_date), root, table.name)
    count = lake.note_extract(spark, root, table, extract_date).n
    logger.info("%s new rows in %s", count, table.name)
    return count


def ingest_all(
    spark: SparkSession,
    source_of: Callable[[SourceTable], DataFrame | None],
    root: str,
    extract_date: dt.date,
    strict: bool = False,
) -> dict[str, int]:
    """Extract every configured table; ``source_of`` gives its rows, None to leave it out."""
    sources = {table: source_of(table) for table in SOURCE_TABLES.values()}
    asked = [table for table, source in sources.items() if source is not None]

    def job(table: SourceTable) -> Callable[[], int]:
        return lambda: ingest_table(spark, sources[table], root, table, extract_date, strict)

    counts = side_by_side([job(table) for table in asked])
    return {table.name: count for table, count in zip(asked, counts)}
