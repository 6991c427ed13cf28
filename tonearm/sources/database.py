"""Source database tables over JDBC, read by many tasks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tonearm.schemas import SourceTable

FETCH_SIZE = 10_000  # fixed value: rows per round trip


def day_predicates(incremental_col: str, first: dt.date, last: dt.date, parts: int) -> list[str]:
    """At most ``parts`` conditions that cover every row once, NULL included.

    Each becomes one task with its own query. The first and last are open ended.
    """
    days = (last - first).days + 1
    parts = max(1, min(parts, days))
    cuts = [first + dt.timedelta(days=days * i // parts) for i in range(1, parts)]
    bounds = [None, *cuts, None]
    conditions = []
    for low, high in zip(bounds, bounds[1:]):
        terms = []
        if low:
            terms.append(f"{incremental_col} >= DATE '{low}'")
        if high:
            terms.append(f"{incremental_col} < DATE '{high}'")
        condition = " AND ".join(terms) or "1 = 1"
        if not low and high:  # the first part also takes the rows without a date
            condition = f"({condition} OR {incremental_col} IS NULL)"
        conditions.append(condition)
    return conditions


def read_table(
    spark: SparkSession,
    url: str,
    table: SourceTable,
    properties: dict[str, str],
    first: dt.date,
    last: dt.date,
    parts: int = 64,
    db_schema: str = "public",
) -> DataFrame:
    """A source table, cut by change day. Filters put on the result run in the database."""
    return spark.read.jdbc(
        url,
        f"{db_schema}.{table.name}",
        predicates=day_predicates(table.incremental_col, first, last, parts),
        properties={"fetchsize": str(FETCH_SIZE), **properties},
    ).select(*table.schema.fieldNames())
