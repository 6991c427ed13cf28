"""Row lookups by condition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def find_many(df: DataFrame, *conditions: Column | str, limit: int | None = None) -> DataFrame:
    """Rows meeting all conditions; ``limit`` is for callers that want any few of them."""
    for condition in conditions:
        df = df.where(condition)
    return df if limit is None else df.limit(limit)


def find_one(df: DataFrame, *conditions: Column | str, order: Sequence[Column | str] = ()) -> DataFrame:
    """One row meeting all conditions: the first by ``order``, any one without it."""
    found = find_many(df, *conditions)
    return (found.orderBy(*order) if order else found).limit(1)
