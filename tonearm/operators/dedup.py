"""Deduplication and distinct counts.

All of these are aggregates, so each map task first reduces its own rows and a key holding a
large share of the rows reaches the reducer as one row per map task. A ``row_number`` window
would send all rows of that key to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.operators.fold import fold, type_of, unfold


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: highest by ``order``, then by the other columns left to right.

    NULL is lower than any value. Nothing is left to chance: equal input gives equal output.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [*order, *rest]
    if not ranked:
        return df.dropDuplicates(list(keys))
    best = F.max(F.struct(*ranked)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*[F.col(f"_best.{c}") if c not in keys else F.col(c) for c in df.columns])


def replacing_latest(df: DataFrame, keys: Sequence[str], offset: str) -> DataFrame:
    """The last inserted row per key, as told by the offset in the stream."""
    return latest_by_key(df, keys, [offset])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row deduplication."""
    return df.dropDuplicates()


def first_rows(df: DataFrame, keys: Sequence[str], folded: str | None = None) -> DataFrame:
    """The distinct key combinations: the rows a row number of 1 would mark, NULL keys included.

    ``folded`` names a whole-number key with many values beside each of the others: its values are held as bits, so
    that tasks hold a row for 64 of them.
    """
    rows = df.select(*keys)
    if folded is None:
        return rows.dropDuplicates()
    return unfold(fold(rows, folded), folded, keys, type_of(df, folded))


def count_first_rows(
    df: DataFrame, unit: Sequence[str], groups: Sequence[str], name: str, **sums: Column
) -> DataFrame:
    """Number of distinct ``unit`` rows per group; ``groups`` must be part of ``unit``.

    Unlike ``count_distinct`` this counts NULL keys and does not merge units when the group is
    coarser than the unit. ``sums`` adds totals of columns that depend on the unit only.
    """
    values = [F.first(column).alias(alias) for alias, column in sums.items()]
    per_unit = df.groupBy(*unit).agg(*values) if values else df.select(*unit).dropDuplicates()
    totals = [F.sum(alias).alias(alias) for alias in sums]
    return per_unit.groupBy(*groups).agg(F.count(F.lit(1)).alias(name), *totals)


def distinct_ids(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct non-NULL ids of several columns as ``(object_name, object_value)`` rows."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("object_name"), F.col(column).alias("object_value"))
            for name, column in columns.items()
        ]
    )
    return (
        df.select(F.explode(pairs).alias("pair"))
        .select("pair.object_name", "pair.object_value")
        .where(F.col("object_value").isNotNull())
        .dropDuplicates()
    )
