"""Slowly changing dimensions, insert-if-absent and partial-column upsert.

Targets are snapshots: each operator returns the new content, and the caller writes it.
Merge keys are unique on both sides, so no key is hot.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.functions.change import any_differs, same_keys
from tonearm.operators.fold import MASK, masks_not_in, not_in_folded, plain_columns, type_of, unfold, unfolded
from tonearm.operators.lookup import not_in

AUDIT_COLUMNS = ["created_at", "updated_at"]
VERSION_COLUMNS = ["valid_from", "valid_to", "flag"]

# ``delta`` joins the target to the staging rows, which Spark broadcasts when they are small, so
# that the target is not shuffled. ``full`` shuffles both sides once and suits staging tables
# as large as the target.
STRATEGIES = ("delta", "full")


def require_columns(target: DataFrame, staging: DataFrame, besides: Sequence[str]) -> None:
    """Raise when the staging rows lack a column of the target."""
    missing = [c for c in target.columns if c not in besides and c not in staging.columns]
    if missing:
        raise ValueError(f"columns missing in the staging rows: {', '.join(missing)}")


def match_sides(
    target: DataFrame, staging: DataFrame, keys: Sequence[str], strategy: str = "full"
) -> DataFrame:
    """Rows of both sides side by side, as ``t`` and ``s``, unmatched rows included."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {', '.join(STRATEGIES)}")
    target = target.withColumn("_present", F.lit(True)).alias("t")
    staging = staging.withColumn("_present", F.lit(True)).alias("s")
    on = same_keys("t", "s", keys)
    if strategy == "full":
        return target.join(staging, on, "full")
    matched = target.join(staging, on, "left")
    brand_new = staging.join(
        target.join(staging, on, "left_semi").select(*keys).alias("t"), on, "left_anti"
    )
    # the target side of brand-new rows is empty
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    new_rows = brand_new.select(F.struct(*nothing).alias("t"), F.struct("s.*").alias("s"))
    old_rows = matched.select(
        F.struct("t.*").alias("t"),
        F.when(F.col("s._present"), F.struct("s.*")).alias("s"),
    )
    return old_rows.unionByName(new_rows)


def _is_new() -> Column:
    return F.col("t._present").isNull()


def _is_absent() -> Column:
    return F.col("s._present").isNull()


def scd1(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    as_of: dt.datetime,
    compared: Sequence[str] | None = None,
    strategy: str = "delta",
) -> DataFrame:
    """Overwrite changed rows, add new ones, keep the rest.

    Columns are compared one by one with NULL as a value, so a change from or to NULL counts.
    """
    require_columns(target, staging, AUDIT_COLUMNS)
    main = [c for c in target.columns if c not in AUDIT_COLUMNS]
    compared = compared or [c for c in main if c not in keys]
    sides = match_sides(target, staging.select(*main), keys, strategy)
    written = _is_new() | (~_is_absent() & any_differs("t", "s", compared))
    now = F.lit(as_of)
    columns = {c: F.when(written, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) for c in main}
    columns["created_at"] = F.when(_is_new(), now).otherwise(F.col("t.created_at"))
    columns["updated_at"] = F.when(written, now).otherwise(F.col("t.updated_at"))
    return sides.select(*[columns[c].alias(c) for c in target.columns])


def scd2_open_rows(
    open_rows: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    as_of: dt.date,
    compared: Sequence[str] | None = None,
    strategy: str = "delta",
) -> DataFrame:
    """What becomes of the open versions: kept, or closed and followed by a new version.

    One join gives all of it: a changed row yields two rows, any other yields one.
    """
    require_columns(open_rows, staging, VERSION_COLUMNS)
    main = [c for c in open_rows.columns if c not in VERSION_COLUMNS]
    compared = compared or [c for c in main if c not in keys]
    sides = match_sides(open_rows, staging.select(*main), keys, strategy)

    def version(side: str, valid_from: Column, valid_to: Column, flag: Column) -> Column:
        values = {c: F.col(f"{side}.{c}") for c in main}
        values |= {"valid_from": valid_from, "valid_to": valid_to, "flag": flag}
        return F.struct(*[values[c].alias(c) for c in open_rows.columns])

    today, never = F.lit(as_of), F.lit(None).cast("date")
    kept = version("t", F.col("t.valid_from"), F.col("t.valid_to"), F.col("t.flag"))
    closed = version("t", F.col("t.valid_from"), today, F.lit(False))
    opened = version("s", today, never, F.lit(True))
    versions = (
        F.when(_is_new(), F.array(opened))
        .when(_is_absent() | ~any_differs("t", "s", compared), F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    return sides.select(F.explode(versions).alias("v")).select("v.*")


def scd2(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    as_of: dt.date,
    compared: Sequence[str] | None = None,
    strategy: str = "delta",
) -> DataFrame:
    """Close changed versions, open their successors, add new keys; history passes untouched."""
    history = target.where(F.col("valid_to").isNotNull())
    open_rows = target.where(F.col("valid_to").isNull())
    return history.unionByName(
        scd2_open_rows(open_rows, staging, keys, as_of, compared, strategy)
    )


# fixed value: staged rows up to which their keys can be broadcast, so that the target is scanned but not shuffled
FEW_ROWS = 100_000


def key_range(staging: DataFrame, column: str) -> tuple[int | None, int | None]:
    """Lowest and highest partition key of the staging rows."""
    return tuple(staging.agg(F.min(column), F.max(column)).first())


def insert_absent(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    partition_key: str,
    prune: Callable[[int, int], Column] | None = None,
    folded: str | None = None,
) -> DataFrame:
    """The staging rows that the target lacks.

    The range of the partition key is read first, and enters the target filter as literals that
    skip row groups of the target before the anti join. ``prune`` turns the range into a
    condition on the layout column of the target, which skips whole folders. ``folded`` names a
    whole-number key whose values repeat the rest of the row: many staged rows are compared folded by it. Rows staged
    folded come out folded then; the target may be folded too.
    """
    masks = MASK in staging.columns
    number = F.sum(F.coalesce(F.bit_count(MASK), F.lit(1))) if masks else F.count(F.lit(1))
    low, high, n = staging.agg(F.min(partition_key), F.max(partition_key), number).first()
    if low is None:
        return staging
    if prune is not None:
        target = target.where(prune(low, high))
    target = target.where(F.col(partition_key).between(low, high))
    if masks and n > FEW_ROWS:
        return masks_not_in(staging, target, keys, folded)
    if masks:
        dtype = type_of(target, folded) if folded in target.columns else "bigint"
        staging = unfold(staging, folded, plain_columns(staging, folded), dtype)
    elif folded is not None and n > FEW_ROWS:
        return not_in_folded(staging, target, keys, folded)
    return not_in(staging, unfolded(target, folded), keys)


def combine_partial(
    records: DataFrame, keys: Sequence[str], order: Sequence[str], present: str
) -> DataFrame:
    """Fold several partial records per key into one, column by column, later ones winning.

    ``present`` holds the names of the columns a record really carries; a carried NULL wins
    over an older value, a missing column does not.
    """
    values = [c for c in records.columns if c not in (*keys, *order, present)]
    if not values:  # bridges: nothing but keys
        return records.select(*keys).dropDuplicates().withColumn(present, F.array().cast("array<string>"))
    rank = F.struct(*order)
    folded = []
    for column in values:
        # rank and value of the last record carrying the column; NULL when none does
        carried = F.when(
            F.array_contains(present, column),
            F.struct(rank.alias("rank"), F.col(column).alias("value")),
        )
        folded.append(F.max(carried).alias(column))
    names = F.filter(
        F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in values]),
        lambda name: name.isNotNull(),
    )
    return (
        records.groupBy(*keys)
        .agg(*folded)
        .select(*keys, *[F.col(f"{c}.value").alias(c) for c in values], names.alias(present))
    )


def upsert_partial(
    target: DataFrame,
    records: DataFrame,
    keys: Sequence[str],
    as_of: dt.datetime,
    present: str | None = None,
    strategy: str = "delta",
) -> DataFrame:
    """Upsert by key where only the columns a record carries overwrite.

    ``records`` has one row per key. Without ``present`` all its columns are carried.
    ``created_at`` stays, ``updated_at`` moves when a value really changed.
    """
    values = [c for c in target.columns if c not in (*keys, *AUDIT_COLUMNS)]
    offered = [c for c in values if c in records.columns]
    extra = [present] if present else []
    sides = match_sides(target, records.select(*keys, *offered, *extra), keys, strategy)

    def carried(column: str) -> Column:
        if not present:
            return F.lit(True)
        return F.coalesce(F.array_contains(f"s.{present}", column), F.lit(False))

    changed = F.lit(False)
    for column in offered:
        changed = changed | (carried(column) & any_differs("t", "s", [column]))
    changed = ~_is_absent() & changed
    now = F.lit(as_of)
    result = {key: F.coalesce(f"t.{key}", f"s.{key}") for key in keys}
    for column in values:
        old = F.col(f"t.{column}")
        if column in offered:
            taken = ~_is_absent() & carried(column)
            result[column] = F.when(taken, F.col(f"s.{column}")).otherwise(old)
        else:
            result[column] = old
    result["created_at"] = F.when(_is_new(), now).otherwise(F.col("t.created_at"))
    result["updated_at"] = F.when(_is_new() | changed, now).otherwise(F.col("t.updated_at"))
    return sides.select(*[result[c].alias(c) for c in target.columns])
