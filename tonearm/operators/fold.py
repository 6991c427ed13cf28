"""Rows that differ in one whole-number key only, as one row with a bit mask.

Facts repeat a playlist entry for each genre. Folded, the entry is one row, so shuffles, sorts and hash tables hold entries
and not facts. Nothing is lost for any key: 64 values of it share a row, further ones have rows of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD, MASK = "_word", "_mask"
BITS = 64


def _bit(value: Column) -> Column:
    one = F.lit(1).cast("bigint")
    return F.call_function("shiftleft", one, value.bitwiseAND(F.lit(BITS - 1)).cast("int"))


def fold(df: DataFrame, column: str) -> DataFrame:
    """The distinct rows, those that differ in ``column`` only being one; NULL in it has a row with an empty mask.

    Each task folds its own rows before they are shuffled.
    """
    value = F.col(column).cast("bigint")
    others = [c for c in df.columns if c != column]
    return df.groupBy(*others, F.shiftright(value, 6).alias(WORD)).agg(F.bit_or(_bit(value)).alias(MASK))


def folded(df: DataFrame, column: str) -> DataFrame:
    """The rows folded; rows that come folded stay as they are."""
    return df if MASK in df.columns else fold(df, column)


def union_masks(df: DataFrame) -> DataFrame:
    """Folded rows with equal other columns as one, holding the values of all."""
    return df.groupBy(*[c for c in df.columns if c != MASK]).agg(F.bit_or(MASK).alias(MASK))


def without(df: DataFrame, value: int) -> DataFrame:
    """Folded rows less one value; rows that held no other, and those of NULL, go."""
    mask = F.col(MASK)
    rest = mask.bitwiseAND(F.bitwise_not(_bit(F.lit(value).cast("bigint"))))
    return df.withColumn(MASK, F.when(F.col(WORD) == value >> 6, rest).otherwise(mask)).where(F.col(MASK) != 0)


def at_least(df: DataFrame, value: int) -> DataFrame:
    """Folded rows less the values below one; rows that held no other, and those of NULL, go."""
    mask, word = F.col(MASK), value >> 6
    upper = mask.bitwiseAND(F.lit(-1 << (value & BITS - 1)).cast("bigint"))
    return df.withColumn(MASK, F.when(F.col(WORD) == word, upper).when(F.col(WORD) > word, mask)).where(F.col(MASK) != 0)


def unfold(df: DataFrame, column: str, columns: Sequence[str], dtype: str = "bigint") -> DataFrame:
    """The rows again, one per bit, with the named columns; ``column`` gets the type it had."""
    bit, mask = F.col("_bit"), F.col(MASK)
    rows = df.withColumn("_bit", F.explode(F.array(*[F.lit(i) for i in range(BITS)])))
    rows = rows.where(F.when(mask.isNull(), bit == 0).otherwise(F.getbit(mask, bit) == 1))
    return rows.withColumn(column, (F.col(WORD) * BITS + bit).cast(dtype)).select(*columns)


def unfolded(df: DataFrame, column: str) -> DataFrame:
    """The rows one per value; rows that come so stay as they are."""
    return unfold(df, column, plain_columns(df, column)) if MASK in df.columns else df


def plain_columns(df: DataFrame, column: str) -> list[str]:
    """The columns of rows that may be folded, as they are unfolded."""
    return [column if c == MASK else c for c in df.columns if c != WORD]


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def not_in_folded(df: DataFrame, known: DataFrame, on: Sequence[str], folded: str) -> DataFrame:
    """Distinct rows whose key the known rows lack, a NULL key being never known; for two large sides.

    Either side may come folded, its rows being distinct then; the outcome is unfolded.
    """
    dtype = next((type_of(side, folded) for side in (df, known) if folded in side.columns), "bigint")
    masks = df if MASK in df.columns else fold(df, folded)
    return unfold(masks_not_in(masks, known, on, folded), folded, plain_columns(df, folded), dtype)


def masks_not_in(masks: DataFrame, known: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """The same of folded rows, which stay folded; known rows may come folded.

    Both sides are shuffled once folded, and bits of the known rows are taken out of the masks.
    """
    others = [c for c in on if c != column]
    keys = [*others, WORD]
    held = union_masks(known.select(*keys, MASK)) if MASK in known.columns else fold(known.select(*others, column), column)
    sides = masks.join(held.withColumnRenamed(MASK, "_held"), keys, "left")
    mask = F.col(MASK)
    left = F.when(mask.isNotNull(), mask.bitwiseAND(F.bitwise_not(F.coalesce("_held", F.lit(0).cast("bigint")))))
    return sides.withColumn(MASK, left).where(mask.isNull() | (mask != 0)).select(*masks.columns)
