"""Ways to tell whether a row changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the values joined by ``|``; NULL as soon as one value is NULL."""
    parts: list[Column] = []
    for column in columns:
        parts += [F.lit("|"), F.col(column).cast("string")]
    return F.sha2(F.concat(*parts[1:]), 256)


def lenient_hash(columns: Sequence[str]) -> Column:
    """MD5 of the values joined by ``|``; NULL values are left out."""
    return F.md5(F.concat_ws("|", *[F.col(column).cast("string") for column in columns]))


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality of all keys, one by one, so that a NULL key equals nothing.

    (Equality of structs would take two NULLs as equal.)
    """
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{left}.{key}") == F.col(f"{right}.{key}"))
    return condition


def any_differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """True where any column differs, NULL being a value of its own."""
    differs = F.lit(False)
    for column in columns:
        differs = differs | ~F.col(f"{left}.{column}").eqNullSafe(F.col(f"{right}.{column}"))
    return differs
