"""Defaults, codes, numbers from text, arrays and identifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonearm.schemas import UNKNOWN_INT


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def blank_to(column: Column | str, value) -> Column:
    """``value`` where the text is NULL or empty."""
    return F.coalesce(F.nullif(_col(column), F.lit("")), F.lit(value))


def null_to(column: Column | str, value) -> Column:
    """``value`` where the column is NULL."""
    return F.coalesce(_col(column), F.lit(value))


def code_of(column: Column | str, codes: Mapping[str, int], unknown: int = UNKNOWN_INT) -> Column:
    """The code of a label; labels outside the table, and NULL, get ``unknown``."""
    column = _col(column)
    result = F.lit(unknown)
    for label, code in codes.items():
        result = F.when(column == label, code).otherwise(result)
    return result


def falsy_to_null(column: Column | str, falsy) -> Column:
    """NULL where the value is the given blank or zero."""
    return F.nullif(_col(column), F.lit(falsy))


def text_to_int(column: Column | str) -> Column:
    """Whole number from text such as ``1,234,567``; anything else is NULL."""
    return F.replace(_col(column), F.lit(","), F.lit("")).try_cast("bigint")


def is_label(column: Column | str, label: str) -> Column:
    """True where the label, in any letter case, is the given one."""
    return F.lower(_col(column)) == label.lower()


def duration_class(milliseconds: Column | str) -> Column:
    """Below three minutes ``short``, up to four ``normal``, all else ``long``."""
    ms = _col(milliseconds)
    return F.when(ms < 3 * 60_000, "short").when(ms <= 4 * 60_000, "normal").otherwise("long")


def first_of(array: Column | str) -> Column:
    """First element, NULL for an empty or missing array."""
    return F.get(_col(array), F.lit(0))


def last_of(array: Column | str) -> Column:
    """Last element, NULL for an empty or missing array."""
    return F.try_element_at(_col(array), F.lit(-1))


def shares_any(array: Column | str, values: Sequence[str]) -> Column:
    """True where the array holds any of the values."""
    return F.arrays_overlap(_col(array), F.array(*[F.lit(value) for value in values]))


def joined_text(array: Column | str, separator: str = ",") -> Column:
    """The elements of an array as one text, NULL elements left out."""
    return F.array_join(_col(array), separator)


def id_from_uri(id_: Column | str | None, uri: Column | str, kind: str) -> Column:
    """The id field, or the last part of a ``scheme:kind:id`` address where it is missing."""
    from_uri = F.regexp_replace(_col(uri), f"^[a-z]+:{kind}:", "")
    if id_ is None:
        return from_uri
    return F.coalesce(F.nullif(_col(id_), F.lit("")), from_uri)


def page_url(site: str, kind: str, id_: Column | str) -> Column:
    """Web address of one catalogue object."""
    return F.concat(F.lit(f"{site.rstrip('/')}/{kind}/"), _col(id_))


def only_link(links: Column | str) -> Column:
    """The link held in a one-entry map of external links."""
    return first_of(F.map_values(_col(links)))
