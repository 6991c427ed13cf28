"""Storing document rows in the source tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.operators.merge import AUDIT_COLUMNS, combine_partial, upsert_partial
from tonearm.plans.documents import Rows
from tonearm.schemas import SOURCE_TABLES

# parents before the rows that refer to them, bridges last
STORING_ORDER = (
    "user", "artist", "album", "track", "playlist", "artist_album", "artist_track", "playlist_track",
)


def fold(table: str, rows: Iterable[Rows]) -> DataFrame:
    """All rows for one table, of any shape, as one partial record per key.

    Later documents win column by column; within one moment, later shapes win. The names of the
    columns that were carried come in ``present``.
    """
    spec = SOURCE_TABLES[table]
    fields = [f for f in spec.schema.fields if f.name not in AUDIT_COLUMNS]
    union = None
    for place, shape in enumerate(r.df for r in rows if r.table == table):
        carried = [f.name for f in fields if f.name in shape.columns and f.name not in spec.keys]
        columns = [
            (F.col(f.name) if f.name in shape.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
        names = F.array(*[F.lit(c) for c in carried]).cast("array<string>")
        part = shape.select(
            *columns, "fetched_at", F.lit(place).alias("place"), names.alias("present")
        )
        union = part if union is None else union.unionByName(part)
    if union is None:
        raise ValueError(f"no rows for {table}")
    known = union.dropna(subset=list(spec.keys))
    return combine_partial(known, list(spec.keys), ["fetched_at", "place"], "present")


def store(
    targets: Mapping[str, DataFrame], rows: list[Rows], as_of: dt.datetime
) -> dict[str, DataFrame]:
    """New content of every source table that the rows touch, in storing order."""
    touched = {r.table for r in rows}
    return {
        table: upsert_partial(
            targets[table], fold(table, rows), list(SOURCE_TABLES[table].keys), as_of, "present"
        )
        for table in STORING_ORDER
        if table in touched
    }
