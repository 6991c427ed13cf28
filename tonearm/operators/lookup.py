"""Joins that look up dimension rows.

No side is ever hinted as broadcast. Spark broadcasts a dimension whose stored size, or size
measured while running, is under its threshold, and shuffles both sides otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.schemas import UNKNOWN_INT, UNKNOWN_STR
from tonearm.functions.values import blank_to


def open_versions(dimension: DataFrame) -> DataFrame:
    """Only the versions in force; a dimension without versions is returned as it is."""
    return dimension.where("flag") if "flag" in dimension.columns else dimension


def genre_keys(
    df: DataFrame, genres: str, dim_genre: DataFrame, keep: Sequence[str]
) -> DataFrame:
    """One row per kept columns and genre, with the key of the genre.

    Rows without genres, and genres that the dimension lacks, get the unknown member. The rows
    are distinct: genres that differ in letter case only give one row.
    """
    names = (
        df.select(*keep, F.explode_outer(genres).alias("_genre"))
        .withColumn("_genre", blank_to(F.lower("_genre"), UNKNOWN_STR))
        .dropDuplicates()
    )
    known = dim_genre.select(F.col("name").alias("_genre"), "genre_key")
    return (
        names.join(known, "_genre", "left")
        .select(*keep, F.coalesce("genre_key", F.lit(UNKNOWN_INT)).alias("genre_key"))
        .dropDuplicates()
    )


def not_in(df: DataFrame, known: DataFrame, on: Sequence[str], strategy: str = "delta") -> DataFrame:
    """Rows whose key the known rows lack; a NULL key is never known.

    ``delta`` first cuts the known rows down to the keys asked for. When these are few, Spark broadcasts them, and the
    known rows, which may be a whole history, are scanned but not shuffled. ``full`` joins once, which suits rows that
    are many or costly, as ``delta`` may compute them twice.
    """
    if strategy == "full":
        return df.join(known.select(*on), list(on), "left_anti").select(*df.columns)
    asked = df.select(*on)
    seen = known.select(*on).join(asked, list(on), "left_semi")
    return df.join(seen, list(on), "left_anti").select(*df.columns)
