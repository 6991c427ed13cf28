"""Dimension staging jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.functions.dates import date_parts, day_key, month_key, partial_date_key, year_key
from tonearm.functions.values import blank_to, code_of, null_to
from tonearm.operators.dedup import latest_by_key
from tonearm.operators.numbering import dense_numbers
from tonearm.schemas import (
    ALBUM_TYPE_CODES,
    DATE_PRECISION_CODES,
    UNKNOWN_DATE_KEY,
    UNKNOWN_INT,
    UNKNOWN_STR,
)

# fixed values: first and last day of the date dimension
FIRST_DAY = dt.date(1700, 1, 1)
LAST_DAY = dt.date(2099, 12, 31)


def _newest(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The named columns of the newest row per key."""
    order = [c for c in ("updated_at",) if c in df.columns]
    return latest_by_key(df.select(key, *order, *columns), [key], order).select(key, *columns)


def stage_album(album: DataFrame) -> DataFrame:
    columns = ["name", "album_type", "url", "release_date", "release_date_precision", "cover_image", "label"]
    return _newest(album, "album_id", columns).select(
        F.col("album_id").alias("album_key"),
        "name",
        "url",
        blank_to("cover_image", UNKNOWN_STR).alias("cover_image"),
        code_of("album_type", ALBUM_TYPE_CODES).alias("album_type"),
        partial_date_key("release_date").alias("release_date_key"),
        code_of("release_date_precision", DATE_PRECISION_CODES).alias("release_date_precision"),
        blank_to("label", UNKNOWN_STR).alias("label"),
    )


def stage_artist(artist: DataFrame) -> DataFrame:
    """From extracts of a day, or of the whole history."""
    columns = ["name", "url", "genres", "followers_count", "monthly_listeners"]
    return _newest(artist, "artist_id", columns).select(
        F.col("artist_id").alias("artist_key"),
        null_to("name", UNKNOWN_STR).alias("name"),
        "genres",
        "url",
        null_to("followers_count", UNKNOWN_INT).alias("followers_count"),
        null_to("monthly_listeners", UNKNOWN_INT).alias("monthly_listeners"),
    )


def genre_names(artist: DataFrame) -> DataFrame:
    """The distinct genre names of the artists, in lower case."""
    return (
        artist.select(F.explode("genres").alias("name"))
        .select(F.lower("name").alias("name"))
        .where("name != ''")
        .dropDuplicates()
    )


def stage_genre(artist: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Genres with their keys. Known genres keep theirs; new ones, by name, get the next ones."""
    names = genre_names(artist)
    if known is None:
        return dense_numbers(names, "name", "genre_key").select("genre_key", "name")
    fresh = names.join(known.select("name"), "name", "left_anti")
    highest = known.agg(F.greatest(F.max("genre_key"), F.lit(0))).scalar()
    new_rows = dense_numbers(fresh, "name", "genre_key", after=highest).select("genre_key", "name")
    return known.select("genre_key", "name").where(F.col("genre_key") != UNKNOWN_INT).unionByName(new_rows)


def with_unknown_genre(genre: DataFrame) -> DataFrame:
    """Add the member for rows without a genre."""
    unknown = genre.sparkSession.range(1).select(
        F.lit(UNKNOWN_INT).cast("bigint").alias("genre_key"), F.lit(UNKNOWN_STR).alias("name")
    )
    return genre.where(F.col("genre_key") != UNKNOWN_INT).unionByName(unknown)


def stage_user(user: DataFrame) -> DataFrame:
    return _newest(user, "user_id", ["name", "url"]).withColumnRenamed("user_id", "user_key")


def stage_playlist(playlist: DataFrame) -> DataFrame:
    columns = ["name", "url", "collaborative", "public", "snapshot_id", "followers_count", "user_id"]
    return _newest(playlist, "playlist_id", columns).select(
        F.col("playlist_id").alias("playlist_key"),
        "name",
        "url",
        "collaborative",
        F.col("public").alias("is_public"),
        "snapshot_id",
        null_to("followers_count", UNKNOWN_INT).alias("followers_count"),
        F.col("user_id").alias("user_key"),
    )


def stage_track(track: DataFrame) -> DataFrame:
    columns = ["name", "url", "album_id", "disc_number", "duration_ms", "explicit", "plays_count"]
    return _newest(track, "track_id", columns).select(
        F.col("track_id").alias("track_key"),
        blank_to("name", UNKNOWN_STR).alias("name"),
        "url",
        F.col("album_id").alias("album_key"),
        null_to("disc_number", UNKNOWN_INT).alias("disc_number"),
        "duration_ms",
        null_to("explicit", False).alias("is_explicit"),
        null_to("plays_count", UNKNOWN_INT).alias("plays_count"),
    )


def _days(spark: SparkSession, step: str) -> DataFrame:
    bounds = f"date'{FIRST_DAY}', date'{LAST_DAY}', interval 1 {step}"
    return spark.range(1).select(F.explode(F.expr(f"sequence({bounds})")).alias("date_actual"))


def calendar_days(spark: SparkSession) -> DataFrame:
    """One row per day of the date dimension."""
    return _days(spark, "day").select(
        day_key("date_actual").alias("date_key"),
        "date_actual",
        *[part.alias(name) for name, part in date_parts("date_actual").items()],
    )


def special_dates(spark: SparkSession) -> DataFrame:
    """The unknown date, and dates known by year or by month only."""
    blank = {
        "date_actual": F.lit(None).cast("date"),
        "day_of_week": F.lit(UNKNOWN_INT),
        "day_of_month": F.lit(UNKNOWN_INT),
        "day_of_year": F.lit(UNKNOWN_INT),
        "month_of_year": F.lit(UNKNOWN_INT),
        "month_name": F.lit(UNKNOWN_STR),
        "quarter": F.lit(UNKNOWN_INT),
        "year": F.lit(UNKNOWN_INT),
        "is_weekend": F.lit(None).cast("boolean"),
    }

    def members(days: DataFrame, key, known: tuple[str, ...]) -> DataFrame:
        parts = date_parts("date_actual")
        columns = blank | {name: parts[name] for name in known}
        return days.select(key.alias("date_key"), *[c.alias(n) for n, c in columns.items()])

    unknown = members(
        spark.range(1).select(F.lit(None).cast("date").alias("date_actual")), F.lit(UNKNOWN_DATE_KEY), ()
    )
    years = members(_days(spark, "year"), year_key("date_actual"), ("year",))
    months = members(
        _days(spark, "month"), month_key("date_actual"), ("month_of_year", "month_name", "year")
    )
    return unknown.unionByName(years).unionByName(months)


def date_dimension(spark: SparkSession) -> DataFrame:
    """146,097 days and 5,201 special members; the size does not depend on any data."""
    return calendar_days(spark).unionByName(special_dates(spark))
