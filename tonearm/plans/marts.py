"""Marts over the facts. Facts are reduced first and looked up in the dimensions afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.functions.values import duration_class
from tonearm.operators.dedup import first_rows
from tonearm.operators.fold import fold, type_of, unfold
from tonearm.operators.lookup import not_in, open_versions
from tonearm.schemas import UNKNOWN_INT

ALBUM_TRACK_UNIT = ["release_date_key", "album_key", "artist_key", "track_key"]


def album_track_metric(
    staged: DataFrame, facts: DataFrame | None, dim_date: DataFrame, strategy: str = "delta"
) -> DataFrame:
    """New tracks per release month, album and artist.

    ``facts`` are those of earlier runs; ``strategy`` is how they are looked for (``lookup.not_in``). A track that merely
    gains a genre is not new.
    """
    units = first_rows(staged, ALBUM_TRACK_UNIT)
    if facts is not None:
        units = not_in(units, facts, ALBUM_TRACK_UNIT, strategy)
    counts = units.groupBy("release_date_key", "album_key", "artist_key").agg(
        F.count(F.lit(1)).alias("tracks_count")
    )
    months = dim_date.select(
        F.col("date_key").alias("release_date_key"),
        F.col("month_of_year").alias("release_month"),
        F.col("year").alias("release_year"),
    )
    groups = ["release_month", "release_year", "album_key", "artist_key"]
    return (
        counts.join(months, "release_date_key")
        .groupBy(*groups)
        .agg(F.sum("tracks_count").alias("tracks_count"))
    )


def total_album_track_metric(metric: DataFrame) -> DataFrame:
    """The appended metric rows of all runs, added up."""
    groups = ["release_month", "release_year", "album_key", "artist_key"]
    return metric.groupBy(*groups).agg(F.sum("tracks_count").alias("tracks_count"))


def user_genre_preference(
    facts: DataFrame, dim_user: DataFrame, dim_genre: DataFrame, dim_track: DataFrame
) -> DataFrame:
    """Tracks and plays per user name and genre."""
    unit = ["user_key", "genre_key", "track_key"]
    # a row per user and track until their plays are found, not one per genre
    units = fold(facts.where(F.col("genre_key") != UNKNOWN_INT).select(*unit), "genre_key")
    played = units.join(open_versions(dim_track).select("track_key", "plays_count"), "track_key")
    per_key = (
        unfold(played, "genre_key", ["user_key", "genre_key", "plays_count"], type_of(facts, "genre_key"))
        .groupBy("user_key", "genre_key")
        .agg(F.count(F.lit(1)).alias("tracks"), F.sum("plays_count").alias("plays"))
    )
    users = dim_user.where("name != ''").select("user_key", "name")
    genres = dim_genre.select("genre_key", F.col("name").alias("genre"))
    return (
        per_key.join(users, "user_key")
        .join(genres, "genre_key")
        .groupBy("name", "genre")
        .agg(F.sum("tracks").alias("tracks_count"), F.sum("plays").alias("tracks_plays_count"))
    )


def favorite_track(facts: DataFrame, dim_date: DataFrame, dim_track: DataFrame) -> DataFrame:
    """Per month and track: (day, playlist) and (day, user) pairs that added it."""
    day_track = ["added_date_key", "track_key"]
    entries = first_rows(facts, [*day_track, "playlist_key", "user_key"])
    per_day = entries.groupBy(*day_track).agg(
        F.count_distinct("playlist_key").alias("total_playlists"),
        F.count_distinct("user_key").alias("total_users"),
    )
    months = dim_date.select(
        F.col("date_key").alias("added_date_key"),
        F.col("month_of_year").alias("added_month"),
        F.col("year").alias("added_year"),
    )
    per_month = (
        per_day.join(months, "added_date_key")
        .groupBy("added_month", "added_year", "track_key")
        .agg(
            F.sum("total_playlists").alias("total_playlists"),
            F.sum("total_users").alias("total_users"),
        )
    )
    tracks = open_versions(dim_track).select(
        "track_key",
        F.col("name").alias("track_name"),
        duration_class("duration_ms").alias("duration_category"),
        "plays_count",
    )
    return per_month.join(tracks, "track_key").select(
        "added_month",
        "added_year",
        "track_key",
        "track_name",
        "duration_category",
        "plays_count",
        "total_playlists",
        "total_users",
    )
