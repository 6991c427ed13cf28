"""Fact staging jobs.

Genres are folded (``operators.fold``) before the large joins, and bridges are made distinct by it or before it. As the
entities are distinct too, the joined rows need no deduplication. ``folded`` leaves them with the genres as a mask, for
steps that move facts further.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.functions.dates import date_of_text, day_key, on_date
from tonearm.operators.dedup import latest_by_key
from tonearm.operators.fold import MASK, WORD, fold, type_of, unfold, union_masks
from tonearm.operators.lookup import genre_keys, not_in, open_versions
from tonearm.schemas import UNKNOWN_DATE_KEY, UNKNOWN_STR


def artist_genres(dim_artist: DataFrame, dim_genre: DataFrame) -> DataFrame:
    """Distinct (artist_key, genre_key) of the artists in force."""
    return genre_keys(open_versions(dim_artist), "genres", dim_genre, ["artist_key"])


def album_track(
    track: DataFrame,
    artist_album: DataFrame,
    dim_album: DataFrame,
    dim_artist: DataFrame,
    dim_genre: DataFrame,
    run_date: dt.date | None = None,
    folded: bool = False,
) -> DataFrame:
    """Track × album × the artists of the album × their genres; keys only.

    ``run_date`` keeps the tracks created on that day; without it every given track counts.
    """
    if run_date is not None:
        track = track.where(on_date("created_at", run_date))
    tracks = latest_by_key(
        track.select(F.col("track_id").alias("track_key"), "album_id", "created_at"),
        ["track_key"],
        ["created_at"],
    ).select("track_key", F.col("album_id").alias("album_key"))
    bridge = artist_album.select(
        F.col("album_id").alias("album_key"), F.col("artist_id").alias("artist_key")
    ).dropDuplicates()
    genres = artist_genres(dim_artist, dim_genre)
    genres, values = (fold(genres, "genre_key"), [WORD, MASK]) if folded else (genres, ["genre_key"])
    return (
        tracks.join(dim_album.select("album_key", "release_date_key"), "album_key")
        .join(bridge, "album_key")
        .join(genres, "artist_key")
        .select("release_date_key", "album_key", "artist_key", *values, "track_key")
    )


def unplaced_tracks(track: DataFrame, facts: DataFrame) -> DataFrame:
    """Tracks, or entries of tracks, without any fact: something they need is not known yet.

    A track is looked for once, however many facts it has.
    """
    placed = facts.select(F.col("track_key").alias("track_id")).dropDuplicates()
    return not_in(track, placed, ["track_id"], "full")


def playlist_track(
    entries: DataFrame,
    artist_track: DataFrame,
    dim_playlist: DataFrame,
    dim_artist: DataFrame,
    dim_genre: DataFrame,
    folded: bool = False,
) -> DataFrame:
    """Playlist entry × the genres of the track's artists; the artist is not kept.

    An unknown playlist gives the unknown playlist and user, an unreadable date the unknown date.
    """
    genres = artist_genres(dim_artist, dim_genre).withColumnRenamed("artist_key", "artist_id")
    track_genres = union_masks(
        artist_track.select("artist_id", F.col("track_id").alias("track_key"))
        .join(fold(genres, "genre_key"), "artist_id")
        .select("track_key", WORD, MASK)
    )
    playlists = open_versions(dim_playlist).select("playlist_key", "user_key")
    added = (
        entries.select(
            "playlist_id", F.col("track_id").alias("track_key"), date_of_text("added_at").alias("date_actual")
        )
        .join(playlists, F.col("playlist_id") == F.col("playlist_key"), "left")
        .select(
            F.coalesce("playlist_key", F.lit(UNKNOWN_STR)).alias("playlist_key"),
            F.coalesce("user_key", F.lit(UNKNOWN_STR)).alias("user_key"),
            "track_key",
            "date_actual",
        )
        .dropDuplicates()
    )
    entry = [
        F.coalesce(day_key("date_actual"), F.lit(UNKNOWN_DATE_KEY)).alias("added_date_key"),
        "playlist_key",
        "user_key",
        "track_key",
        "date_actual",
    ]
    found = added.join(track_genres, "track_key").select(*entry, WORD, MASK)
    if folded:
        return found
    columns = ["added_date_key", "playlist_key", "user_key", "genre_key", "track_key", "date_actual"]
    return unfold(found, "genre_key", columns, type_of(genres, "genre_key"))
