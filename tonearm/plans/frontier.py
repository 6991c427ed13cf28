"""The crawl frontier: which ids to fetch, what was fetched, and what to fetch next."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.functions.values import shares_any
from tonearm.operators.lookup import not_in

# --- fixed values: topic names, to which a site may add a prefix ---------------------------
ALBUM = "crawl.albums"
ALBUM_TRACKS = "crawl.album.tracks"
ARTIST_ALBUMS = "crawl.artist.albums"
ARTIST_OFFICIAL = "crawl.artist.official"
ARTIST_WEB = "crawl.artist.web"
USER_PLAYLISTS = "crawl.user.playlists"
PLAYLIST = "crawl.playlist"
PLAYLIST_TRACKS = "crawl.playlist.tracks"
TRACK_OFFICIAL = "crawl.track.official"
TRACK_WEB = "crawl.track.web"
MONITOR = "monitor.object"

# kinds of objects that monitoring can fetch again
MONITORED = ("artist", "playlist", "track")

# ids per request: albums, and everything else
ALBUM_CHUNK = 20
OTHER_CHUNK = 50
# ------------------------------------------------------------------------------------------

TRACKING_KEYS = ["function_name", "main_arg_name", "main_arg_value"]


# ---- gate and bookkeeping -------------------------------------------------------------------


def should_crawl(
    ids: DataFrame,
    column: str,
    tracking: DataFrame,
    function_name: str,
    arg_name: str,
    refresh: bool = False,
    today: dt.date | None = None,
) -> DataFrame:
    """The ids not tracked yet for a function and argument.

    With ``today`` only work tracked on that day counts. ``refresh`` lets every id through.
    """
    if refresh:
        return ids
    done = tracking.where(
        (F.col("function_name") == function_name) & (F.col("main_arg_name") == arg_name)
    )
    if today is not None:
        done = done.where(F.col("tracked_at") == F.lit(today))
    return not_in(ids, done.select(F.col("main_arg_value").alias(column)), [column])


def newly_tracked(
    ids: DataFrame,
    column: str,
    tracking: DataFrame,
    function_name: str,
    arg_name: str,
    day: dt.date,
) -> DataFrame:
    """Tracking rows to append for the ids; rows already there are left out."""
    rows = ids.select(
        F.lit(function_name).alias("function_name"),
        F.lit(arg_name).alias("main_arg_name"),
        F.col(column).alias("main_arg_value"),
        F.lit(day).alias("tracked_at"),
    ).dropDuplicates()
    # the day is a constant on both sides, so it prunes the tracking table
    held = tracking.where(F.col("tracked_at") == F.lit(day))
    return not_in(rows, held, TRACKING_KEYS)


# ---- fan-out ----------------------------------------------------------------------------------


def _one(topic: str, id_: str) -> Column:
    return F.array(F.struct(F.lit(topic).alias("topic"), F.col(id_).alias("object_id")))


def _each(topic: str, ids: str) -> Column:
    made = F.transform(ids, lambda id_: F.struct(F.lit(topic).alias("topic"), id_.alias("object_id")))
    return F.coalesce(made, F.array().cast("array<struct<topic: string, object_id: string>>"))


def _emit(df: DataFrame, source: str, *messages: Column) -> DataFrame:
    """One row per message with the id of the object that gave rise to it."""
    return (
        df.select(F.col(source).alias("source_id"), F.explode(F.concat(*messages)).alias("m"))
        .select("source_id", "m.topic", "m.object_id")
        .where(F.col("object_id").isNotNull())
    )


def track_messages(tracks: DataFrame) -> DataFrame:
    """Of (track_id, album_id, artist_ids): the track, its album and each artist."""
    return _emit(
        tracks,
        "track_id",
        _one(TRACK_WEB, "track_id"),
        _one(ALBUM_TRACKS, "album_id"),
        _each(ARTIST_WEB, "artist_ids"),
    )


def artist_messages(artists: DataFrame) -> DataFrame:
    """Of (artist_id, album_ids, playlist_ids, track_ids): the artist and all it refers to."""
    return _emit(
        artists,
        "artist_id",
        _one(ARTIST_OFFICIAL, "artist_id"),
        _each(ALBUM_TRACKS, "album_ids"),
        _each(PLAYLIST_TRACKS, "playlist_ids"),
        _each(TRACK_WEB, "track_ids"),
    )


def artist_albums_messages(albums: DataFrame) -> DataFrame:
    """Of (artist_id, album_id, artist_ids): every album, and each co-artist of an artist once."""
    per_album = _emit(albums, "artist_id", _one(ALBUM_TRACKS, "album_id"))
    co_artists = _emit(albums, "artist_id", _each(ARTIST_WEB, "artist_ids")).dropDuplicates()
    return per_album.unionByName(co_artists)


def track_albums_messages(tracks: DataFrame) -> DataFrame:
    """Of (track_id, album_id, more_album_ids): the track, and each of its albums once."""
    more = F.coalesce("more_album_ids", F.array().cast("array<string>"))
    own = F.when(F.col("album_id").isNotNull(), F.array("album_id"))
    own = F.coalesce(own, F.array().cast("array<string>"))
    albums = tracks.withColumn("album_ids", F.array_union(own, more))
    return _emit(albums, "track_id", _one(TRACK_OFFICIAL, "track_id"), _each(ALBUM_TRACKS, "album_ids"))


def search_messages(kind: str, found: DataFrame) -> DataFrame:
    """Messages for search results: rows with the id of the kind, playlists also ``user_id``."""
    if kind == "album":
        return _emit(found, "album_id", _one(ALBUM_TRACKS, "album_id"))
    if kind == "artist":
        return _emit(found, "artist_id", _one(ARTIST_WEB, "artist_id"), _one(ARTIST_ALBUMS, "artist_id"))
    if kind == "playlist":
        lists = _emit(
            found, "playlist_id", _one(PLAYLIST, "playlist_id"), _one(PLAYLIST_TRACKS, "playlist_id")
        )
        owners = found.select("user_id").dropDuplicates()
        return lists.unionByName(_emit(owners, "user_id", _one(USER_PLAYLISTS, "user_id")))
    if kind == "track":
        return track_messages(found)
    raise ValueError(f"no search results of kind {kind}")


# ---- monitoring -------------------------------------------------------------------------------


def _artist_tracks_of_genres(
    artist: DataFrame, artist_track: DataFrame, track: DataFrame, genres: Sequence[str]
) -> DataFrame:
    chosen = artist.where(shares_any("genres", genres)).select("artist_id")
    return (
        artist_track.select("artist_id", "track_id")
        .join(chosen, "artist_id")
        .join(track.select("track_id", "album_id"), "track_id")
    )


def tracks_of_genres(
    artist: DataFrame,
    artist_track: DataFrame,
    track: DataFrame,
    playlist_track: DataFrame,
    genres: Sequence[str],
) -> DataFrame:
    """Playlists, artists, albums and tracks reached from the artists of some genres."""
    return (
        _artist_tracks_of_genres(artist, artist_track, track, genres)
        .join(playlist_track.select("playlist_id", "track_id"), "track_id", "left")
        .select("playlist_id", "artist_id", "album_id", "track_id")
    )


def monitor_list(
    artist: DataFrame,
    artist_track: DataFrame,
    track: DataFrame,
    playlist_track: DataFrame,
    genres: Sequence[str],
) -> DataFrame:
    """Distinct (object_name, object_value) of all that ``tracks_of_genres`` reaches.

    Only distinct ids are wanted, so the playlists are found by a semi join and the product of
    artists and playlists of a track is never built.
    """
    reached = _artist_tracks_of_genres(artist, artist_track, track, genres)
    named = F.array(
        *[
            F.struct(F.lit(name).alias("object_name"), F.col(f"{name}_id").alias("object_value"))
            for name in ("album", "artist", "track")
        ]
    )
    objects = reached.select(F.explode(named).alias("o")).select("o.object_name", "o.object_value")
    playlists = (
        playlist_track.select("playlist_id", "track_id")
        .join(reached.select("track_id"), "track_id", "left_semi")
        .select(F.lit("playlist").alias("object_name"), F.col("playlist_id").alias("object_value"))
    )
    return objects.unionByName(playlists).where(F.col("object_value").isNotNull()).dropDuplicates()


def dispatch_monitored(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Monitoring messages that can be fetched again, and those that cannot."""
    complete = (
        F.coalesce(F.length("object_name"), F.lit(0)) > 0
    ) & (F.coalesce(F.length("object_value"), F.lit(0)) > 0)
    accepted = complete & F.coalesce(F.col("object_name").isin(*MONITORED), F.lit(False))
    return messages.where(accepted), messages.where(~accepted)
