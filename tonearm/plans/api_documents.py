"""Documents of the official API to source tables.

Each job takes (fetched_at, doc) documents and returns rows per table, parents first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.functions.dates import iso_timestamp
from tonearm.functions.values import last_of, only_link
from tonearm.plans.documents import Rows, doc_each, items, named, one_row, row_each

# --- fixed values: the shape of the documents ------------------------------------------------
LINKS = "external_urls: map<string, string>"
IMAGES = "images: array<struct<url: string>>"
SIMPLE_ARTIST = f"struct<id: string, name: string, {LINKS}>"
ARTIST = (
    f"id: string, name: string, {LINKS}, {IMAGES}, followers: struct<total: int>, "
    "genres: array<string>, popularity: int"
)
ALBUM = (
    f"id: string, name: string, album_type: string, {LINKS}, {IMAGES}, release_date: string, "
    "release_date_precision: string, available_markets: array<string>, restrictions: string, "
    f"label: string, popularity: int, artists: array<{SIMPLE_ARTIST}>"
)
SIMPLE_TRACK = (
    f"id: string, name: string, {LINKS}, artists: array<{SIMPLE_ARTIST}>, "
    "available_markets: array<string>, disc_number: int, duration_ms: int, explicit: boolean, "
    "restrictions: string, track_number: int, is_local: boolean"
)
TRACK = f"{SIMPLE_TRACK}, popularity: int, album: struct<{ALBUM}>"
ENTRY = f"added_at: string, added_by: struct<id: string>, track: struct<{TRACK}>"
PLAYLIST = (
    f"id: string, name: string, description: string, collaborative: boolean, public: boolean, "
    f"snapshot_id: string, {LINKS}, {IMAGES}, followers: struct<total: int>, "
    f"owner: struct<id: string, display_name: string, {LINKS}>, "
    f"tracks: struct<items: array<struct<{ENTRY}>>>"
)
SEARCH = ", ".join(
    f"{kind}: struct<items: array<struct<{shape}>>>"
    for kind, shape in (("albums", ALBUM), ("artists", ARTIST), ("playlists", PLAYLIST), ("tracks", TRACK))
)
ENTRY_PAGE = f"href: string, items: array<struct<{ENTRY}>>"
TRACK_PAGE = f"items: array<struct<{SIMPLE_TRACK}>>"
PLAYLIST_OF_HREF = "playlists/(.*)/tracks"
# ------------------------------------------------------------------------------------------


def _restrictions(text: Column) -> Column:
    """Reasons as an array; they come as an array or as an object."""
    return F.coalesce(
        F.from_json(text, "array<string>"), F.map_values(F.from_json(text, "map<string, string>"))
    )


def _simple_artist(doc: Column) -> Column:
    return named(artist_id=doc["id"], url=only_link(doc["external_urls"]), name=doc["name"])


def _artist(doc: Column) -> Column:
    return named(
        artist_id=doc["id"],
        url=only_link(doc["external_urls"]),
        followers_count=doc["followers"]["total"],
        genres=doc["genres"],
        image=last_of(doc["images"])["url"],
        name=doc["name"],
        popularity=doc["popularity"],
    )


def _album(doc: Column) -> Column:
    return named(
        album_id=doc["id"],
        available_markets=doc["available_markets"],
        url=only_link(doc["external_urls"]),
        cover_image=last_of(doc["images"])["url"],
        name=doc["name"],
        release_date=doc["release_date"],
        release_date_precision=doc["release_date_precision"],
        restrictions=_restrictions(doc["restrictions"]),
        label=doc["label"],
        popularity=doc["popularity"],
        album_type=doc["album_type"],
    )


def _simple_track(doc: Column, **more: Column) -> Column:
    return named(
        track_id=doc["id"],
        available_markets=doc["available_markets"],
        disc_number=doc["disc_number"],
        duration_ms=doc["duration_ms"],
        explicit=doc["explicit"],
        url=only_link(doc["external_urls"]),
        name=doc["name"],
        restrictions=_restrictions(doc["restrictions"]),
        track_number=doc["track_number"],
        **more,
    )


def _playlist(doc: Column, **more: Column) -> Column:
    return named(
        playlist_id=doc["id"],
        collaborative=doc["collaborative"],
        description=doc["description"],
        url=only_link(doc["external_urls"]),
        cover_image=last_of(doc["images"])["url"],
        name=doc["name"],
        public=doc["public"],
        snapshot_id=doc["snapshot_id"],
        user_id=doc["owner"]["id"],
        **more,
    )


def _owner(doc: Column) -> Column:
    owner = doc["owner"]
    return named(user_id=owner["id"], url=only_link(owner["external_urls"]), name=owner["display_name"])


def albums(docs: DataFrame) -> list[Rows]:
    """Album documents; the last image is the cover."""
    doc = F.col("doc")
    return [
        Rows("artist", row_each(docs, doc["artists"], _simple_artist)),
        Rows("album", one_row(docs, _album(doc))),
        Rows(
            "artist_album",
            row_each(docs, doc["artists"], lambda a: named(artist_id=a["id"], album_id=doc["id"])),
        ),
    ]


def artists(docs: DataFrame) -> list[Rows]:
    return [Rows("artist", one_row(docs, _artist(F.col("doc"))))]


def tracks(docs: DataFrame, released_only: bool = True) -> list[Rows]:
    """Track documents with their album and artists.

    ``released_only`` leaves out the album, and what belongs to it, when it has no release date.
    """
    doc = F.col("doc")
    of_albums = docs.select("fetched_at", doc["album"].alias("doc"))
    if released_only:
        of_albums = of_albums.where("doc.release_date != ''")
    return [
        *albums(of_albums.where("doc.id is not null")),
        Rows("artist", row_each(docs, doc["artists"], _simple_artist)),
        Rows(
            "track",
            one_row(docs, _simple_track(doc, popularity=doc["popularity"], album_id=doc["album"]["id"])),
        ),
        Rows(
            "artist_track",
            row_each(docs, doc["artists"], lambda a: named(artist_id=a["id"], track_id=doc["id"])),
        ),
    ]


def _entries(docs: DataFrame, playlist_id: Column, entries: Column) -> DataFrame:
    """Entries of a playlist as documents; missing and local tracks are left out."""
    usable = F.filter(
        items(entries),
        lambda e: e["track"]["id"].isNotNull() & ~F.coalesce(e["track"]["is_local"], F.lit(False)),
    )
    return docs.select("fetched_at", playlist_id.alias("playlist_id"), F.explode(usable).alias("doc"))


def _entry_tables(entries: DataFrame, released_only: bool) -> list[Rows]:
    doc = F.col("doc")
    entry = named(
        playlist_id=F.col("playlist_id"),
        track_id=doc["track"]["id"],
        added_at=iso_timestamp(doc["added_at"]),
        added_by=doc["added_by"]["id"],
        url=only_link(doc["track"]["external_urls"]),
    )
    of_tracks = entries.select("fetched_at", doc["track"].alias("doc"))
    return [*tracks(of_tracks, released_only), Rows("playlist_track", one_row(entries, entry))]


def playlists(docs: DataFrame, released_only: bool = True) -> list[Rows]:
    """Playlist documents with owner, tracks and entries."""
    doc = F.col("doc")
    entries = _entries(docs, doc["id"], doc["tracks"]["items"])
    return [
        Rows("user", one_row(docs, _owner(doc))),
        Rows("playlist", one_row(docs, _playlist(doc, followers_count=doc["followers"]["total"]))),
        *_entry_tables(entries, released_only),
    ]


def found_playlists(docs: DataFrame) -> list[Rows]:
    """Playlists in search results, which lack followers and tracks."""
    doc = F.col("doc")
    return [Rows("user", one_row(docs, _owner(doc))), Rows("playlist", one_row(docs, _playlist(doc)))]


def playlist_pages(docs: DataFrame, released_only: bool = True) -> list[Rows]:
    """Pages of playlist entries; the address of the page names the playlist."""
    doc = F.col("doc")
    playlist_id = F.regexp_extract(doc["href"], PLAYLIST_OF_HREF, 1)
    return _entry_tables(_entries(docs, playlist_id, doc["items"]), released_only)


def album_track_pages(docs: DataFrame) -> list[Rows]:
    """Pages of the tracks of an album; its id comes in column ``album_id``."""
    each = doc_each(docs, F.col("doc")["items"])
    doc = F.col("doc")
    return [
        Rows("artist", row_each(each, doc["artists"], _simple_artist)),
        Rows("track", one_row(each, _simple_track(doc, album_id=F.col("album_id")))),
        Rows(
            "artist_track",
            row_each(each, doc["artists"], lambda a: named(artist_id=a["id"], track_id=doc["id"])),
        ),
    ]


def search_pages(docs: DataFrame, released_only: bool = True) -> dict[str, list[Rows]]:
    """Search result pages, by kind of result."""
    doc = F.col("doc")
    return {
        "album": albums(doc_each(docs, doc["albums"]["items"])),
        "artist": artists(doc_each(docs, doc["artists"]["items"])),
        "playlist": found_playlists(doc_each(docs, doc["playlists"]["items"])),
        "track": tracks(doc_each(docs, doc["tracks"]["items"]), released_only),
    }


def user_playlist_pages(docs: DataFrame, released_only: bool = True) -> list[Rows]:
    """Pages of the playlists of a user."""
    return playlists(doc_each(docs, F.col("doc")["items"]), released_only)
