"""Documents of the web player to source tables.

Each job takes (fetched_at, doc) documents and the address of the site, and returns rows per
table, parents first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.functions.dates import iso_timestamp
from tonearm.functions.values import falsy_to_null, first_of, id_from_uri, is_label, page_url, text_to_int
from tonearm.plans.documents import Rows, doc_each, items, named, one_row, row_each

# --- fixed values: the shape of the documents, and the marks in them ---------------------------
SOURCES = "struct<sources: array<struct<url: string>>>"
URI_ITEMS = "struct<items: array<struct<uri: string>>>"
ALBUM = (
    f"id: string, uri: string, name: string, type: string, label: string, coverArt: {SOURCES}, "
    f"date: struct<precision: string, isoString: string, year: int>, artists: {URI_ITEMS}"
)
RELEASES = f"struct<items: array<struct<releases: struct<items: array<struct<{ALBUM}>>>>>>"
PLAIN_ALBUMS = f"struct<items: array<struct<{ALBUM}>>>"
DISCOGRAPHY = (
    f"struct<albums: {RELEASES}, popularReleasesAlbums: {PLAIN_ALBUMS}, singles: {RELEASES}, "
    f"latest: struct<{ALBUM}>, all: {RELEASES}>"
)
SIMPLE_ARTIST = (
    f"id: string, uri: string, profile: struct<name: string>, visuals: struct<avatarImage: {SOURCES}>"
)
PLAYED = (
    "uri: string, name: string, playcount: string, trackNumber: int, "
    f"contentRating: struct<label: string>, artists: {URI_ITEMS}"
)
DURATION = "struct<totalMilliseconds: int>"
USER = f"id: string, uri: string, name: string, avatar: {SOURCES}"

ALBUM_PAGE = (
    "data: struct<albumUnion: struct<__typename: string, "
    + ALBUM.replace(f"artists: {URI_ITEMS}", f"artists: struct<items: array<struct<{SIMPLE_ARTIST}>>>")
    + f", tracksV2: struct<items: array<struct<track: struct<{PLAYED}, discNumber: int, duration: {DURATION}>>>>"
    f", moreAlbumsByArtist: struct<items: array<struct<discography: struct<popularReleasesAlbums: {PLAIN_ALBUMS}>>>>>>"
)
ARTIST_PAGE = (
    f"data: struct<artistUnion: struct<__typename: string, {SIMPLE_ARTIST}, popularity: int, "
    f"stats: struct<followers: int, monthlyListeners: bigint>, discography: {DISCOGRAPHY}, "
    f"relatedContent: struct<appearsOn: {RELEASES}, "
    "featuringV2: struct<items: array<struct<data: struct<id: string>>>>, "
    "relatedArtists: struct<items: array<struct<id: string>>>>>>"
)
TRACK_ARTISTS = f"struct<items: array<struct<{SIMPLE_ARTIST}, discography: {DISCOGRAPHY}>>>"
TRACK_PAGE = (
    "data: struct<trackUnion: struct<__typename: string, id: string, name: string, playcount: string, "
    f"trackNumber: int, contentRating: struct<label: string>, duration: {DURATION}, "
    f"albumOfTrack: struct<{ALBUM}>, firstArtist: {TRACK_ARTISTS}, otherArtists: {TRACK_ARTISTS}>>"
)
LISTED = (
    f"struct<__typename: string, {PLAYED}, trackDuration: {DURATION}, albumOfTrack: struct<uri: string>>"
)
PLAYLIST_PAGE = (
    "data: struct<playlistV2: struct<__typename: string, id: string, uri: string, name: string, "
    "description: string, followers: int, basePermission: string, revisionId: string, "
    f"images: struct<items: array<{SOURCES}>>, ownerV2: struct<data: struct<{USER}>>, "
    "content: struct<__typename: string, items: array<struct<addedAt: struct<isoString: string>, "
    f"addedBy: struct<data: struct<{USER}>>, itemV2: struct<data: {LISTED}>>>>>>"
)
NOT_FOUND = "NotFound"
TRACK_TYPE = "Track"
ENTRIES_TYPE = "PlaylistItemsPage"
EXPLICIT = "explicit"
CONTRIBUTOR = "CONTRIBUTOR"
# ------------------------------------------------------------------------------------------


def found(docs: DataFrame, union: str) -> DataFrame:
    """The object inside each page; pages saying that there is none are left out."""
    inner = docs.withColumn("doc", F.col(f"doc.data.{union}")).where("doc is not null")
    return inner.where(F.coalesce(F.col("doc.__typename"), F.lit("")) != NOT_FOUND)


def _image(holder: Column) -> Column:
    return first_of(holder["sources"])["url"]


def _album_id(doc: Column) -> Column:
    return id_from_uri(doc["id"], doc["uri"], "album")


def _album(doc: Column, site: str) -> Column:
    date = doc["date"]
    by_day = iso_timestamp(date["isoString"]).isNotNull()
    by_year = ~by_day & (F.coalesce(date["year"], F.lit(0)) != 0)
    return named(
        album_id=_album_id(doc),
        album_type=F.lower(doc["type"]),
        url=page_url(site, "album", _album_id(doc)),
        cover_image=_image(doc["coverArt"]),
        name=doc["name"],
        release_date=F.when(by_day, F.substring(date["isoString"], 1, 10)).when(
            by_year, date["year"].cast("string")
        ),
        release_date_precision=F.when(by_year, "year").otherwise(
            F.lower(falsy_to_null(date["precision"], ""))
        ),
        label=doc["label"],
    )


def _simple_artist(doc: Column, site: str) -> Column:
    artist_id = id_from_uri(doc["id"], doc["uri"], "artist")
    return named(
        artist_id=artist_id,
        url=page_url(site, "artist", artist_id),
        image=_image(doc["visuals"]["avatarImage"]),
        name=doc["profile"]["name"],
    )


def _user(doc: Column, site: str) -> Column:
    user_id = id_from_uri(doc["id"], doc["uri"], "user")
    return named(
        user_id=user_id, url=page_url(site, "user", user_id), name=doc["name"], image=_image(doc["avatar"])
    )


def _first_releases(releases: Column) -> Column:
    """The first edition of each release of a list."""
    return F.transform(items(releases["items"]), lambda item: first_of(item["releases"]["items"]))


def all_releases(discography: Column) -> Column:
    """First editions in the complete list of an artist's releases."""
    return items(_first_releases(discography["all"]))


def releases_of(discography: Column) -> Column:
    """Albums of all lists of a discography, in order; an album may be in several lists."""
    def some(array: Column) -> Column:
        return F.coalesce(items(array), F.filter(F.array(discography["latest"]), lambda _: F.lit(False)))

    return F.concat(
        some(_first_releases(discography["albums"])),
        some(discography["popularReleasesAlbums"]["items"]),
        some(_first_releases(discography["singles"])),
        some(F.array(discography["latest"])),
        some(_first_releases(discography["all"])),
    )


def albums(docs: DataFrame, site: str) -> list[Rows]:
    return [Rows("album", one_row(docs, _album(F.col("doc"), site)))]


def artist_releases(pages: DataFrame, site: str) -> list[Rows]:
    """Pages with the complete discography of an artist."""
    docs = found(pages, "artistUnion")
    return albums(doc_each(docs, all_releases(F.col("doc")["discography"])), site)


def discographies(docs: DataFrame, site: str) -> list[Rows]:
    """Of (…, artist_id, doc), where doc is a discography: its albums, linked to the artist."""
    each = doc_each(docs, releases_of(F.col("doc")))
    link = named(artist_id=F.col("artist_id"), album_id=_album_id(F.col("doc")))
    return [*albums(each, site), Rows("artist_album", one_row(each, link))]


def album_pages(pages: DataFrame, site: str) -> list[Rows]:
    """Album pages: the album, its artists and tracks, and more albums of its artist.

    A page without tracks gives nothing.
    """
    docs = found(pages, "albumUnion")
    doc = F.col("doc")
    listed = items(F.transform(items(doc["tracksV2"]["items"]), lambda item: item["track"]))
    docs = docs.where(F.size(F.coalesce(listed, F.filter(doc["tracksV2"]["items"]["track"], lambda _: F.lit(False)))) > 0)
    tracks = docs.select("fetched_at", _album_id(doc).alias("album_id"), F.explode(listed).alias("doc"))
    track_id = id_from_uri(None, doc["uri"], "track")
    track = named(
        track_id=track_id,
        album_id=F.col("album_id"),
        disc_number=doc["discNumber"],
        duration_ms=doc["duration"]["totalMilliseconds"],
        url=page_url(site, "track", track_id),
        name=doc["name"],
        track_number=doc["trackNumber"],
        plays_count=text_to_int(doc["playcount"]),
        explicit=is_label(doc["contentRating"]["label"], EXPLICIT),
    )
    more = first_of(doc["moreAlbumsByArtist"]["items"])["discography"]["popularReleasesAlbums"]["items"]
    artist_id = lambda a: id_from_uri(a["id"], a["uri"], "artist")
    return [
        Rows("artist", row_each(docs, doc["artists"]["items"], lambda a: _simple_artist(a, site))),
        Rows("album", one_row(docs, _album(doc, site))),
        Rows(
            "artist_album",
            row_each(
                docs,
                doc["artists"]["items"],
                lambda a: named(artist_id=artist_id(a), album_id=_album_id(doc)),
            ),
        ),
        Rows("album", row_each(docs, more, lambda a: _album(a, site))),
        Rows("track", one_row(tracks, track)),
        Rows("artist_track", _links(tracks, track_id)),
    ]


def _links(tracks: DataFrame, track_id: Column) -> DataFrame:
    """Track to artist links of track documents."""
    return row_each(
        tracks,
        F.col("doc")["artists"]["items"],
        lambda a: named(artist_id=id_from_uri(None, a["uri"], "artist"), track_id=track_id),
    )


def artist_pages(pages: DataFrame, site: str) -> list[Rows]:
    """Artist pages: the artist, and albums it appears on with their artists."""
    docs = found(pages, "artistUnion")
    doc = F.col("doc")
    artist = named(
        artist_id=doc["id"],
        url=page_url(site, "artist", doc["id"]),
        followers_count=doc["stats"]["followers"],
        image=_image(doc["visuals"]["avatarImage"]),
        name=doc["profile"]["name"],
        popularity=doc["popularity"],
        monthly_listeners=doc["stats"]["monthlyListeners"],
    )
    guests = doc_each(docs, items(_first_releases(doc["relatedContent"]["appearsOn"])))
    links = row_each(
        guests,
        doc["artists"]["items"],
        lambda a: named(artist_id=id_from_uri(None, a["uri"], "artist"), album_id=_album_id(doc)),
    )
    return [*albums(guests, site), Rows("artist_album", links), Rows("artist", one_row(docs, artist))]


def artist_related(pages: DataFrame) -> DataFrame:
    """What an artist page refers to: ids of albums, playlists and artists."""
    doc = F.col("doc")
    related = doc["relatedContent"]
    return found(pages, "artistUnion").select(
        "fetched_at",
        doc["id"].alias("artist_id"),
        F.transform(items(_first_releases(related["appearsOn"])), _album_id).alias("album_ids"),
        F.transform(items(related["featuringV2"]["items"]), lambda i: i["data"]["id"]).alias("playlist_ids"),
        F.transform(items(related["relatedArtists"]["items"]), lambda i: i["id"]).alias("artist_ids"),
    )


def track_pages(pages: DataFrame, site: str, released_only: bool = True) -> list[Rows]:
    """Track pages: the track, its album and artists, and the discographies of these."""
    docs = found(pages, "trackUnion")
    doc = F.col("doc")
    credited = F.concat(
        items(doc["firstArtist"]["items"]),
        F.coalesce(
            items(doc["otherArtists"]["items"]),
            F.filter(doc["firstArtist"]["items"], lambda _: F.lit(False)),
        ),
    )
    album = docs.select("fetched_at", doc["albumOfTrack"].alias("doc")).where("doc is not null")
    album_rows = albums(album, site)
    if released_only:
        album_rows = [Rows(r.table, r.df.where("release_date != ''")) for r in album_rows]
    track = named(
        track_id=doc["id"],
        album_id=_album_id(doc["albumOfTrack"]),
        url=page_url(site, "track", doc["id"]),
        duration_ms=doc["duration"]["totalMilliseconds"],
        name=doc["name"],
        track_number=doc["trackNumber"],
        explicit=is_label(doc["contentRating"]["label"], EXPLICIT),
        plays_count=text_to_int(doc["playcount"]),
    )
    artists = doc_each(docs, credited)
    more = artists.where("doc.discography is not null").select(
        "fetched_at", doc["id"].alias("artist_id"), doc["discography"].alias("doc")
    )
    links = row_each(
        docs,
        credited,
        lambda a: named(artist_id=id_from_uri(a["id"], a["uri"], "artist"), track_id=doc["id"]),
    )
    return [
        *album_rows,
        Rows("artist", one_row(artists, _simple_artist(doc, site))),
        *discographies(more, site),
        Rows("track", one_row(docs, track)),
        Rows("artist_track", links),
    ]


def playlist_pages(pages: DataFrame, site: str) -> list[Rows]:
    """Playlist pages: playlist, owner, others who added tracks, tracks and entries.

    A page of entries that has none gives nothing.
    """
    docs = found(pages, "playlistV2")
    doc = F.col("doc")
    content = doc["content"]
    is_page = F.coalesce(content["__typename"], F.lit("")) == ENTRIES_TYPE
    docs = docs.where(~is_page | (F.coalesce(F.size(content["items"]), F.lit(0)) > 0))
    playlist_id = id_from_uri(doc["id"], doc["uri"], "playlist")
    owner = doc["ownerV2"]["data"]
    owner_id = id_from_uri(owner["id"], owner["uri"], "user")
    playlist = named(
        playlist_id=playlist_id,
        collaborative=doc["basePermission"] == CONTRIBUTOR,
        description=falsy_to_null(doc["description"], ""),
        url=page_url(site, "playlist", playlist_id),
        followers_count=falsy_to_null(doc["followers"], 0),
        cover_image=first_of(first_of(doc["images"]["items"])["sources"])["url"],
        name=doc["name"],
        user_id=owner_id,
        snapshot_id=doc["revisionId"],
        public=F.lit(True),
    )
    is_track = lambda e: e["itemV2"]["data"]["__typename"] == TRACK_TYPE
    entries = docs.where(is_page).select(
        "fetched_at",
        playlist_id.alias("playlist_id"),
        owner_id.alias("owner_id"),
        F.explode(F.filter(items(content["items"]), is_track)).alias("entry"),
    )
    entry = F.col("entry")
    tracks = entries.select("fetched_at", entry["itemV2"]["data"].alias("doc"))
    track_id = id_from_uri(None, doc["uri"], "track")
    track = named(
        track_id=track_id,
        album_id=id_from_uri(None, doc["albumOfTrack"]["uri"], "album"),
        url=page_url(site, "track", track_id),
        duration_ms=doc["trackDuration"]["totalMilliseconds"],
        name=doc["name"],
        track_number=doc["trackNumber"],
        explicit=is_label(doc["contentRating"]["label"], EXPLICIT),
        plays_count=text_to_int(doc["playcount"]),
    )
    adder = entry["addedBy"]["data"]
    adder_id = id_from_uri(adder["id"], adder["uri"], "user")
    others = entries.where(adder_id.isNotNull() & (adder_id != F.col("owner_id")))
    playlist_track = named(
        playlist_id=F.col("playlist_id"),
        track_id=id_from_uri(None, entry["itemV2"]["data"]["uri"], "track"),
        added_at=iso_timestamp(entry["addedAt"]["isoString"]),
        added_by=adder_id,
    )
    return [
        Rows("user", one_row(docs, _user(owner, site))),
        Rows("user", one_row(others, _user(adder, site))),
        Rows("playlist", one_row(docs, playlist)),
        Rows("track", one_row(tracks, track)),
        Rows("artist_track", _links(tracks, track_id)),
        Rows("playlist_track", one_row(entries, playlist_track)),
    ]
