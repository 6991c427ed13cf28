"""Documents made from the catalogue views, normalized back into rows.

One document is made per row of a view, so no group is ever collected. Bodies hold the cases the
jobs must handle: missing branches, NULL items, pages saying that nothing was found, local
tracks, both timestamp spellings, and malformed text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.functions.html import play_count
from tonearm.plans import api_documents as api
from tonearm.plans import storing
from tonearm.plans import web_documents as web
from tonearm.plans.documents import Rows, parse_bodies
from tonearm.queries.registry import query
from tonearm.schemas import SOURCE_TABLES
from tonearm.session import working_folder
from tonearm.sources import warehouse

SITE = "https://catalogue.example"
FETCHED = "timestamp '2024-01-02 10:00:00'"


def lines(tables: list[Rows]) -> DataFrame:
    """All rows as (table, values in text); NULL shows as a tilde."""
    result = None
    for rows in tables:
        values = []
        for field in rows.df.schema.fields:
            if field.name == "fetched_at":
                continue
            value = F.col(field.name)
            is_array = field.dataType.typeName() == "array"
            text = F.array_join(value, ",") if is_array else value.cast("string")
            values.append(F.coalesce(text, F.lit("~")))
        part = rows.df.select(F.lit(rows.table).alias("entity"), F.concat_ws("|", *values).alias("payload"))
        result = part if result is None else result.unionByName(part)
    return result


def line_sql(entity: str, values: str, source: str) -> str:
    """The same in SQL; values are separated by semicolons."""
    texts = ", ".join(f"coalesce(cast({v.strip()} as varchar), '~')" for v in values.split(";"))
    return f"select '{entity}' as entity, concat_ws('|', {texts}) as payload from {source}"


def all_of(*parts: str) -> str:
    return "\nunion all ".join(parts)


def bodies(df: DataFrame, doc: str, *more: str) -> DataFrame:
    """One body per row from a struct expression; NULL fields are left out of the text.

    As the output of a generator, a body is made once and not again for each condition on it.
    """
    return df.selectExpr(f"{FETCHED} as fetched_at", f"explode(array(to_json({doc}))) as body", *more)


def spliced(df: DataFrame, doc: str, array: str, *more: str) -> DataFrame:
    """Bodies whose '@@' field becomes an array given as text, with elements of any shape."""
    body = f"replace(to_json({doc}), '\"@@\"', {array})"
    return df.selectExpr(f"{FETCHED} as fetched_at", f"explode(array({body})) as body", *more)


def parsed(c, rows: DataFrame, ddl: str, needs: str | None = None) -> DataFrame:
    """The documents, parsed once and stored for the several tables taken from them."""
    docs, _ = parse_bodies(rows, ddl, needs)
    root = working_folder(c.spark, "documents")
    warehouse.write_staging(docs, root, "docs")
    return warehouse.read_table(c.spark, root, "docs")


def links(kind: str, id_: str) -> str:
    return f"map('home', 'u/{kind}/' || {id_})"


# ---- official API ------------------------------------------------------------------------------

# two artists per album, one of them on every album, and a NULL between them
API_ARTISTS = f"""array(named_struct('id', 'a' || album_id, 'name', label, 'external_urls', {links('ar', "'a' || album_id")}),
  null, named_struct('id', 'various', 'name', 'various', 'external_urls', {links('ar', "'various'")}))"""
API_ALBUM = f"""named_struct('id', album_id, 'name', name, 'album_type', album_type, 'external_urls', {links('al', 'album_id')},
  'images', if(cover_image is null, array(), array(named_struct('url', 'big'), named_struct('url', cover_image))),
  'release_date', release_date, 'release_date_precision', release_date_precision, 'label', label,
  'available_markets', array('DE', 'VN'), 'popularity', length(name), 'artists', {API_ARTISTS})"""
ALBUM_VALUES = """'DE,VN'; 'u/al/' || album_id; cover_image; name; release_date; release_date_precision; null; label;
  length(name); album_type"""
API_ALBUM_LINES = [
    line_sql("album", "album_id;" + ALBUM_VALUES, "src_album"),
    line_sql("artist", "'a' || album_id; 'u/ar/a' || album_id; label", "src_album"),
    line_sql("artist", "'various'; 'u/ar/various'; 'various'", "src_album"),
    line_sql("artist_album", "'a' || album_id; album_id", "src_album"),
    line_sql("artist_album", "'various'; album_id", "src_album"),
]


@query("j01_album", all_of(*API_ALBUM_LINES))
def api_album(c):
    docs = parsed(c, bodies(c.src_album, API_ALBUM), api.ALBUM)
    return lines(api.albums(docs))


API_ARTIST = f"""named_struct('id', artist_id, 'name', name, 'external_urls', {links('ar', 'artist_id')},
  'followers', named_struct('total', followers_count), 'genres', genres, 'popularity', length(url),
  'images', if(followers_count is null, null, array(named_struct('url', 'i/' || artist_id))))"""
API_ARTIST_VALUES = """'u/ar/' || artist_id; followers_count; array_to_string(genres, ','); case when followers_count is null then null
  else 'i/' || artist_id end; name; length(url)"""


@query("j02_artist", line_sql("artist", "artist_id;" + API_ARTIST_VALUES, "src_artist"))
def api_artist(c):
    docs = parsed(c, bodies(c.src_artist, API_ARTIST), api.ARTIST)
    return lines(api.artists(docs))


# a track with its album and two artists; the album has a release date on two tracks of three
TRACK_DATE = "case when duration_ms % 30000 = 0 then null else '2020-0' || (1 + duration_ms / 10000 % 9) end"
API_TRACK_DATE = "if(duration_ms % 30000 = 0, null, '2020-0' || cast(1 + (duration_ms div 10000) % 9 as string))"
API_TRACK = f"""named_struct('id', track_id, 'name', name, 'external_urls', {links('tr', 'track_id')},
  'disc_number', disc_number, 'duration_ms', duration_ms, 'explicit', explicit, 'track_number', length(name),
  'is_local', false, 'popularity', length(url), 'restrictions', map('reason', 'market'),
  'artists', array(named_struct('id', 'a' || track_id, 'name', name, 'external_urls', {links('ar', "'a' || track_id")})),
  'album', named_struct('id', album_id, 'name', 'album ' || album_id, 'external_urls', {links('al', 'album_id')},
    'release_date', {API_TRACK_DATE}, 'restrictions', array('explicit', 'market'),
    'artists', array(named_struct('id', 'b' || album_id, 'external_urls', {links('ar', "'b' || album_id")}))))"""
DATED = "src_track where duration_ms % 30000 <> 0"
TRACK_DATE_SQL = "'2020-0' || cast(1 + (duration_ms // 10000) % 9 as varchar)"
API_TRACK_LINES = [
    line_sql(
        "album",
        f"album_id; null; 'u/al/' || album_id; null; 'album ' || album_id; {TRACK_DATE_SQL}; null; 'explicit,market'; null; null; null",
        DATED,
    ),
    line_sql("artist", "'b' || album_id; 'u/ar/b' || album_id; null", DATED),
    line_sql("artist_album", "'b' || album_id; album_id", DATED),
    line_sql("artist", "'a' || track_id; 'u/ar/a' || track_id; name", "src_track"),
    line_sql("artist_track", "'a' || track_id; track_id", "src_track"),
    line_sql(
        "track",
        "track_id; null; disc_number; duration_ms; explicit; 'u/tr/' || track_id; name; 'market'; length(name); length(url); album_id",
        "src_track",
    ),
]


@query("j06_track", all_of(*API_TRACK_LINES))
def api_track(c):
    docs = parsed(c, bodies(c.src_track, API_TRACK), api.TRACK)
    return lines(api.tracks(docs))


OWNER = f"named_struct('id', user_id, 'display_name', 'user ' || user_id, 'external_urls', {links('us', 'user_id')})"
API_PLAYLIST_HEAD = f"""'id', playlist_id, 'name', name, 'collaborative', collaborative, 'public', public,
  'snapshot_id', snapshot_id, 'external_urls', {links('pl', 'playlist_id')}, 'description', '',
  'images', if(public, array(named_struct('url', 'c/' || playlist_id)), array()), 'owner', {OWNER}"""
PLAYLIST_VALUES = """playlist_id; collaborative; ''; 'u/pl/' || playlist_id; case when public then 'c/' || playlist_id end; name;
  public; snapshot_id; user_id"""


@query(
    "j03_search_pages",
    all_of(
        *API_ALBUM_LINES,
        line_sql("user", "'u' || album_id; 'u/us/u' || album_id; null", "src_album"),
        line_sql(
            "playlist", "'p' || album_id; true; null; 'u/pl/p' || album_id; null; name; false; 's'; 'u' || album_id", "src_album"
        ),
        line_sql("artist", "'found'; 'u/ar/found'; 7; 'pop,rock'; null; 'found'; null", "src_album"),
        line_sql("artist", "'t' || album_id; 'u/ar/t' || album_id; null", "src_album"),
        line_sql(
            "track",
            "'t' || album_id; null; null; null; null; 'u/tr/t' || album_id; name; null; null; null; album_id",
            "src_album",
        ),
        line_sql("artist_track", "'t' || album_id; 't' || album_id", "src_album"),
    ),
)
def search_pages(c):
    """Pages with all four lists, each with a NULL item."""
    page = f"""named_struct('albums', named_struct('items', array(null, {API_ALBUM})),
      'artists', named_struct('items', array(named_struct('id', 'found', 'name', 'found', 'external_urls', {links('ar', "'found'")},
        'followers', named_struct('total', 7), 'genres', array('pop', 'rock')), null)),
      'playlists', named_struct('items', array(null, named_struct('id', 'p' || album_id, 'name', name, 'collaborative', true,
        'public', false, 'snapshot_id', 's', 'external_urls', {links('pl', "'p' || album_id")},
        'owner', named_struct('id', 'u' || album_id, 'external_urls', {links('us', "'u' || album_id")})))),
      'tracks', named_struct('items', array(null, named_struct('id', 't' || album_id, 'name', name,
        'external_urls', {links('tr', "'t' || album_id")}, 'album', named_struct('id', album_id),
        'artists', array(named_struct('id', 't' || album_id, 'external_urls', {links('ar', "'t' || album_id")}))))))"""
    docs = parsed(c, bodies(c.src_album, page), api.SEARCH)
    return lines([rows for tables in api.search_pages(docs).values() for rows in tables])


# three entries: a usable one, a local one, and one whose track is gone
ENTRIES = f"""'[' || to_json(named_struct('added_at', '2021-03-04T05:06:07Z', 'added_by', named_struct('id', user_id),
    'track', named_struct('id', 't' || playlist_id, 'name', name, 'is_local', false, 'external_urls', {links('tr', "'t' || playlist_id")},
      'album', named_struct('id', 'al' || playlist_id, 'name', name, 'release_date', ''),
      'artists', array(named_struct('id', 'various'))))) ||
  ', {{"added_at": "2021-03-04T05:06:07Z", "track": {{"id": "local", "is_local": true, "artists": [{{"id": "x"}}]}}}}' ||
  ', {{"added_at": "2021-03-04T05:06:07Z", "track": null}}, null]'"""
ENTRY_LINES = [
    line_sql("artist", "'various'; null; null", "src_playlist"),
    line_sql(
        "track",
        "'t' || playlist_id; null; null; null; null; 'u/tr/t' || playlist_id; name; null; null; null; 'al' || playlist_id",
        "src_playlist",
    ),
    line_sql("artist_track", "'various'; 't' || playlist_id", "src_playlist"),
    line_sql(
        "playlist_track",
        "playlist_id; 't' || playlist_id; timestamp '2021-03-04 05:06:07'; user_id; 'u/tr/t' || playlist_id",
        "src_playlist",
    ),
]


@query(
    "j04_playlist",
    all_of(
        line_sql("playlist", PLAYLIST_VALUES + "; followers_count", "src_playlist"),
        line_sql("user", "user_id; 'u/us/' || user_id; 'user ' || user_id", "src_playlist"),
        *ENTRY_LINES,
    ),
)
def api_playlist(c):
    doc = f"""named_struct({API_PLAYLIST_HEAD}, 'followers', named_struct('total', followers_count),
      'tracks', named_struct('items', '@@'))"""
    docs = parsed(c, spliced(c.src_playlist, doc, ENTRIES), api.PLAYLIST)
    return lines(api.playlists(docs))


@query("j05_playlist_page", all_of(*ENTRY_LINES))
def api_playlist_page(c):
    page = "named_struct('href', 'https://x/playlists/' || playlist_id || '/tracks?offset=0', 'items', '@@')"
    docs = parsed(c, spliced(c.src_playlist, page, ENTRIES), api.ENTRY_PAGE)
    return lines(api.playlist_pages(docs))


@query(
    "j07_album_tracks",
    all_of(
        line_sql("artist", "'a' || track_id; 'u/ar/a' || track_id; name", "src_track"),
        line_sql("artist_track", "'a' || track_id; track_id", "src_track"),
        line_sql(
            "track",
            "track_id; null; disc_number; duration_ms; explicit; 'u/tr/' || track_id; name; 'market'; length(name); album_id",
            "src_track",
        ),
    ),
)
def album_tracks(c):
    page = f"named_struct('items', array(null, {API_TRACK}))"
    docs = parsed(c, bodies(c.src_track, page, "album_id"), api.TRACK_PAGE)
    return lines(api.album_track_pages(docs))


# ---- web player ------------------------------------------------------------------------------------

# every fifth part of the albums has a full date, others a year only or none; ids sit in the address
# for singles
WEB_ALBUM = """named_struct('id', if(album_type = 'single', null, album_id), 'uri', 'catalogue:album:' || album_id,
  'name', name, 'type', upper(album_type), 'label', label,
  'coverArt', named_struct('sources', if(cover_image is null, array(), array(named_struct('url', cover_image), named_struct('url', 'small')))),
  'date', if(release_date is null, null, named_struct(
     'precision', upper(release_date_precision),
     'isoString', if(length(release_date) = 10, release_date || 'T00:00:00Z', null),
     'year', try_cast(substr(release_date, 1, 4) as int))))"""
WEB_ALBUM_VALUES = f"""album_id; album_type; '{SITE}/album/' || album_id; cover_image; name;
  case when length(release_date) = 10 then release_date when release_date <> '' then substr(release_date, 1, 4) end;
  case when length(release_date) = 10 or release_date = '' then release_date_precision when release_date is not null then 'year' end; label"""
WEB_ALBUM_LINE = line_sql("album", WEB_ALBUM_VALUES, "src_album")


@query("j08_web_album", WEB_ALBUM_LINE)
def web_album(c):
    docs = parsed(c, bodies(c.src_album, WEB_ALBUM), web.ALBUM)
    return lines(web.albums(docs, SITE))


@query(
    "j09_web_artist_releases",
    line_sql("album", WEB_ALBUM_VALUES, "src_album where album_type <> 'ep'"),
)
def web_artist_releases(c):
    """Pages of complete discographies; for some artists nothing was found."""
    page = """named_struct('data', named_struct('artistUnion', named_struct(
      '__typename', if(album_type = 'ep', 'NotFound', 'Artist'),
      'discography', named_struct('all', named_struct('items', '@@')))))"""
    releases = f"""'[{{"releases": {{"items": [' || to_json({WEB_ALBUM}) ||
      ', {{"name": "second edition"}}]}}}}, {{"releases": {{"items": []}}}}]'"""
    docs = parsed(c, spliced(c.src_album, page, releases), web.ARTIST_PAGE, needs="data")
    return lines(web.artist_releases(docs, SITE))


DISCOGRAPHY = f"""named_struct(
  'albums', if(album_type = 'album', named_struct('items', array(named_struct('releases', named_struct('items', array({WEB_ALBUM}))))), null),
  'popularReleasesAlbums', named_struct('items', array(null, {WEB_ALBUM})),
  'singles', if(album_type = 'single', named_struct('items', array(named_struct('releases', named_struct('items', array({WEB_ALBUM}))))), null),
  'latest', if(album_type = 'compilation', {WEB_ALBUM}, null))"""
DISCOGRAPHY_LINES = [
    WEB_ALBUM_LINE,
    line_sql("album", WEB_ALBUM_VALUES, "src_album where album_type <> 'ep'"),
    line_sql("artist_album", "'a' || album_id; album_id", "src_album"),
    line_sql("artist_album", "'a' || album_id; album_id", "src_album where album_type <> 'ep'"),
]


@query("j10_web_discography", all_of(*DISCOGRAPHY_LINES))
def web_discography(c):
    rows = bodies(c.src_album, DISCOGRAPHY, "'a' || album_id as artist_id")
    ddl = web.DISCOGRAPHY.removeprefix("struct<").removesuffix(">")
    docs = parsed(c, rows, ddl)
    return lines(web.discographies(docs, SITE))


WEB_TRACK = """'uri', 'catalogue:track:' || track_id, 'name', name, 'trackNumber', length(name),
  'playcount', coalesce(cast(plays_count as string), ''), 'contentRating', named_struct('label', if(explicit, 'EXPLICIT', 'NONE')),
  'artists', named_struct('items', array(null, named_struct('uri', 'catalogue:artist:a' || track_id)))"""
WEB_SIMPLE_ARTIST = """named_struct('id', if(explicit, null, 'a' || track_id), 'uri', 'catalogue:artist:a' || track_id,
  'profile', named_struct('name', name), 'visuals', named_struct('avatarImage',
    if(disc_number is null, null, named_struct('sources', array(named_struct('url', 'i/' || track_id))))))"""
WEB_SIMPLE_ARTIST_VALUES = f"""'a' || track_id; '{SITE}/artist/a' || track_id; case when disc_number is not null then 'i/' || track_id end; name"""


@query(
    "j11_web_album_page",
    all_of(
        line_sql("artist", WEB_SIMPLE_ARTIST_VALUES, "src_track where explicit is not null"),
        line_sql("album", f"album_id; 'album'; '{SITE}/album/' || album_id; null; name; null; null; null", "src_track where explicit is not null"),
        line_sql("artist_album", "'a' || track_id; album_id", "src_track where explicit is not null"),
        line_sql("album", f"'m' || album_id; 'single'; '{SITE}/album/m' || album_id; null; null; null; null; null", "src_track where explicit is not null"),
        line_sql(
            "track",
            f"track_id; album_id; disc_number; duration_ms; '{SITE}/track/' || track_id; name; length(name); plays_count; explicit",
            "src_track where explicit is not null",
        ),
        line_sql("artist_track", "'a' || track_id; track_id", "src_track where explicit is not null"),
    ),
)
def web_album_page(c):
    """Album pages with one track and a NULL item; some are not found, some have no tracks."""
    page = f"""named_struct('data', named_struct('albumUnion', named_struct(
      '__typename', if(explicit is null and disc_number is null, 'NotFound', 'Album'), 'id', album_id, 'name', name, 'type', 'ALBUM',
      'artists', named_struct('items', array({WEB_SIMPLE_ARTIST}, null)),
      'tracksV2', named_struct('items', if(explicit is null, array(), array(null, named_struct('track', named_struct({WEB_TRACK},
        'discNumber', disc_number, 'duration', named_struct('totalMilliseconds', duration_ms)))))),
      'moreAlbumsByArtist', named_struct('items', array(named_struct('discography', named_struct('popularReleasesAlbums',
        named_struct('items', array(null, named_struct('uri', 'catalogue:album:m' || album_id, 'type', 'SINGLE'))))))))))"""
    docs = parsed(c, bodies(c.src_track, page), web.ALBUM_PAGE, needs="data")
    return lines(web.album_pages(docs, SITE))


WEB_ARTIST_PAGE = """named_struct('data', named_struct('artistUnion', named_struct('__typename', 'Artist', 'id', artist_id,
  'profile', named_struct('name', name), 'visuals', named_struct('avatarImage', if(followers_count is null, null,
    named_struct('sources', array(named_struct('url', 'i/' || artist_id))))),
  'stats', named_struct('followers', followers_count, 'monthlyListeners', monthly_listeners),
  'relatedContent', if(genres is null, null, named_struct(
    'appearsOn', named_struct('items', array(null, named_struct('releases', named_struct('items', array(named_struct(
       'id', 'g' || artist_id, 'type', 'ALBUM', 'name', genres[0],
       'artists', named_struct('items', array(named_struct('uri', 'catalogue:artist:' || artist_id), named_struct('uri', 'catalogue:artist:various'))))))))),
    'featuringV2', named_struct('items', array(named_struct('data', named_struct('id', 'p' || artist_id)), null)),
    'relatedArtists', named_struct('items', array(named_struct('id', 'r' || artist_id), null)))))))"""


@query(
    "j12_web_artist_page",
    all_of(
        line_sql(
            "artist",
            f"""artist_id; '{SITE}/artist/' || artist_id; followers_count; case when followers_count is not null then 'i/' || artist_id end; name; null;
            monthly_listeners""",
            "src_artist",
        ),
        line_sql("album", f"'g' || artist_id; 'album'; '{SITE}/album/g' || artist_id; null; genres[1]; null; null; null", "src_artist where genres is not null"),
        line_sql("artist_album", "artist_id; 'g' || artist_id", "src_artist where genres is not null"),
        line_sql("artist_album", "'various'; 'g' || artist_id", "src_artist where genres is not null"),
        line_sql("related", "artist_id; 'g' || artist_id; 'p' || artist_id; 'r' || artist_id", "src_artist where genres is not null"),
        line_sql("related", "artist_id; null; null; null", "src_artist where genres is null"),
    ),
)
def web_artist_page(c):
    docs = parsed(c, bodies(c.src_artist, WEB_ARTIST_PAGE), web.ARTIST_PAGE, needs="data")
    return lines([*web.artist_pages(docs, SITE), Rows("related", web.artist_related(docs))])


WEB_TRACK_PAGE = f"""named_struct('data', named_struct('trackUnion', named_struct('__typename', 'Track', 'id', track_id, 'name', name,
  'playcount', cast(plays_count as string), 'trackNumber', length(name),
  'contentRating', named_struct('label', if(explicit, 'EXPLICIT', 'NONE')), 'duration', named_struct('totalMilliseconds', duration_ms),
  'albumOfTrack', named_struct('uri', 'catalogue:album:' || album_id, 'type', 'ALBUM',
     'date', named_struct('year', if(disc_number is null, null, 2000 + disc_number))),
  'firstArtist', named_struct('items', array(named_struct('id', 'a' || track_id, 'profile', named_struct('name', name),
     'discography', named_struct('latest', named_struct('id', 'l' || album_id, 'type', 'EP'))))),
  'otherArtists', if(explicit, named_struct('items', array(named_struct('uri', 'catalogue:artist:various'))), null))))"""


@query(
    "j13_web_track_page",
    all_of(
        line_sql("album", f"album_id; 'album'; '{SITE}/album/' || album_id; null; null; 2000 + disc_number; 'year'; null", "src_track where disc_number is not null"),
        line_sql("artist", f"'a' || track_id; '{SITE}/artist/a' || track_id; null; name", "src_track"),
        line_sql("artist", f"'various'; '{SITE}/artist/various'; null; null", "src_track where explicit"),
        line_sql("album", f"'l' || album_id; 'ep'; '{SITE}/album/l' || album_id; null; null; null; null; null", "src_track"),
        line_sql("artist_album", "'a' || track_id; 'l' || album_id", "src_track"),
        line_sql(
            "track",
            f"track_id; album_id; '{SITE}/track/' || track_id; duration_ms; name; length(name); coalesce(explicit, false); plays_count",
            "src_track",
        ),
        line_sql("artist_track", "'a' || track_id; track_id", "src_track"),
        line_sql("artist_track", "'various'; track_id", "src_track where explicit"),
    ),
)
def web_track_page(c):
    docs = parsed(c, bodies(c.src_track, WEB_TRACK_PAGE), web.TRACK_PAGE, needs="data")
    return lines(web.track_pages(docs, SITE))


WEB_ENTRY = """named_struct('addedAt', named_struct('isoString', if(public, '2021-03-04T05:06:07Z', '2021-03-04T05:06:07.250Z')),
  'addedBy', if(collaborative, named_struct('data', named_struct('id', if(public, user_id, 'adder'), 'name', 'someone')), null),
  'itemV2', named_struct('data', named_struct('__typename', 'Track', 'uri', 'catalogue:track:t' || playlist_id, 'name', name,
    'playcount', '1234', 'trackNumber', 3, 'contentRating', named_struct('label', 'NONE'), 'trackDuration', named_struct('totalMilliseconds', 60000),
    'albumOfTrack', named_struct('uri', 'catalogue:album:al' || playlist_id),
    'artists', named_struct('items', array(named_struct('uri', 'catalogue:artist:various'))))))"""
WEB_PLAYLIST_PAGE = """named_struct('data', named_struct('playlistV2', named_struct('__typename', 'Playlist',
  'uri', 'catalogue:playlist:' || playlist_id, 'name', name, 'description', if(public, '', 'text'), 'followers', coalesce(followers_count, 0),
  'basePermission', if(collaborative, 'CONTRIBUTOR', 'VIEWER'), 'revisionId', snapshot_id,
  'images', named_struct('items', array(named_struct('sources', array(named_struct('url', 'c/' || playlist_id))))),
  'ownerV2', named_struct('data', named_struct('uri', 'catalogue:user:' || user_id, 'name', 'user ' || user_id)),
  'content', named_struct('__typename', 'PlaylistItemsPage', 'items', '@@'))))"""
WEB_ENTRIES = f"""if(snapshot_id = 'MACHINERY', '[]',
  '[{{"itemV2": {{"data": {{"__typename": "Episode", "uri": "catalogue:episode:1"}}}}}}, ' || to_json({WEB_ENTRY}) || ']')"""
LISTED = "src_playlist where snapshot_id <> 'MACHINERY'"


@query(
    "j14_web_playlist_page",
    all_of(
        line_sql("user", f"user_id; '{SITE}/user/' || user_id; 'user ' || user_id; null", LISTED),
        line_sql("user", f"'adder'; '{SITE}/user/adder'; 'someone'; null", LISTED + " and collaborative and not public"),
        line_sql(
            "playlist",
            f"""playlist_id; collaborative; case when not public then 'text' end; '{SITE}/playlist/' || playlist_id; nullif(followers_count, 0);
            'c/' || playlist_id; name; user_id; snapshot_id; true""",
            LISTED,
        ),
        line_sql("track", f"'t' || playlist_id; 'al' || playlist_id; '{SITE}/track/t' || playlist_id; 60000; name; 3; false; 1234", LISTED),
        line_sql("artist_track", "'various'; 't' || playlist_id", LISTED),
        line_sql(
            "playlist_track",
            """playlist_id; 't' || playlist_id; case when public then '2021-03-04 05:06:07' else '2021-03-04 05:06:07.25' end;
            case when collaborative then case when public then user_id else 'adder' end end""",
            LISTED,
        ),
    ),
)
def web_playlist_page(c):
    docs = parsed(c, spliced(c.src_playlist, WEB_PLAYLIST_PAGE, WEB_ENTRIES), web.PLAYLIST_PAGE, needs="data")
    return lines(web.playlist_pages(docs, SITE))


# ---- storing -------------------------------------------------------------------------------------------


def empty_targets(c):
    return {
        name: c.spark.createDataFrame([], table.schema)
        for name, table in SOURCE_TABLES.items()
    }


@query(
    "j15_store_documents",
    """select t.track_id, t.name, t.album_id, t.plays_count, t.disc_number, t.duration_ms, 'u/tr/' || t.track_id as url,
    timestamp '2024-01-01 00:00:00' as created_at,
    case when coalesce(t.explicit, false) is distinct from t.explicit or t.plays_count is not null
      then timestamp '2024-01-02 00:00:00' else timestamp '2024-01-01 00:00:00' end as updated_at from src_track t""",
)
def store_documents(c):
    """Tracks held from the API, then changed by web pages, which know plays but no disc."""
    held = storing.store(
        empty_targets(c),
        api.tracks(parsed(c, bodies(c.src_track, API_TRACK), api.TRACK)),
        dt.datetime(2024, 1, 1),
    )
    pages = parsed(c, bodies(c.src_track, WEB_TRACK_PAGE), web.TRACK_PAGE, needs="data")
    # the page repeats the address of the API, so only plays and the explicit mark differ
    rows = [
        Rows(r.table, r.df.withColumn("url", F.concat(F.lit("u/tr/"), "track_id")) if r.table == "track" else r.df)
        for r in web.track_pages(pages, SITE)
    ]
    targets = empty_targets(c) | held
    stored = storing.store(targets, rows, dt.datetime(2024, 1, 2))["track"]
    return stored.select(
        "track_id", "name", "album_id", "plays_count", "disc_number", "duration_ms", "url", "created_at", "updated_at"
    )


@query(
    "j15_store_shared_artist",
    """select 'various' as artist_id, 'various' as name, count(*) as albums from src_album
    union all select 'a' || album_id, label, 1 from src_album""",
)
def store_shared_artist(c):
    """An artist on every album ends up as one row; each link is stored."""
    docs = parsed(c, bodies(c.src_album, API_ALBUM), api.ALBUM)
    stored = storing.store(empty_targets(c), api.albums(docs), dt.datetime(2024, 1, 2))
    albums = stored["artist_album"].groupBy("artist_id").agg(F.count(F.lit(1)).alias("albums"))
    return stored["artist"].select("artist_id", "name").join(albums, "artist_id")


@query(
    "j16_released_albums",
    """select distinct album_id, '2020-0' || cast(1 + (duration_ms // 10000) % 9 as varchar) as release_date
    from src_track where duration_ms % 30000 <> 0""",
)
def released_albums(c):
    """Of the albums named by tracks only those with a release date are stored."""
    docs = parsed(c, bodies(c.src_track, API_TRACK), api.TRACK)
    albums = next(r.df for r in api.tracks(docs) if r.table == "album")
    return albums.select("album_id", "release_date").dropDuplicates()


@query(
    "j17_play_count",
    """select page_id, case page_id % 4 when 0 then 1000000 + page_id when 1 then 2000 + page_id end as plays_count from pages""",
)
def html_play_count(c):
    """Whole pages with the count in the link to the track, by test id, elsewhere, or nowhere."""
    track = F.concat(F.lit("t"), F.col("page_id").cast("string"))
    million = F.format_number(F.col("page_id") + 1_000_000, 0)
    in_link = F.concat(
        F.lit('<a class="x" href="/track/other"><span class="encore-text-marginal">5</span></a><a href="/track/'),
        track,
        F.lit('"><div>name</div><span class="a encore-text-marginal b">'),
        million,
        F.lit("</span></a></article>"),
    )
    by_test_id = F.concat(
        F.lit('<span data-testid="playcount">'),
        F.format_number(F.col("page_id") + 2_000, 0),
        F.lit("</span></article>"),
    )
    elsewhere = F.concat(F.lit('<a href="/track/'), track, F.lit('">name</a><span class="encore-text-marginal">9</span></article>'))
    kind = F.col("page_id") % 4
    marked = F.when(kind == 0, in_link).when(kind == 1, by_test_id).when(kind == 2, elsewhere).otherwise("</article>")
    html = F.replace("html", F.lit("</article>"), marked)
    return c.pages.select("page_id", play_count(html, track).alias("plays_count"))


@query(
    "j18_rejected_bodies",
    """select case when event_type = 'click' then 'malformed' else 'no data' end as reason, count(*) as n
    from events where event_type in ('click', 'error') group by 1""",
)
def rejected_bodies(c):
    """Bodies cut off and bodies without data are handed back, empty ones dropped."""
    cut = F.expr("substring(props, 1, length(props) - 1)")
    body = (
        F.when(F.col("event_type") == "click", cut)
        .when(F.col("event_type") == "error", F.col("props"))
        .when(F.col("event_type") == "view", F.lit(None))
        .otherwise(F.format_string('{"data": {"k": %s}}', F.col("event_id").cast("string")))
    )
    rows = c.events.select(F.expr(FETCHED).alias("fetched_at"), body.alias("body"))
    _, rejected = parse_bodies(rows, "data: struct<k: int>", needs="data")
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
