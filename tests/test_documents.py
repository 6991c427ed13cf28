"""Documents with missing branches and odd values."""

import datetime as dt

from pyspark.sql import functions as F

from tonearm.plans import api_documents as api
from tonearm.plans import storing
from tonearm.plans import web_documents as web
from tonearm.plans.documents import parse_bodies
from tonearm.queries.documents import bodies
from tonearm.schemas import SOURCE_TABLES

SITE = "https://catalogue.example"
NOW = dt.datetime(2024, 1, 2)


def docs(spark, ddl, *bodies, needs=None):
    df = spark.createDataFrame([(NOW, b) for b in bodies], "fetched_at timestamp, body string")
    return parse_bodies(df, ddl, needs)


def table(rows_of, name, *columns):
    found = []
    for rows in rows_of:
        if rows.table == name:
            found += [tuple(r) for r in rows.df.select(*columns).collect()]
    return sorted(found, key=repr)


def test_bodies_that_cannot_be_used(spark, rows):
    good, bad = docs(
        spark, web.TRACK_PAGE, '{"data": {"trackUnion": {"id": "1"}}}', '{"data": null}', '{"data": {', "null", None, "", needs="data"
    )
    assert good.count() == 1
    assert rows(bad, "reason", "body") == sorted([("no data", '{"data": null}'), ("malformed", '{"data": {')], key=repr)


def test_album_without_images_or_links(spark):
    good, bad = docs(spark, api.ALBUM, '{"id": "1", "name": "n", "artists": null, "images": []}')
    assert bad.count() == 0
    found = api.albums(good)
    assert table(found, "album", "album_id", "cover_image", "url", "restrictions") == [("1", None, None, None)]
    assert table(found, "artist", "artist_id") == []


def test_local_and_missing_tracks_are_skipped(spark):
    body = """{"id": "p", "owner": {"id": "u"}, "tracks": {"items": [null, {"track": null}, {"track": {"id": "l", "is_local": true}},
      {"track": {"id": "t", "is_local": false, "album": {"id": "a"}}, "added_at": "2021-03-04T05:06:07Z"}]}}"""
    found = api.playlists(docs(spark, api.PLAYLIST, body)[0])
    assert table(found, "track", "track_id") == [("t",)]
    assert table(found, "album", "album_id") == []  # without a release date it is not stored
    assert table(found, "playlist_track", "playlist_id", "track_id", "added_at", "added_by") == [
        ("p", "t", dt.datetime(2021, 3, 4, 5, 6, 7), None)
    ]


def test_web_album_dates(spark):
    def body(date):
        return '{"uri": "x:album:1", "type": "EP", "date": %s}' % date

    dates = ['{"isoString": "2020-05-06T00:00:00Z", "precision": "DAY"}', '{"year": 1999, "precision": "DAY"}', '{"precision": ""}', "null"]
    good, _ = docs(spark, web.ALBUM, *[body(d) for d in dates])
    assert table(web.albums(good, SITE), "album", "album_id", "album_type", "release_date", "release_date_precision") == sorted(
        [("1", "ep", "2020-05-06", "day"), ("1", "ep", "1999", "year"), ("1", "ep", None, None), ("1", "ep", None, None)], key=repr
    )


def test_pages_without_the_object(spark):
    pages, _ = docs(
        spark, web.ALBUM_PAGE, '{"data": {"albumUnion": {"__typename": "NotFound"}}}', '{"data": {"albumUnion": {"id": "1"}}}',
        '{"data": {"albumUnion": {"id": "2", "tracksV2": {"items": [null]}}}}', needs="data",
    )
    assert all(r.df.count() == 0 for r in web.album_pages(pages, SITE))


def test_playlist_page_of_another_kind_has_no_tracks(spark):
    body = '{"data": {"playlistV2": {"id": "p", "followers": 0, "ownerV2": {"data": {"id": "u"}}, "content": {"__typename": "Other"}}}}'
    found = web.playlist_pages(docs(spark, web.PLAYLIST_PAGE, body, needs="data")[0], SITE)
    assert table(found, "playlist", "playlist_id", "followers_count", "cover_image") == [("p", None, None)]
    assert table(found, "track", "track_id") == []


def test_storing_keeps_what_a_shape_does_not_carry(spark, rows):
    targets = {n: spark.createDataFrame([], t.schema) for n, t in SOURCE_TABLES.items()}
    full, _ = docs(
        spark, api.ARTIST, '{"id": "a", "name": "A", "followers": {"total": 5}, "genres": ["pop"], "external_urls": {"home": "h"}}'
    )
    targets |= storing.store(targets, api.artists(full), dt.datetime(2024, 1, 1))
    page = '{"data": {"artistUnion": {"id": "a", "profile": {"name": "A2"}, "stats": {"followers": 6, "monthlyListeners": 7}}}}'
    seen, _ = docs(spark, web.ARTIST_PAGE, page, needs="data")
    stored = storing.store(targets, web.artist_pages(seen, SITE), NOW)["artist"]
    columns = ["artist_id", "name", "followers_count", "monthly_listeners", "genres", "created_at", "updated_at"]
    assert rows(stored, *columns) == [("a", "A2", 6, 7, ["pop"], dt.datetime(2024, 1, 1), NOW)]
    again = storing.store({**targets, "artist": stored}, web.artist_pages(seen, SITE), dt.datetime(2024, 1, 3))["artist"]
    assert rows(again, *columns) == rows(stored, *columns)


def test_storing_order_puts_parents_first(spark):
    body = '{"id": "t", "album": {"id": "a", "release_date": "2020", "artists": [{"id": "x"}]}, "artists": [{"id": "x"}]}'
    targets = {n: spark.createDataFrame([], t.schema) for n, t in SOURCE_TABLES.items()}
    stored = storing.store(targets, api.tracks(docs(spark, api.TRACK, body)[0]), NOW)
    assert list(stored) == ["artist", "album", "track", "artist_album", "artist_track"]
    assert stored["artist"].select(F.count("*")).first()[0] == 1


def test_a_body_is_made_and_parsed_once(spark):
    """Conditions on the document do not parse its body again."""
    df = spark.createDataFrame([("a",)], "id string")
    docs, rejected = parse_bodies(bodies(df, "named_struct('id', id)"), "id string", "id")
    for rows in (docs, rejected):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1 and plan.count("evaluate(named_struct") == 1
    assert docs.count() == 1 and rejected.count() == 0
