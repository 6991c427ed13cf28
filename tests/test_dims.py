"""Dimensions and facts on rows made for their edges."""

import datetime as dt

import duckdb

from tonearm.plans import dims, facts, marts
from tonearm.queries.oracle import with_ctes


def test_date_dimension_equals_sql(spark, rows):
    found = dims.date_dimension(spark)
    expected = duckdb.sql(with_ctes("select * from dim_date"))
    assert found.columns == expected.columns
    assert rows(found) == sorted(expected.fetchall(), key=repr)
    assert found.count() == 146_097 + 1 + 400 + 4_800


def artists(spark, *rows):
    return spark.createDataFrame(list(rows), "artist_id string, genres array<string>")


def test_genre_keys_never_move(spark, rows):
    first = dims.with_unknown_genre(dims.stage_genre(artists(spark, ("1", ["Rock", "pop", "", None]))))
    assert rows(first) == [(-1, "unknown"), (1, "pop"), (2, "rock")]
    second = dims.stage_genre(artists(spark, ("2", ["ambient", "ROCK", "zouk"]), ("3", None)), first)
    assert rows(second) == [(1, "pop"), (2, "rock"), (3, "ambient"), (4, "zouk")]


def test_newest_row_wins(spark, rows):
    def row(name, day):
        return ("u", name, "url", dt.datetime(2024, 1, day))

    df = spark.createDataFrame([row("b", 1), row("a", 3), row("c", 2)], "user_id string, name string, url string, updated_at timestamp")
    assert rows(dims.stage_user(df)) == [("u", "a", "url")]


PLAYLIST_DIM = "playlist_key string, user_key string, flag boolean"
ARTIST_DIM = "artist_key string, genres array<string>, flag boolean"
GENRE_DIM = "genre_key bigint, name string"


def playlist_facts(spark, entries):
    return facts.playlist_track(
        spark.createDataFrame(entries, "playlist_id string, track_id string, added_at string"),
        spark.createDataFrame([("x", "t1"), ("y", "t1"), ("gone", "t2")], "artist_id string, track_id string"),
        spark.createDataFrame([("p", "u", True), ("p", "old", False)], PLAYLIST_DIM),
        spark.createDataFrame([("x", ["Pop", "pop", "new"], True), ("x", ["old"], False), ("y", None, True)], ARTIST_DIM),
        spark.createDataFrame([(-1, "unknown"), (1, "pop"), (2, "old")], GENRE_DIM),
    )


def test_playlist_facts(spark, rows):
    found = playlist_facts(
        spark,
        [
            ("p", "t1", "2024-01-02T03:04:05Z"), ("p", "t1", "2024-01-02T23:00:00Z"), ("q", "t1", "bad"),
            ("r", "t1", "bad"), ("p", "t2", "2024-01-02T03:04:05Z"),
        ],
    )
    day = dt.date(2024, 1, 2)
    assert rows(found) == sorted(
        [
            (20240102, "p", "u", -1, "t1", day), (20240102, "p", "u", 1, "t1", day),
            (0, "unknown", "unknown", -1, "t1", None), (0, "unknown", "unknown", 1, "t1", None),
        ],
        key=repr,
    )


def test_album_facts_of_late_albums(spark, rows):
    tracks = spark.createDataFrame(
        [("t1", "a1", dt.datetime(2024, 1, 1)), ("t2", "a2", dt.datetime(2024, 1, 2))],
        "track_id string, album_id string, created_at timestamp",
    )

    def staged(tracks, albums, **options):
        return facts.album_track(
            tracks,
            spark.createDataFrame([("x", "a1"), ("x", "a2"), ("x", "a2"), ("gone", "a2")], "artist_id string, album_id string"),
            spark.createDataFrame(albums, "album_key string, release_date_key int"),
            spark.createDataFrame([("x", ["pop"], True)], ARTIST_DIM),
            spark.createDataFrame([(1, "pop")], GENRE_DIM),
            **options,
        )

    first = staged(tracks, [("a2", 20200000)], run_date=dt.date(2024, 1, 2))
    assert rows(first) == [(20200000, "a2", "x", 1, "t2")]
    pending = facts.unplaced_tracks(tracks, first)
    assert rows(pending, "track_id") == [("t1",)]
    assert rows(staged(pending, [("a1", 0), ("a2", 20200000)])) == [(0, "a1", "x", 1, "t1")]


def test_preference_counts_tracks_once_and_merges_equal_names(spark, rows):
    found = marts.user_genre_preference(
        spark.createDataFrame(
            [("u1", 1, "t"), ("u1", 1, "t"), ("u2", 1, "t"), ("u3", 1, "t"), ("u1", -1, "t")],
            "user_key string, genre_key bigint, track_key string",
        ),
        spark.createDataFrame([("u1", "ann"), ("u2", "ann"), ("u3", "")], "user_key string, name string"),
        spark.createDataFrame([(1, "pop")], GENRE_DIM),
        spark.createDataFrame([("t", 5, True), ("t", 9, False)], "track_key string, plays_count bigint, flag boolean"),
    )
    assert rows(found) == [("ann", "pop", 2, 10)]


def test_gaining_a_genre_does_not_count_again(spark, rows):
    ddl = "release_date_key int, album_key string, artist_key string, genre_key bigint, track_key string"
    held = spark.createDataFrame([(20200500, "a", "x", 1, "t1")], ddl)
    staged = spark.createDataFrame([(20200500, "a", "x", 2, "t1"), (20200500, "a", "x", 1, "t2"), (20200500, "a", "x", 2, "t2")], ddl)
    dates = dims.date_dimension(spark)
    assert rows(marts.album_track_metric(staged, held, dates)) == [(5, 2020, "a", "x", 1)]
    assert rows(marts.album_track_metric(staged, held, dates, "full")) == [(5, 2020, "a", "x", 1)]
    assert rows(marts.album_track_metric(staged, None, dates)) == [(5, 2020, "a", "x", 2)]
