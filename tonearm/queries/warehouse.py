"""Warehouse builds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tonearm.plans import dims, facts, marts
from tonearm.queries.registry import query

RUN_DATE = dt.date(2024, 1, 2)


@query("h01_dim_album", "select * from dim_album")
def dim_album(c):
    return dims.stage_album(c.src_album)


@query(
    "h02_dim_artist",
    "select artist_key, name, array_to_string(genres, ',') as genres, url, followers_count, monthly_listeners from dim_artist",
)
def dim_artist(c):
    return dims.stage_artist(c.src_artist).withColumn("genres", F.array_join("genres", ","))


@query("h03_dim_genre", "select genre_key, name from dim_genre where genre_key > 0")
def dim_genre(c):
    return dims.stage_genre(c.src_artist)


@query("h04_dim_user", "select * from dim_user")
def dim_user(c):
    return dims.stage_user(c.src_user)


@query("h05_dim_playlist", "select * from dim_playlist")
def dim_playlist(c):
    return dims.stage_playlist(c.src_playlist)


@query("h06_dim_track", "select * from dim_track")
def dim_track(c):
    return dims.stage_track(c.src_track)


@query(
    "h07_dim_date",
    """select d.date_key, d.date_actual, d.day_of_week, d.day_of_month, d.day_of_year, d.month_of_year,
    d.month_name, d.quarter, d.year, d.is_weekend, count(e.added_at) as entries
    from dim_day d left join src_playlist_track e on d.date_actual = cast(substr(e.added_at, 1, 10) as date)
    group by all""",
)
def dim_date(c):
    """All calendar days, with the number of playlist entries added on each."""
    from tonearm.functions.dates import date_of_text

    added = c.src_playlist_track.groupBy(date_of_text("added_at").alias("date_actual")).agg(
        F.count(F.lit(1)).alias("entries")
    )
    days = dims.calendar_days(c.spark)
    found = days.join(added, "date_actual", "left")
    return found.select(*days.columns, F.coalesce("entries", F.lit(0)).alias("entries"))


@query(
    "h08_dim_date_special",
    """select d.date_key, d.month_of_year, d.month_name, d.year, d.quarter, d.day_of_week, count(a.album_key) as albums
    from dim_date d left join dim_album a on a.release_date_key = d.date_key
    where d.date_actual is null group by all""",
)
def dim_date_special(c):
    """All unknown, year and month members, with the number of albums released then."""
    albums = c.dim_album.groupBy(F.col("release_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("albums")
    )
    return (
        dims.special_dates(c.spark)
        .join(albums, "date_key", "left")
        .withColumn("albums", F.coalesce("albums", F.lit(0)))
        .select("date_key", "month_of_year", "month_name", "year", "quarter", "day_of_week", "albums")
    )


@query("h09_dim_genre_unknown", "select genre_key, name from dim_genre")
def dim_genre_unknown(c):
    return dims.with_unknown_genre(dims.stage_genre(c.src_artist))


@query("h10_fact_album_track", "select * from fact_album_track")
def fact_album_track(c):
    return c.fact_album_track(RUN_DATE)


@query(
    "h10_fact_album_track_late",
    """select release_date_key, album_key, artist_key, genre_key, track_key from fact_album_track_all
    where track_key not in (select track_key from fact_album_track)""",
)
def fact_album_track_late(c):
    """All tracks that the facts of a run lack."""
    unplaced = facts.unplaced_tracks(c.src_track, c.fact_album_track(RUN_DATE))
    return facts.album_track(unplaced, c.src_artist_album, c.dim_album, c.dim_artist, c.dim_genre)


@query("h11_fact_playlist_track", "select * from fact_playlist_track")
def fact_playlist_track(c):
    return c.fact_playlist_track


METRIC = """select d.month_of_year as release_month, d.year as release_year, f.album_key, f.artist_key,
    count(distinct (f.release_date_key, f.track_key)) as tracks_count
    from {} f join dim_date d on f.release_date_key = d.date_key group by 1, 2, 3, 4"""


@query("h12_album_track_metric", METRIC.format("fact_album_track"))
def album_track_metric(c):
    return marts.album_track_metric(c.fact_album_track(RUN_DATE), None, c.dim_date)


@query(
    "h12_album_track_metric_next",
    METRIC.format(
        """(select release_date_key, album_key, artist_key, track_key from fact_album_track_all
        except select release_date_key, album_key, artist_key, track_key from fact_album_track)"""
    ),
)
def album_track_metric_next(c):
    """The metric of a run that finds facts of an earlier one; it stages all tracks."""
    return marts.album_track_metric(c.fact_album_track(), c.fact_album_track(RUN_DATE), c.dim_date, "full")


@query(
    "h13_user_genre_preference",
    """select u.name, g.name as genre, count(*) as tracks_count, sum(t.plays_count) as tracks_plays_count
    from heard h, dim_user u, dim_genre g, dim_track t
    where h.user_key = u.user_key and h.genre_key = g.genre_key and h.track_key = t.track_key and u.name <> ''
    group by all""",
    heard="select distinct user_key, genre_key, track_key from fact_playlist_track where genre_key <> -1",
)
def user_genre_preference(c):
    return marts.user_genre_preference(c.fact_playlist_track, c.dim_user, c.dim_genre, c.dim_track)


@query(
    "h14_favorite_track",
    """select month(f.date_actual) as added_month, year(f.date_actual) as added_year, f.track_key, t.name as track_name,
    case when t.duration_ms < 180000 then 'short' when t.duration_ms > 240000 then 'long' else 'normal' end as duration_category,
    t.plays_count, count(distinct (f.date_actual, f.playlist_key)) as total_playlists,
    count(distinct (f.date_actual, f.user_key)) as total_users
    from fact_playlist_track f join dim_track t using (track_key) group by all""",
)
def favorite_track(c):
    return marts.favorite_track(c.fact_playlist_masks, c.dim_date, c.dim_track)
