"""Projections, filters and column functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tonearm.functions import change, dates, values
from tonearm.operators.find import find_many, find_one
from tonearm.operators.fold import without
from tonearm.operators.lookup import open_versions
from tonearm.queries.registry import query
from tonearm.schemas import ALBUM_TYPE_CODES, DATE_PRECISION_CODES, UNKNOWN_INT, UNKNOWN_STR


@query("b01_select_drop", "select album_id, name, url, album_type from src_album")
def select_drop(c):
    return c.src_album.select("album_id", "name", "url", "album_type", "label").drop("label")


@query(
    "b02_rename",
    "select playlist_id as playlist_key, user_id as user_key, public as is_public, name from src_playlist",
)
def rename(c):
    names = {"playlist_id": "playlist_key", "user_id": "user_key", "public": "is_public"}
    return c.src_playlist.select(*names, "name").withColumnsRenamed(names)


@query(
    "b03_blank_default",
    """select album_id, case when label is null or label = '' then 'unknown' else label end as label,
    case when cover_image is null or cover_image = '' then 'unknown' else cover_image end as cover_image
    from src_album""",
)
def blank_default(c):
    return c.src_album.select(
        "album_id",
        values.blank_to("label", UNKNOWN_STR).alias("label"),
        values.blank_to("cover_image", UNKNOWN_STR).alias("cover_image"),
    )


@query(
    "b04_null_default",
    """select track_id, coalesce(disc_number, -1) as disc_number, coalesce(explicit, false) as explicit,
    coalesce(plays_count, -1) as plays_count from src_track""",
)
def null_default(c):
    return c.src_track.select(
        "track_id",
        values.null_to("disc_number", UNKNOWN_INT).alias("disc_number"),
        values.null_to("explicit", False).alias("explicit"),
        values.null_to("plays_count", UNKNOWN_INT).alias("plays_count"),
    )


@query(
    "b05_partial_date_key",
    """select album_id, cast(coalesce(nullif(regexp_extract(release_date, '[0-9]{4}'), ''), '0000')
      || coalesce(nullif(regexp_extract(release_date, '[0-9]{4}-([0-9]{2})', 1), ''), '00')
      || coalesce(nullif(regexp_extract(release_date, '[0-9]{4}-[0-9]{2}-([0-9]{2})', 1), ''), '00') as integer)
      as release_date_key from src_album""",
)
def partial_date_key(c):
    return c.src_album.select("album_id", dates.partial_date_key("release_date").alias("release_date_key"))


@query(
    "b06_date_of_text",
    """select playlist_id, track_id, cast(substr(added_at, 1, 10) as date) as date_actual,
    cast(replace(substr(added_at, 1, 10), '-', '') as integer) as added_date_key from src_playlist_track""",
)
def date_of_text(c):
    date = dates.date_of_text("added_at")
    return c.src_playlist_track.select(
        "playlist_id", "track_id", date.alias("date_actual"), dates.day_key(date).alias("added_date_key")
    )


@query(
    "b07_album_type_code",
    """select album_id, case when album_type = 'album' then 1 when album_type = 'single' then 2
    when album_type = 'compilation' then 3 else -1 end as album_type from src_album""",
)
def album_type_code(c):
    return c.src_album.select("album_id", values.code_of("album_type", ALBUM_TYPE_CODES).alias("album_type"))


@query(
    "b08_date_precision_code",
    """select album_id, case when release_date_precision = 'year' then 1 when release_date_precision = 'month' then 2
    when release_date_precision = 'day' then 3 else -1 end as precision_code from src_album""",
)
def date_precision_code(c):
    code = values.code_of("release_date_precision", DATE_PRECISION_CODES)
    return c.src_album.select("album_id", code.alias("precision_code"))


@query("b09_lower", "select artist_id, lower(name) as name from src_artist")
def lower(c):
    return c.src_artist.select("artist_id", F.lower("name").alias("name"))


@query(
    "b10_on_date",
    "select track_id, album_id from src_track where cast(created_at as date) = date '2024-01-02'",
)
def on_date(c):
    return c.src_track.where(dates.on_date("created_at", dt.date(2024, 1, 2))).select("track_id", "album_id")


@query(
    "b11_not_null_after_join",
    """select e.playlist_id, e.track_id, p.user_key from src_playlist_track e
    left join dim_playlist p on e.playlist_id = p.playlist_key and p.followers_count >= 0
    where p.user_key is not null""",
)
def not_null_after_join(c):
    followed = c.dim_playlist.where("followers_count >= 0").select("playlist_key", "user_key")
    on = F.col("playlist_id") == F.col("playlist_key")
    joined = c.src_playlist_track.join(followed, on, "left").where(F.col("user_key").isNotNull())
    return joined.select("playlist_id", "track_id", "user_key")


@query("b12_explode", "select artist_id, unnest(genres) as genre from src_artist")
def explode(c):
    return c.src_artist.select("artist_id", F.explode("genres").alias("genre"))


@query(
    "b13_explode_outer",
    """select artist_id, unnest(case when genres is null or len(genres) = 0 then [null] else genres end) as genre
    from src_artist""",
)
def explode_outer(c):
    return c.src_artist.select("artist_id", F.explode_outer("genres").alias("genre"))


@query(
    "b14_arrays_overlap",
    "select artist_id from src_artist where list_has_any(genres, ['africa', 'NATION_3', 'EUROPE'])",
)
def arrays_overlap(c):
    return c.src_artist.where(values.shares_any("genres", ["africa", "NATION_3", "EUROPE"])).select("artist_id")


@query("b15_array_to_text", "select artist_id, array_to_string(genres, ',') as genres from src_artist")
def array_to_text(c):
    return c.src_artist.select("artist_id", values.joined_text("genres").alias("genres"))


@query(
    "b16_strict_hash",
    """select album_id, sha256(name || '|' || cover_image || '|' || label || '|' || release_date) as row_hash
    from src_album""",
)
def strict_hash(c):
    row_hash = change.strict_hash(["name", "cover_image", "label", "release_date"])
    return c.src_album.select("album_id", row_hash.alias("row_hash"))


@query(
    "b17_lenient_hash",
    """select track_key, md5(concat_ws('|', name, url, album_key, disc_number, duration_ms, is_explicit, plays_count))
    as row_hash from (select track_id as track_key, name, url, album_id as album_key, disc_number, duration_ms,
      explicit as is_explicit, plays_count from src_track)""",
)
def lenient_hash(c):
    columns = ["name", "url", "album_id", "disc_number", "duration_ms", "explicit", "plays_count"]
    return c.src_track.select(
        F.col("track_id").alias("track_key"), change.lenient_hash(columns).alias("row_hash")
    )


@query(
    "b18_duration_class",
    """select track_id, case when duration_ms / 60000.0 < 3 then 'short' when duration_ms / 60000.0 <= 4 then 'normal'
    else 'long' end as duration_category from src_track""",
)
def duration_class(c):
    return c.src_track.select("track_id", values.duration_class("duration_ms").alias("duration_category"))


@query(
    "b19_sentinel_filter",
    """select t.track_key, t.plays_count, u.user_key from dim_track t
    join fact_playlist_track f on f.track_key = t.track_key join dim_user u on u.user_key = f.user_key
    where f.genre_key != -1 and u.name != '' and t.plays_count != -1
    group by all""",
)
def sentinel_filter(c):
    facts = without(c.fact_playlist_masks, UNKNOWN_INT)
    tracks = open_versions(c.dim_track).where(F.col("plays_count") != UNKNOWN_INT)
    pairs = facts.select("track_key", "user_key").dropDuplicates()
    users = c.dim_user.where("name != ''").select("user_key")
    joined = pairs.join(tracks, "track_key").join(users, "user_key")
    return joined.select("track_key", "plays_count", "user_key")


@query(
    "b20_micros_to_timestamp",
    "select event_id, date_trunc('second', ts) as tracked_at from events",
)
def micros_to_timestamp(c):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return c.events.select("event_id", dates.micros_to_timestamp(micros).alias("tracked_at"))


@query(
    "b21_date_parts",
    """select o_orderkey, dayofweek(o_orderdate) + 1 as day_of_week, day(o_orderdate) as day_of_month,
    dayofyear(o_orderdate) as day_of_year, month(o_orderdate) as month_of_year, monthname(o_orderdate) as month_name,
    quarter(o_orderdate) as quarter, year(o_orderdate) as year, dayofweek(o_orderdate) in (0, 6) as is_weekend
    from orders""",
)
def date_parts(c):
    parts = dates.date_parts(F.col("o_orderdate").cast("date"))
    return c.orders.select("o_orderkey", *[part.alias(name) for name, part in parts.items()])


@query(
    "b22_date_keys",
    """select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as integer) as day_key,
    cast(strftime(o_orderdate, '%Y%m00') as integer) as month_key,
    cast(strftime(o_orderdate, '%Y0000') as integer) as year_key from orders""",
)
def date_keys(c):
    return c.orders.select(
        "o_orderkey",
        dates.day_key("o_orderdate").alias("day_key"),
        dates.month_key("o_orderdate").alias("month_key"),
        dates.year_key("o_orderdate").alias("year_key"),
    )


@query(
    "b23_audit_stamps",
    """select album_key, name, timestamp '2024-01-02 00:00:00' as created_at, timestamp '2024-01-02 00:00:00' as updated_at
    from dim_album""",
)
def audit_stamps(c):
    return c.dim_album.select("album_key", "name").withColumns(dates.audit_stamps(dt.datetime(2024, 1, 2)))


@query(
    "b24_tuple_equality",
    """select a.album_id, b.release_date from src_album a join src_album b
    on (a.album_id, a.label, a.cover_image) = (b.album_id, b.label, b.cover_image)
    where a.label is not null and a.cover_image is not null""",
)
def tuple_equality(c):
    keys = ["album_id", "label", "cover_image"]
    left, right = c.src_album.select(*keys), c.src_album.select(*keys, "release_date")
    joined = left.alias("a").join(right.alias("b"), change.same_keys("a", "b", keys))
    return joined.select("a.album_id", "b.release_date")


@query(
    "b25_between",
    """select o_orderkey from orders
    where year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) between 19960301 and 19980915""",
)
def between(c):
    return c.orders.where(dates.day_key("o_orderdate").between(19960301, 19980915)).select("o_orderkey")


@query(
    "b26_id_from_uri",
    """select cast(p_partkey as varchar) as track_id, 'https://catalogue.example/track/' || p_partkey as url from part""",
)
def id_from_uri(c):
    """Half of the rows lack the id and give it in the address only."""
    key = F.col("p_partkey").cast("string")
    rows = c.part.select(
        F.when(F.col("p_size") > 25, key).alias("id"), F.concat(F.lit("catalogue:track:"), key).alias("uri")
    )
    track_id = values.id_from_uri("id", "uri", "track")
    return rows.select(
        track_id.alias("track_id"),
        values.page_url("https://catalogue.example", "track", track_id).alias("url"),
    )


@query(
    "b27_iso_timestamp",
    """select event_id, case when event_type = 'click' then date_trunc('second', ts) when event_type = 'error' then null
    else ts end as added_at from events""",
)
def iso_timestamp(c):
    """Texts without a fraction, with one, and no timestamp at all."""
    seconds = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fraction = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    text = (
        F.when(F.col("event_type") == "click", seconds)
        .when(F.col("event_type") == "error", F.col("props"))
        .otherwise(fraction)
    )
    return c.events.select("event_id", dates.iso_timestamp(text).alias("added_at"))


@query(
    "b28_is_label",
    "select l_orderkey, l_linenumber, l_returnflag = 'R' as is_returned from lineitem",
)
def is_label(c):
    return c.lineitem.select("l_orderkey", "l_linenumber", values.is_label("l_returnflag", "r").alias("is_returned"))


@query(
    "b29_text_to_int",
    """select o_orderkey, case when o_orderstatus = 'P' then null else cast(floor(o_totalprice) as bigint) end as plays
    from orders""",
)
def text_to_int(c):
    """Numbers with separators, empty texts and words."""
    number = F.format_number(F.floor("o_totalprice"), 0)
    text = F.when(F.col("o_orderstatus") != "P", number).when(F.col("o_totalprice") > 1e5, "")
    return c.orders.select("o_orderkey", values.text_to_int(text.otherwise(F.col("o_orderpriority"))).alias("plays"))


@query(
    "b30_first_last",
    """select artist_id, genres[1] as first_genre, genres[len(genres)] as last_genre from src_artist""",
)
def first_last(c):
    return c.src_artist.select(
        "artist_id",
        values.first_of("genres").alias("first_genre"),
        values.last_of("genres").alias("last_genre"),
    )


@query(
    "b31_falsy_to_null",
    """select playlist_id, nullif(coalesce(followers_count, 0), 0) as followers_count,
    case when snapshot_id = 'MACHINERY' then null else snapshot_id end as snapshot_id from src_playlist""",
)
def falsy_to_null(c):
    return c.src_playlist.select(
        "playlist_id",
        values.falsy_to_null(F.coalesce("followers_count", F.lit(0)), 0).alias("followers_count"),
        values.falsy_to_null(F.replace("snapshot_id", F.lit("MACHINERY"), F.lit("")), "").alias("snapshot_id"),
    )


@query(
    "b32_nested_field",
    """select event_id, cast(regexp_extract(props, '[0-9]+') as integer) as k, 'none' as label from events""",
)
def nested_field(c):
    doc = F.from_json("props", "k int, content struct<rating: struct<label: string>>")
    return c.events.select("event_id", doc.alias("doc")).select(
        "event_id", F.col("doc.k").alias("k"), values.null_to("doc.content.rating.label", "none").alias("label")
    )


@query(
    "b33_derived_table",
    """with linked as (select t.track_id, t.album_id, b.artist_id from src_track t join src_artist_track b on t.track_id = b.track_id),
    per_artist as (select artist_id, count(distinct album_id) as albums, count(*) as tracks from linked group by artist_id)
    select a.artist_id, a.name, p.albums, p.tracks from src_artist a join per_artist p on a.artist_id = p.artist_id""".replace(
        "with linked as", "select * from (with linked as"
    )
    + ")",
)
def derived_table(c):
    linked = c.src_track.join(c.src_artist_track, "track_id").select("artist_id", "album_id", "track_id")
    per_artist = linked.groupBy("artist_id").agg(
        F.count_distinct("album_id").alias("albums"), F.count(F.lit(1)).alias("tracks")
    )
    return c.src_artist.join(per_artist, "artist_id").select("artist_id", "name", "albums", "tracks")


@query(
    "f04_find_many",
    """select album_id, label from src_album where album_type = 'single' and label is not null and release_date_precision = 'day'""",
)
def select_filtered(c):
    found = find_many(
        c.src_album, F.col("album_type") == "single", F.col("label").isNotNull(), "release_date_precision = 'day'"
    )
    return found.select("album_id", "label")


@query(
    "f04_find_one",
    """select playlist_id, name, followers_count from src_playlist where collaborative and public
    order by followers_count desc nulls last, playlist_id limit 1""",
)
def find_first(c):
    found = find_one(
        c.src_playlist, "collaborative", "public", order=[F.desc_nulls_last("followers_count"), "playlist_id"]
    )
    return found.select("playlist_id", "name", "followers_count")
