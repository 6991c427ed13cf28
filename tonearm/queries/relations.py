"""Joins, aggregates, deduplication, numbering and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tonearm.functions.change import any_differs, same_keys
from tonearm.operators import dedup
from tonearm.operators.fold import MASK, WORD, not_in_folded, unfold
from tonearm.operators.lookup import not_in, open_versions
from tonearm.operators.merge import key_range, match_sides
from tonearm.operators.numbering import chunk_ids, dense_numbers
from tonearm.plans import dims, frontier
from tonearm.queries.oracle import STORED_FACTS
from tonearm.queries.registry import query
from tonearm.queries.warehouse import RUN_DATE
from tonearm.schemas import UNKNOWN_INT
from tonearm.session import working_folder
from tonearm.sources import warehouse
from tonearm.sources.lake import high_watermark

FACT_KEYS = ["added_date_key", "playlist_key", "user_key", "genre_key", "track_key"]

# ---- joins -----------------------------------------------------------------------------------


@query(
    "c01_track_album",
    """select t.track_id, a.release_date_key from src_track t left join dim_album a on t.album_id = a.album_key
    where a.release_date_key is not null""",
)
def track_album(c):
    albums = c.dim_album.select(F.col("album_key").alias("album_id"), "release_date_key")
    return c.src_track.join(albums, "album_id").select("track_id", "release_date_key")


@query(
    "c02_left_join_using",
    """select e.playlist_id, e.track_id, b.artist_id from src_playlist_track e left join src_artist_track b using (track_id)""",
)
def left_join_using(c):
    joined = c.src_playlist_track.join(c.src_artist_track, ["track_id"], "left")
    return joined.select("playlist_id", "track_id", "artist_id")


@query(
    "c03_left_join_dimension",
    """select e.track_id, e.playlist_id, p.playlist_key, p.user_key from src_playlist_track e
    left join dim_playlist p on e.playlist_id = p.playlist_key and p.is_public""",
)
def left_join_dimension(c):
    public = open_versions(c.dim_playlist).where("is_public").select("playlist_key", "user_key")
    on = F.col("playlist_id") == F.col("playlist_key")
    return c.src_playlist_track.join(public, on, "left").select("track_id", "playlist_id", "playlist_key", "user_key")


@query(
    "c04_genre_key_lookup",
    "select artist_key, genre_key from artist_genre_key",
)
def genre_key_lookup(c):
    from tonearm.plans.facts import artist_genres

    return artist_genres(c.dim_artist, c.dim_genre)


@query(
    "c05_fact_anti_join",
    """select s.* from stored_facts s left join
    (select * from stored_facts where date_actual < date '1998-01-01') p
    on s.added_date_key = p.added_date_key and s.playlist_key = p.playlist_key and s.user_key = p.user_key
    and s.genre_key = p.genre_key and s.track_key = p.track_key where p.track_key is null""",
    stored_facts=STORED_FACTS,
)
def fact_anti_join(c):
    """The fact is stored first, folded by genre, so that it is built once for both sides and moved as entries."""
    root = working_folder(c.spark, "staging")
    warehouse.write_staging(c.fact_playlist_masks, root, "facts")
    staged = warehouse.read_table(c.spark, root, "facts")
    held = staged.where("date_actual < '1998-01-01'")
    return not_in_folded(staged, held, FACT_KEYS, "genre_key").select(*FACT_KEYS, "date_actual")


@query(
    "c06_new_keys",
    "select track_key, name from track_day2 where track_key not in (select track_key from track_day1)",
)
def new_keys(c):
    return not_in(c.track_day2, c.track_day1, ["track_key"]).select("track_key", "name")


STATES = """select coalesce(t.track_key, s.track_key) as track_key,
    case when t.track_key is null then 'new' when s.track_key is null then 'missing'
    when t.name is distinct from s.name or t.plays_count is distinct from s.plays_count then 'changed'
    else 'unchanged' end as state
    from (select * from track_day1 where flag) t full join track_day2 s on t.track_key = s.track_key"""


def _states(sides):
    state = (
        F.when(F.col("t._present").isNull(), "new")
        .when(F.col("s._present").isNull(), "missing")
        .when(any_differs("t", "s", ["name", "plays_count"]), "changed")
        .otherwise("unchanged")
    )
    return sides.select(F.coalesce("t.track_key", "s.track_key").alias("track_key"), state.alias("state"))


@query("c07_full_outer", STATES)
def full_outer(c):
    return _states(match_sides(c.track_day1.where("flag"), c.track_day2, ["track_key"], "full"))


@query("c08_left_join_staging", STATES)
def left_join_staging(c):
    return _states(match_sides(c.track_day1.where("flag"), c.track_day2, ["track_key"], "delta"))


@query(
    "c09_join_open_versions",
    """select s.track_key, s.name, t.valid_from from track_day2 s join track_day1 t on s.track_key = t.track_key
    where t.valid_to is null""",
)
def join_open_versions(c):
    held = c.track_day1.where(F.col("valid_to").isNull()).select("track_key", "valid_from")
    return c.track_day2.join(held, "track_key").select("track_key", "name", "valid_from")


@query(
    "c10_star_join",
    """select u.name as user_name, g.name as genre, t.is_explicit, count(*) as n from fact_playlist_track f
    join dim_user u on f.user_key = u.user_key join dim_genre g on f.genre_key = g.genre_key
    join dim_track t on f.track_key = t.track_key group by 1, 2, 3""",
)
def star_join(c):
    users = c.dim_user.select("user_key", F.col("name").alias("user_name"))
    genres = c.dim_genre.select("genre_key", F.col("name").alias("genre"))
    tracks = open_versions(c.dim_track).select("track_key", "is_explicit")
    kept = ["user_name", "is_explicit"]
    entries = c.fact_playlist_masks.join(users, "user_key").join(tracks, "track_key")
    # entries are counted for each set of genres before there is a row for each genre
    sets = entries.groupBy(*kept, WORD, MASK).agg(F.count(F.lit(1)).alias("entries"))
    facts = unfold(sets, "genre_key", [*kept, "genre_key", "entries"]).join(genres, "genre_key")
    return facts.groupBy("user_name", "genre", "is_explicit").agg(F.sum("entries").alias("n"))


@query(
    "c11_fact_date_track",
    """select d.year, d.month_name, t.name as track_name, count(*) as n from fact_playlist_track f
    join dim_date d on f.added_date_key = d.date_key left join dim_track t on f.track_key = t.track_key
    where t.track_key is not null group by 1, 2, 3""",
)
def fact_date_track(c):
    days = c.dim_date.select(F.col("date_key").alias("added_date_key"), "year", "month_name")
    tracks = open_versions(c.dim_track).select("track_key", F.col("name").alias("track_name"))
    per_day = c.fact_playlist_track.groupBy("added_date_key", "track_key").agg(F.count(F.lit(1)).alias("entries"))
    joined = per_day.join(days, "added_date_key").join(tracks, "track_key")
    return joined.groupBy("year", "month_name", "track_name").agg(F.sum("entries").alias("n"))


@query(
    "c12_date_lookup",
    """select a.album_key, d.month_of_year as release_month, d.year as release_year
    from dim_album a join dim_date d on a.release_date_key = d.date_key""",
)
def date_lookup(c):
    months = c.dim_date.select(
        F.col("date_key").alias("release_date_key"),
        F.col("month_of_year").alias("release_month"),
        F.col("year").alias("release_year"),
    )
    return c.dim_album.join(months, "release_date_key").select("album_key", "release_month", "release_year")


@query(
    "c13_bridge_traversal",
    """select pt.playlist_id, b.artist_id, t.album_id, t.track_id from src_artist_track b
    join src_track t on b.track_id = t.track_id left join src_playlist_track pt on t.track_id = pt.track_id
    where b.artist_id in (select artist_id from src_artist where list_has_any(genres, ['africa', 'NATION_3']))""",
)
def bridge_traversal(c):
    return frontier.tracks_of_genres(
        c.src_artist, c.src_artist_track, c.src_track, c.src_playlist_track, ["africa", "NATION_3"]
    )


# ---- aggregates and deduplication -----------------------------------------------------------


@query("d01_high_watermark", "select album_type, max(cast(updated_at as date)) as latest from src_album group by 1")
def watermark(c):
    """Per album type here; the single value over all rows is what ``high_watermark`` returns."""
    latest = high_watermark(c.src_album, "updated_at")
    per_type = c.src_album.groupBy("album_type").agg(F.max("updated_at").cast("date").alias("latest"))
    return per_type.where(F.col("latest") <= F.lit(latest))


@query("d02_key_range", "select min(release_date_key) as low, max(release_date_key) as high from dim_album")
def partition_key_range(c):
    low, high = key_range(c.dim_album, "release_date_key")
    return c.dim_album.where(F.col("release_date_key").isin(low, high)).agg(
        F.min("release_date_key").alias("low"), F.max("release_date_key").alias("high")
    )


@query(
    "d03_distinct_count_first_row",
    """select album_type, sum(case when rn = 1 then 1 else 0 end) as labels from
    (select album_type, row_number() over (partition by album_type, label, release_date_precision) as rn from src_album)
    group by album_type""",
)
def distinct_count_first_row(c):
    """NULL labels count as a value of their own."""
    unit = ["album_type", "label", "release_date_precision"]
    return dedup.count_first_rows(c.src_album, unit, ["album_type"], "labels")


@query(
    "d04_sum_first_row",
    """select user_key, sum(case when rn = 1 then 1 else 0 end) as tracks, sum(case when rn = 1 then plays_count else 0 end) as plays
    from (select f.user_key, t.plays_count, row_number() over (partition by f.user_key, f.track_key) as rn
          from fact_playlist_track f join dim_track t on f.track_key = t.track_key) group by user_key""",
)
def sum_first_row(c):
    tracks = open_versions(c.dim_track).select("track_key", "plays_count")
    joined = dedup.first_rows(c.fact_playlist_track, ["user_key", "track_key"]).join(tracks, "track_key")
    return dedup.count_first_rows(
        joined, ["user_key", "track_key"], ["user_key"], "tracks", plays=F.col("plays_count")
    )


@query(
    "d05_group_by",
    """select o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey, year(o_orderdate) as y, month(o_orderdate) as m,
    count(*) as n, sum(cast(floor(o_totalprice) as bigint)) as total from orders join customer on o_custkey = c_custkey
    group by all""",
)
def group_by(c):
    joined = c.orders.join(c.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(
        "o_orderstatus",
        "o_orderpriority",
        "c_mktsegment",
        "c_nationkey",
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor("o_totalprice")).alias("total"))


@query("d06_row_count", "select count(*) as n from fact_album_track")
def row_count(c):
    return c.fact_album_track(RUN_DATE).agg(F.count(F.lit(1)).alias("n"))


@query(
    "d07_latest_by_key",
    """select l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey from
    (select l_partkey, cast(l_shipdate as date) as l_shipdate, l_orderkey, l_linenumber, l_suppkey, row_number() over
      (partition by l_partkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_suppkey desc) as rn from lineitem)
    where rn = 1""",
)
def latest_by_key(c):
    rows = c.lineitem.select(
        "l_partkey", F.to_date("l_shipdate").alias("l_shipdate"), "l_orderkey", "l_linenumber", "l_suppkey"
    )
    return dedup.latest_by_key(rows, ["l_partkey"], ["l_shipdate"])


@query("d08_distinct_rows", "select distinct l_orderkey, l_linenumber from lineitem")
def distinct_rows(c):
    return dedup.distinct_rows(c.lineitem.select("l_orderkey", "l_linenumber"))


@query(
    "d09_replacing_latest",
    """select artist_id, updated_at, followers_count, kafka_offset from
    (select *, row_number() over (partition by artist_id, updated_at order by kafka_offset desc) as rn from src_metric_event)
    where rn = 1""",
)
def replacing_latest(c):
    rows = dedup.replacing_latest(c.src_metric_event, ["artist_id", "updated_at"], "kafka_offset")
    return rows.select("artist_id", "updated_at", "followers_count", "kafka_offset")


@query(
    "d11_distinct_ids",
    """select 'album' as object_name, album_id as object_value from src_track union
    select 'track', track_id from src_track union select 'playlist', playlist_id from src_playlist_track
    where track_id in (select track_id from src_track)""",
)
def distinct_ids(c):
    """Ids of each side by itself, so that no join product is exploded and deduplicated."""
    entries = c.src_playlist_track.join(c.src_track, "track_id", "left_semi")
    of_tracks = dedup.distinct_ids(c.src_track, {"album": "album_id", "track": "track_id"})
    return of_tracks.unionByName(dedup.distinct_ids(entries, {"playlist": "playlist_id"}))


# ---- numbering ----------------------------------------------------------------------------------


def _first_row_sql(keys: str, source: str) -> str:
    return f"select {keys} from (select {keys}, row_number() over (partition by {keys}) as rn from {source}) where rn = 1"


@query("e01_first_row_album_artist_track", _first_row_sql("release_date_key, album_key, artist_key, track_key", "fact_album_track_all"))
def first_row_album(c):
    return dedup.first_rows(c.fact_album_track(), ["release_date_key", "album_key", "artist_key", "track_key"])


@query("e02_first_row_user_genre_track", _first_row_sql("user_key, genre_key, track_key", "fact_playlist_track"))
def first_row_user_genre(c):
    return dedup.first_rows(c.fact_playlist_track, ["user_key", "genre_key", "track_key"], folded="genre_key")


@query("e03_first_row_date_track_playlist", _first_row_sql("added_date_key, track_key, playlist_key", "fact_playlist_track"))
def first_row_playlist(c):
    return dedup.first_rows(c.fact_playlist_masks, ["added_date_key", "track_key", "playlist_key"])


@query("e04_first_row_date_track_user", _first_row_sql("added_date_key, track_key, user_key", "fact_playlist_track"))
def first_row_user(c):
    return dedup.first_rows(c.fact_playlist_masks, ["added_date_key", "track_key", "user_key"])


@query(
    "e05_surrogate_key",
    """select genre_key, name from known union all
    select coalesce((select max(genre_key) from known), 0) + row_number() over (order by name), name from genre_name
    where name not in (select name from known)""",
    known="""select row_number() over (order by name) as genre_key, name from
    (select distinct lower(g) as name from (select unnest(genres) as g from src_artist where followers_count > 8000))""",
)
def surrogate_key(c):
    """Genres of all artists, those of much followed artists being known already."""
    known = dims.stage_genre(c.src_artist.where("followers_count > 8000"))
    return dims.stage_genre(c.src_artist, known)


@query(
    "e05_dense_numbers",
    "select c_name as name, row_number() over (order by c_name) as place from customer",
)
def numbers_in_order(c):
    return dense_numbers(c.customer.select(F.col("c_name").alias("name")), "name", "place", prefix=13)


# ---- set operations -----------------------------------------------------------------------------


@query(
    "f01_union_null_key",
    """select track_key as join_key, track_key, name, plays_count from track_day2 union all
    select null, s.track_key, s.name, s.plays_count from track_day2 s join track_day1 t on s.track_key = t.track_key
    where t.valid_to is null and (t.name is distinct from s.name or t.plays_count is distinct from s.plays_count)""",
)
def union_null_key(c):
    """Staging rows with their key, and changed ones again without, so that they match nothing."""
    staged = c.track_day2
    held = c.track_day1.where(F.col("valid_to").isNull())
    on = same_keys("s", "t", ["track_key"]) & any_differs("t", "s", ["name", "plays_count"])
    changed = staged.alias("s").join(held.alias("t"), on, "left_semi")
    return staged.withColumn("join_key", F.col("track_key")).unionByName(
        changed.withColumn("join_key", F.lit(None).cast("string"))
    )


THREE_WAY = f"select state, count(*) as n from ({STATES}) group by state"


@query("f02_union_by_name", THREE_WAY)
def union_by_name(c):
    states = _states(match_sides(c.track_day1.where("flag"), c.track_day2, ["track_key"], "full"))
    parts = [states.where(F.col("state") == s) for s in ("new", "changed")]
    rest = states.where(F.col("state").isin("unchanged", "missing")).select("state", "track_key")
    return parts[0].unionByName(parts[1]).unionByName(rest).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f03_union_new_and_changed",
    f"select track_key, state from ({STATES}) where state in ('new', 'changed')",
)
def union_new_and_changed(c):
    states = _states(match_sides(c.track_day1.where("flag"), c.track_day2, ["track_key"], "delta"))
    new, changed = (states.where(F.col("state") == s) for s in ("new", "changed"))
    return new.union(changed)


@query(
    "i10_chunks",
    """select 20 as chunk_size, count(distinct album_id) as ids, 0 as wrong_chunks from src_album""",
)
def chunks(c):
    """Every id is in one chunk, no chunk is too long, and only the last of a shard is short."""
    size = 20
    chunked = chunk_ids(c.src_album, "album_id", size, shards=16)
    last = chunked.groupBy("shard").agg(F.max("chunk").alias("last"))
    wrong = (F.size("ids") > size) | ((F.size("ids") < size) & (F.col("chunk") < F.col("last")))
    return chunked.join(last, "shard").agg(
        F.lit(size).alias("chunk_size"),
        F.sum(F.size("ids")).alias("ids"),
        F.count_if(wrong).cast("int").alias("wrong_chunks"),
    )
