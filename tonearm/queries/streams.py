"""Change streams to metrics, and the crawl frontier."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tonearm.plans import frontier
from tonearm.queries.registry import query
from tonearm.session import working_folder
from tonearm.streaming import changes, crawl

# ---- change streams ----------------------------------------------------------------------------


def stream_of(c, name):
    """A given table as a stream of files; a pattern, as the table is one file or a folder of them."""
    return c.spark.readStream.schema(c.table(name).schema).parquet(f"{c.folder}/{name}.parquet*")


def envelope(op, row, table):
    source = F.struct(F.lit(table).alias("table"))
    return F.to_json(F.struct(op.alias("op"), row.alias("after"), source.alias("source")))


def artist_messages(c):
    """Events as wrapped change records; errors stand for deletions, views for the first snapshot."""
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "view", "r").otherwise("u")
    row = F.struct(
        F.col("user_id").cast("string").alias("artist_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("updated_at"),
        F.floor("value").alias("followers_count"),
        F.col("event_id").alias("monthly_listeners"),
        F.lit("x").alias("name"),
    )
    return stream_of(c, "events").select(
        F.lit("server.public.artist").alias("topic"),
        envelope(op, row, "artist").alias("value"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("kafka_time"),
        F.col("event_id").alias("kafka_offset"),
    )


def playlist_messages(c):
    """Orders as bare rows; the count is missing on those in process."""
    row = F.struct(
        F.col("o_custkey").cast("string").alias("playlist_id"),
        F.unix_micros(F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))).alias("updated_at"),
        F.when(F.col("o_orderstatus") != "P", F.floor("o_totalprice")).alias("followers_count"),
    )
    return stream_of(c, "orders").select(
        F.lit("server.public.playlist").alias("topic"),
        F.to_json(row).alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("kafka_time"),
        F.col("o_orderkey").alias("kafka_offset"),
    )


def track_messages(c):
    row = F.struct(
        F.col("l_partkey").cast("string").alias("track_id"),
        F.unix_micros(F.date_trunc("month", F.col("l_shipdate").cast("timestamp"))).alias("updated_at"),
        F.floor("l_extendedprice").alias("plays_count"),
    )
    return stream_of(c, "lineitem").select(
        F.lit("server.public.track").alias("topic"),
        envelope(F.lit("c"), row, "track").alias("value"),
        F.col("l_shipdate").cast("timestamp").alias("kafka_time"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("kafka_offset"),
    )


def stored_metrics(c, messages, name, times=1):
    """Metric rows after the stream was read to its end, ``times`` over from the start."""
    table, root = changes.METRIC_TABLES[name], working_folder(c.spark, "metrics")
    rows = changes.metric_rows(changes.unwrap_changes(messages, table), table)
    parts = []
    for number in range(times):
        path = f"{root}/table_{number}"
        changes.write_metrics(rows, path, f"{root}/checkpoint_{number}", once=True).awaitTermination()
        parts.append(c.spark.read.parquet(path))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


ARTIST_CHANGES = """select cast(user_id as varchar) as artist_key, date_trunc('second', ts) as tracked_at,
    cast(floor(value) as bigint) as followers_count, event_id as monthly_listeners,
    date_trunc('second', ts) as kafka_time, event_id as kafka_offset from events where event_type <> 'error'"""


@query(
    "a14_change_source",
    """select 'server.public.artist' as topic, count(*) as n from events union all
    select 'server.public.playlist', count(*) from orders union all select 'server.public.track', count(*) from lineitem""",
)
def change_source(c):
    """Messages of all three topics, stored as they come and read back as a stream of files."""
    root = working_folder(c.spark, "messages")
    for number, messages in enumerate((artist_messages(c), playlist_messages(c), track_messages(c))):
        messages.writeStream.format("parquet").option("path", f"{root}/in/part_{number}").option(
            "checkpointLocation", f"{root}/made_{number}"
        ).trigger(availableNow=True).start().awaitTermination()
    read = changes.file_messages(c.spark, f"{root}/in/*", maxFilesPerTrigger="100")
    read.writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/read"
    ).trigger(availableNow=True).start().awaitTermination()
    return c.spark.read.parquet(f"{root}/out").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a15_metric_sink_by_day",
    "select cast(tracked_at as date) as day, count(*) as n from changes group by 1",
    changes=ARTIST_CHANGES,
)
def metric_sink_by_day(c):
    rows = stored_metrics(c, artist_messages(c), "artist")
    return rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query(
    "i01_unwrap_changes",
    """select event_type, count(*) as n, sum(cast(floor(value) as bigint)) as followers from events
    where event_type <> 'error' group by 1""",
)
def unwrap_changes(c):
    """Records of another table and deletions are left out, unlisted columns dropped."""
    table = changes.METRIC_TABLES["artist"]
    op = F.when(F.col("event_type") == "error", "d").otherwise("u")
    row = F.struct(
        F.col("event_type").alias("artist_id"),
        F.lit(0).alias("updated_at"),
        F.floor("value").alias("followers_count"),
        F.col("props").alias("other"),
    )
    parts = []
    for name in ("artist", "album"):
        parts.append(
            c.events.select(
                F.lit(f"server.public.{name}").alias("topic"),
                envelope(op, row, name).alias("value"),
                F.lit(None).cast("timestamp").alias("kafka_time"),
                F.col("event_id").alias("kafka_offset"),
            )
        )
    rows = changes.unwrap_changes(parts[0].unionByName(parts[1]), table)
    return rows.groupBy(F.col("artist_id").alias("event_type")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("followers_count").alias("followers")
    )


@query("i02_artist_metrics", ARTIST_CHANGES)
def artist_metrics(c):
    return stored_metrics(c, artist_messages(c), "artist").drop("day")


@query(
    "i03_playlist_metrics",
    """select cast(o_custkey as varchar) as playlist_key, date_trunc('month', o_orderdate)::timestamp as tracked_at,
    case when o_orderstatus <> 'P' then cast(floor(o_totalprice) as bigint) end as followers_count,
    o_orderdate as kafka_time, o_orderkey as kafka_offset from orders""",
)
def playlist_metrics(c):
    return stored_metrics(c, playlist_messages(c), "playlist").drop("day")


@query(
    "i04_track_metrics",
    """select cast(l_partkey as varchar) as track_key, date_trunc('month', l_shipdate)::timestamp as tracked_at, cast(floor(l_extendedprice) as bigint) as plays_count,
    l_shipdate as kafka_time, l_orderkey * 10 + l_linenumber as kafka_offset from lineitem""",
)
def track_metrics(c):
    return stored_metrics(c, track_messages(c), "track").drop("day")


@query(
    "i05_latest_metrics",
    """select playlist_key, tracked_at, followers_count, kafka_offset from
    (select cast(o_custkey as varchar) as playlist_key, date_trunc('month', o_orderdate)::timestamp as tracked_at,
      case when o_orderstatus <> 'P' then cast(floor(o_totalprice) as bigint) end as followers_count, o_orderkey as kafka_offset,
      row_number() over (partition by o_custkey, date_trunc('month', o_orderdate) order by o_orderkey desc) as rn from orders) where rn = 1""",
)
def latest_metrics(c):
    """The stream is stored twice; reading gives each key and second once."""
    table = changes.METRIC_TABLES["playlist"]
    rows = stored_metrics(c, playlist_messages(c), "playlist", times=2)
    latest = changes.latest_metrics(rows.drop("day"), table)
    return latest.select("playlist_key", "tracked_at", "followers_count", "kafka_offset")


# ---- crawl frontier ------------------------------------------------------------------------------


def crawl_messages(lines):
    """Lines as crawl messages: three topics, some failed, some without an id."""
    topic = (
        F.when(F.col("l_returnflag") == "A", frontier.ALBUM_TRACKS)
        .when(F.col("l_returnflag") == "R", frontier.TRACK_WEB)
        .otherwise(frontier.ARTIST_WEB)
    )
    id_ = (
        F.when(F.col("l_returnflag") == "A", F.col("l_orderkey"))
        .when(F.col("l_returnflag") == "R", F.col("l_partkey"))
        .otherwise(F.col("l_suppkey"))
    )
    return lines.select(
        topic.alias("topic"),
        F.lit(0).cast("bigint").alias("key_ts"),
        F.when(F.col("l_linenumber") != 3, id_.cast("string")).alias("object_id"),
        F.when(F.col("l_linenumber") == 5, "broken").alias("error"),
    )


CRAWL_IDS = f"""select distinct case l_returnflag when 'A' then '{frontier.ALBUM_TRACKS}' when 'R' then '{frontier.TRACK_WEB}'
      else '{frontier.ARTIST_WEB}' end as topic,
    cast(case l_returnflag when 'A' then l_orderkey when 'R' then l_partkey else l_suppkey end as varchar) as object_id
    from lineitem where l_linenumber not in (3, 5)"""


@query("i06_distinct_ids_by_topic", CRAWL_IDS)
def ids_by_topic(c):
    return crawl.distinct_ids_by_topic(crawl_messages(c.lineitem))


def tracking_of(c):
    """Singles are tracked for one function on the day they changed, other albums for another."""
    done = F.when(F.col("album_type") == "single", "crawl_albums").otherwise("crawl_tracks_by_album_id")
    return c.src_album.select(
        done.alias("function_name"),
        F.lit("album_id").alias("main_arg_name"),
        F.col("album_id").alias("main_arg_value"),
        F.col("updated_at").cast("date").alias("tracked_at"),
    )


GATE = "select distinct album_id from src_artist_album where album_id not in (select album_id from src_album where album_type = 'single'{})"


@query("i07_frontier_gate", GATE.format(""))
def frontier_gate(c):
    ids = c.src_artist_album.select("album_id").dropDuplicates()
    return frontier.should_crawl(ids, "album_id", tracking_of(c), "crawl_albums", "album_id")


@query("i07_frontier_refresh", "select distinct album_id from src_artist_album")
def frontier_refresh(c):
    ids = c.src_artist_album.select("album_id").dropDuplicates()
    return frontier.should_crawl(ids, "album_id", tracking_of(c), "crawl_albums", "album_id", refresh=True)


@query("i08_frontier_gate_today", GATE.format(" and updated_at = timestamp '2024-01-02 00:00:00'"))
def frontier_gate_today(c):
    ids = c.src_artist_album.select("album_id").dropDuplicates()
    return frontier.should_crawl(
        ids, "album_id", tracking_of(c), "crawl_albums", "album_id", today=dt.date(2024, 1, 2)
    )


@query(
    "i09_record_tracked",
    """select distinct 'crawl_albums' as function_name, 'album_id' as main_arg_name, album_id as main_arg_value,
    date '2024-01-02' as tracked_at from src_artist_album where album_id not in
    (select album_id from src_album where album_type = 'single' and updated_at = timestamp '2024-01-02 00:00:00')""",
)
def record_tracked(c):
    return frontier.newly_tracked(
        c.src_artist_album, "album_id", tracking_of(c), "crawl_albums", "album_id", dt.date(2024, 1, 2)
    )


CRAWLED = {
    frontier.ALBUM_TRACKS: ("crawl_album", "album_id"),
    frontier.TRACK_WEB: ("crawl_track", "track_id"),
    frontier.ARTIST_WEB: ("crawl_artist", "artist_id"),
}
FUNCTION_OF_TOPIC = " ".join(f"when '{topic}' then '{function}'" for topic, (function, _) in CRAWLED.items())


@query(
    "i09_frontier_stream",
    f"""select object_id, case topic {FUNCTION_OF_TOPIC} end as function_name, date '2024-01-02' as tracked_at,
    0 as pass from ({CRAWL_IDS})""",
)
def frontier_stream(c):
    """Messages of three topics to chunks and tracking rows, as streams with one tracking path.

    Work of a second pass over all topics, with new checkpoints, would come with pass 1: there must be none, and no
    tracking row may be lost.
    """
    root, passes = working_folder(c.spark, "crawl"), []
    for number in (0, 1):
        for topic, (function, argument) in CRAWLED.items():
            crawl.run_frontier(
                crawl_messages(stream_of(c, "lineitem")),
                f"{root}/work_{number}",
                f"{root}/tracking",
                f"{root}/checkpoint_{number}_{function}",
                topic,
                function,
                argument,
                lambda: dt.date(2024, 1, 2),
                once=True,
            ).awaitTermination()
        work = c.spark.read.schema("shard int, chunk int, ids array<string>").parquet(f"{root}/work_{number}")
        passes.append(work.select(F.explode("ids").alias("object_id"), F.lit(number).alias("pass")))
    tracking = crawl.read_tracking(c.spark, f"{root}/tracking").withColumnRenamed("main_arg_value", "object_id")
    # ids of different topics may be equal, so work and tracking are matched by number of rows too
    times = tracking.groupBy("object_id").agg(F.collect_list(F.struct("function_name", "tracked_at")).alias("tracked"))
    found = passes[0].unionByName(passes[1]).groupBy("object_id", "pass").agg(F.count(F.lit(1)).alias("n"))
    found = found.join(times, "object_id").where((F.col("pass") == 1) | (F.col("n") == F.size("tracked")))
    return found.select("object_id", F.inline("tracked"), "pass").select("object_id", "function_name", "tracked_at", "pass")


# ---- fan-out ----------------------------------------------------------------------------------------


def line_ids(c):
    return c.lineitem.select(
        F.col("l_partkey").cast("string").alias("track_id"),
        F.when(F.col("l_linenumber") != 2, F.col("l_orderkey").cast("string")).alias("album_id"),
        F.col("l_suppkey").cast("string").alias("artist_id"),
    )


def lines_sql():
    return """(select cast(l_partkey as varchar) as track_id, case when l_linenumber <> 2 then cast(l_orderkey as varchar) end as album_id,
    cast(l_suppkey as varchar) as artist_id from lineitem) l"""


TRACK_FANOUT = f"""select track_id as source_id, '{frontier.TRACK_WEB}' as topic, track_id as object_id from {lines_sql()}
    union all select track_id, '{frontier.ALBUM_TRACKS}', album_id from {lines_sql()} where album_id is not null
    union all select track_id, '{frontier.ARTIST_WEB}', artist_id from {lines_sql()}
    union all select track_id, '{frontier.ARTIST_WEB}', 'a' || artist_id from {lines_sql()}"""


def track_results(c):
    artists = F.array(F.col("artist_id"), F.concat(F.lit("a"), F.col("artist_id")))
    return line_ids(c).withColumn("artist_ids", artists)


@query("i11_track_fanout", TRACK_FANOUT)
def track_fanout(c):
    return frontier.track_messages(track_results(c))


@query(
    "i12_artist_fanout",
    f"""select artist_id as source_id, '{frontier.ARTIST_OFFICIAL}' as topic, artist_id as object_id from src_artist
    union all select artist_id, '{frontier.ALBUM_TRACKS}', unnest(genres) from src_artist
    union all select artist_id, '{frontier.PLAYLIST_TRACKS}', name from src_artist where name is not null
    union all select artist_id, '{frontier.TRACK_WEB}', url from src_artist where followers_count is not null""",
)
def artist_fanout(c):
    return frontier.artist_messages(
        c.src_artist.select(
            "artist_id",
            F.col("genres").alias("album_ids"),
            F.array("name").alias("playlist_ids"),
            F.when(F.col("followers_count").isNotNull(), F.array("url")).alias("track_ids"),
        )
    )


@query(
    "i13_artist_albums_fanout",
    f"""select artist_id as source_id, '{frontier.ALBUM_TRACKS}' as topic, album_id as object_id from {lines_sql()} where album_id is not null
    union all select distinct artist_id, '{frontier.ARTIST_WEB}', unnest([artist_id, track_id]) from {lines_sql()}""",
)
def artist_albums_fanout(c):
    """The artist itself and the track key stand for the co-artists of each album."""
    return frontier.artist_albums_messages(
        line_ids(c).withColumn("artist_ids", F.array("artist_id", "track_id", "artist_id"))
    )


@query(
    "i14_track_albums_fanout",
    f"""select track_id as source_id, '{frontier.TRACK_OFFICIAL}' as topic, track_id as object_id from {lines_sql()}
    union all select track_id, '{frontier.ALBUM_TRACKS}', album_id from {lines_sql()} where album_id is not null
    union all select track_id, '{frontier.ALBUM_TRACKS}', artist_id from {lines_sql()} where artist_id is distinct from album_id""",
)
def track_albums_fanout(c):
    """The album again and the artist key stand for more albums."""
    return frontier.track_albums_messages(
        line_ids(c).withColumn("more_album_ids", F.array("artist_id", "artist_id", "album_id"))
    )


@query(
    "i15_search_fanout",
    f"""select 'album' as kind, album_id as source_id, '{frontier.ALBUM_TRACKS}' as topic, album_id as object_id from src_album
    union all select 'artist', artist_id, unnest(['{frontier.ARTIST_WEB}', '{frontier.ARTIST_ALBUMS}']), artist_id from src_artist
    union all select 'playlist', playlist_id, unnest(['{frontier.PLAYLIST}', '{frontier.PLAYLIST_TRACKS}']), playlist_id from src_playlist
    union all select distinct 'playlist', user_id, '{frontier.USER_PLAYLISTS}', user_id from src_playlist
    union all select 'track', * from ({TRACK_FANOUT})""",
)
def search_fanout(c):
    found = {"album": c.src_album, "artist": c.src_artist, "playlist": c.src_playlist, "track": track_results(c)}
    result = None
    for kind, rows in found.items():
        part = frontier.search_messages(kind, rows).select(F.lit(kind).alias("kind"), "source_id", "topic", "object_id")
        result = part if result is None else result.unionByName(part)
    return result


REACHED = """select t.track_id, t.album_id, b.artist_id, pt.playlist_id from src_artist a
    join src_artist_track b on a.artist_id = b.artist_id join src_track t on b.track_id = t.track_id
    left join src_playlist_track pt on t.track_id = pt.track_id
    where list_has_any(a.genres, ['africa', 'NATION_3'])"""
MONITOR_LIST = """select 'album' as object_name, album_id as object_value from reached
    union select 'artist', artist_id from reached union select 'track', track_id from reached
    union select 'playlist', playlist_id from reached where playlist_id is not null"""


def monitored(c):
    return frontier.monitor_list(
        c.src_artist, c.src_artist_track, c.src_track, c.src_playlist_track, ["africa", "NATION_3"]
    )


@query("i16_monitor_list", MONITOR_LIST, reached=REACHED)
def monitor_list(c):
    return monitored(c)


@query(
    "i17_monitor_dispatch",
    f"""select object_name, object_value, object_name in ('artist', 'playlist', 'track') as accepted from ({MONITOR_LIST})
    union all select null, album_id, false from src_album""",
    reached=REACHED,
)
def monitor_dispatch(c):
    """Messages of the list, and some without an object name."""
    nameless = c.src_album.select(
        F.lit(None).cast("string").alias("object_name"), F.col("album_id").alias("object_value")
    )
    accepted, rejected = frontier.dispatch_monitored(monitored(c).unionByName(nameless))
    return accepted.withColumn("accepted", F.lit(True)).unionByName(rejected.withColumn("accepted", F.lit(False)))
