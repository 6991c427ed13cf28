"""Reading, writing, ingest and the daily run, through tables in the working folder."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.operators.fold import MASK, WORD, at_least, fold, unfold
from tonearm.plans import ingest
from tonearm.plans import warehouse as daily
from tonearm.plans.specs import DIMENSIONS, FACTS
from tonearm.queries.registry import query
from tonearm.schemas import SOURCE_TABLES
from tonearm.session import side_by_side, working_folder
from tonearm.sources import lake, warehouse

DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]


def source_rows(c, name):
    """A catalogue view with all columns of its source table; missing ones are NULL.

    Bridges, playlists and users get a change day from the first character of their last key.
    """
    table = SOURCE_TABLES[name]
    view = getattr(c, f"src_{name}")
    if "updated_at" not in view.columns:
        if "created_at" in view.columns:
            changed = F.col("created_at")
        else:
            digit = F.substring(table.keys[-1], 1, 1).cast("int")
            changed = F.date_add(F.lit(DAYS[0]), F.pmod(digit, F.lit(3))).cast("timestamp")
        view = view.withColumn("updated_at", changed)
    if "created_at" not in view.columns:
        view = view.withColumn("created_at", F.col("updated_at"))
    columns = []
    for field in table.schema.fields:
        present = field.name in view.columns
        value = F.col(field.name) if present else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return view.select(*columns)


def changed_until(c, name, day):
    """The source rows as they were at the end of a day."""
    column = SOURCE_TABLES[name].incremental_col
    limit = dt.datetime.combine(day, dt.time()) + dt.timedelta(days=1)
    return source_rows(c, name).where(F.col(column) < F.lit(limit))


# the same in SQL
def source_sql(name: str) -> str:
    table = SOURCE_TABLES[name]
    if name in ("album", "artist"):
        changed = "updated_at"
    elif name == "track":
        changed = "created_at"
    else:
        changed = f"cast(date '2024-01-01' + cast(substr({table.keys[-1]}, 1, 1) as int) % 3 as timestamp)"
    return f"select *, {changed} as changed_at from src_{name}"


def ingested(c, names, days=DAYS):
    """A lake holding the extracts of the days; returns its root."""
    root = working_folder(c.spark, "lake")
    for day in days:
        ingest.ingest_all(
            c.spark, lambda table: changed_until(c, table.name, day) if table.name in names else None, root, day
        )
    return root


@query(
    "a01_incremental_extract",
    """select album_id, updated_at from src_album where cast(updated_at as date) >
    (select max(cast(updated_at as date)) from src_album where updated_at < timestamp '2024-01-03 00:00:00')""",
)
def incremental_extract(c):
    """Days after the last one in the lake."""
    held = changed_until(c, "album", DAYS[1])
    rows = lake.incremental_rows(source_rows(c, "album"), held, "updated_at", strict=True)
    return rows.select("album_id", "updated_at")


@query(
    "a01_incremental_last_day_again",
    """select album_id, updated_at from src_album where updated_at >= timestamp '2024-01-03 00:00:00'
    or (updated_at >= timestamp '2024-01-02 00:00:00' and album_type = 'single')""",
)
def incremental_last_day_again(c):
    """The lake lacks some rows of its own last day, which a strict extract would lose."""
    held = changed_until(c, "album", DAYS[1]).where(
        (F.col("updated_at") < F.lit(dt.datetime(2024, 1, 2))) | (F.col("album_type") != "single")
    )
    rows = lake.incremental_rows(source_rows(c, "album"), held, "updated_at", ["album_id"])
    return rows.select("album_id", "updated_at")


@query("a02_full_load", "select playlist_id, name, followers_count from src_playlist")
def full_load(c):
    root = working_folder(c.spark, "lake")
    held = lake.read_lake(c.spark, root, SOURCE_TABLES["playlist"])
    rows = lake.incremental_rows(source_rows(c, "playlist"), held, "updated_at", ["playlist_id"])
    return rows.select("playlist_id", "name", "followers_count")


@query(
    "a03_ingest_config",
    """select 'artist_album' as table_name, 'created_at' as incremental_col, count(*) as n from src_artist_album
    union all select 'playlist_track', 'created_at', count(*) from src_playlist_track
    union all select 'track', 'updated_at', count(*) from src_track
    union all select 'album', 'updated_at', count(*) from src_album
    union all select 'artist', 'updated_at', count(*) from src_artist
    union all select 'artist_track', 'updated_at', count(*) from src_artist_track
    union all select 'playlist', 'updated_at', count(*) from src_playlist
    union all select 'user', 'updated_at', count(*) from src_user""",
)
def ingest_config(c):
    """What each configured table would extract: rows with a change time."""
    parts = []
    for table in SOURCE_TABLES.values():
        rows = source_rows(c, table.name).select(F.col(table.incremental_col).alias("changed"))
        parts.append(
            rows.agg(F.count("changed").alias("n")).select(
                F.lit(table.name).alias("table_name"), F.lit(table.incremental_col).alias("incremental_col"), "n"
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("a04_extract_stamp", "select user_id, 2024 as extract_year, 1 as extract_month, 2 as extract_day from src_user")
def extract_stamp(c):
    return lake.stamp_extract_date(c.src_user.select("user_id"), DAYS[1])


@query(
    "a05_lake_append",
    f"""select track_id, 2024 as extract_year, 1 as extract_month, day(changed_at) as extract_day
    from ({source_sql('track')})""",
)
def lake_append(c):
    root = ingested(c, ["track"])
    rows = lake.read_lake(c.spark, root, SOURCE_TABLES["track"])
    return rows.select("track_id", "extract_year", "extract_month", "extract_day")


@query(
    "a06_counted_ingest",
    f"""select 'artist' as table_name, 1 as run, count(*) as n from ({source_sql('artist')}) where changed_at < timestamp '2024-01-02 00:00:00'
    union all select 'artist', 2, count(*) from ({source_sql('artist')}) where changed_at < timestamp '2024-01-03 00:00:00' and changed_at >= timestamp '2024-01-02 00:00:00'
    union all select 'artist', 3, 0""",
)
def counted_ingest(c):
    """Counts of rows written; the third run finds nothing new and writes nothing."""
    root, table, counts = working_folder(c.spark, "lake"), SOURCE_TABLES["artist"], []
    for run, day in enumerate((DAYS[0], DAYS[1], DAYS[1] + dt.timedelta(days=5)), start=1):
        until = min(day, DAYS[1])
        n = ingest.ingest_table(c.spark, changed_until(c, "artist", until), root, table, day)
        counts.append((table.name, run, n))
    return c.spark.createDataFrame(counts, "table_name string, run int, n bigint")


INGESTED = " union all ".join(
    f"select '{name}' as table_name, case when day(changed_at) = 1 then 1 else 3 end as extract_day, count(*) as n from ({source_sql(name)}) group by 1, 2"
    for name in SOURCE_TABLES
)


@query("a07_ingest_run", INGESTED)
def ingest_run(c):
    """All tables, in two runs."""
    root = ingested(c, list(SOURCE_TABLES), [DAYS[0], DAYS[2]])
    result = None
    for table in SOURCE_TABLES.values():
        rows = lake.read_lake(c.spark, root, table)
        part = rows.groupBy("extract_day").agg(F.count(F.lit(1)).alias("n"))
        part = part.select(F.lit(table.name).alias("table_name"), "extract_day", "n")
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "a08_lake_schema",
    f"""select playlist_id, track_id, added_at, null as added_by, changed_at as updated_at from ({source_sql('playlist_track')})""",
)
def lake_schema(c):
    root = ingested(c, ["playlist_track"])
    rows = lake.read_lake(c.spark, root, SOURCE_TABLES["playlist_track"])
    return rows.select("playlist_id", "track_id", "added_at", "added_by", "updated_at")


@query(
    "a09_lake_one_day",
    f"select album_id, release_date from ({source_sql('album')}) where changed_at = timestamp '2024-01-02 00:00:00'",
)
def lake_one_day(c):
    root = ingested(c, ["album"])
    return lake.read_lake(c.spark, root, SOURCE_TABLES["album"], DAYS[1]).select("album_id", "release_date")


@query("a10_lake_history", "select artist_id, album_id from src_artist_album")
def lake_history(c):
    root = ingested(c, ["artist_album"])
    return lake.read_lake(c.spark, root, SOURCE_TABLES["artist_album"]).select("artist_id", "album_id")


@query(
    "a11_source_guard",
    f"""select 'user' as table_name, count(*) as n from ({source_sql('user')}) where changed_at = timestamp '2024-01-02 00:00:00'""",
)
def source_guard(c):
    """One table has rows for the day, one has none for it, one does not exist."""
    root = ingested(c, ["user", "artist"], days=DAYS[:2])
    asked = {"user": DAYS[1], "artist": DAYS[2], "playlist": DAYS[1]}
    present = {}
    for name, day in asked.items():
        rows = lake.read_lake(c.spark, root, SOURCE_TABLES[name], day)
        if not lake.missing_or_empty(rows):
            present[name] = rows
    result = None
    for name, rows in present.items():
        part = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        result = part if result is None else result.unionByName(part)
    return result


@query("a12_warehouse_read", "select track_key, name, plays_count from dim_track")
def warehouse_read(c):
    root = working_folder(c.spark, "warehouse")
    warehouse.write_versions(c.dim_track, root, "dim_track", 20240101)
    return warehouse.read_versions(c.spark, root, "dim_track").select("track_key", "name", "plays_count")


@query(
    "a13_staging_write",
    "select artist_key, array_to_string(genres, ',') as genres, followers_count, n from dim_artist, (select unnest([1, 2]) as n)",
)
def staging_write(c):
    """An array column through ORC, and the same rows overwritten and appended through parquet."""
    root, columns = working_folder(c.spark, "staging"), ["artist_key", "genres", "followers_count"]
    rows = c.dim_artist.select(*columns)
    warehouse.write_staging(rows.withColumn("n", F.lit(1)), root, "as_orc", "orc")
    read = warehouse.read_table(c.spark, root, "as_orc", "orc")
    warehouse.write_staging(rows.withColumn("n", F.lit(0)), root, "as_parquet")
    warehouse.write_staging(read, root, "as_parquet")
    warehouse.write_staging(rows.withColumn("n", F.lit(2)), root, "as_parquet", mode="append")
    both = warehouse.read_table(c.spark, root, "as_parquet")
    return both.withColumn("genres", F.array_join("genres", ","))


@query(
    "a16_month_layout",
    """select date_trunc('month', date_actual)::date as added_month, count(*) as n from fact_playlist_track group by 1""",
)
def month_layout(c):
    root = working_folder(c.spark, "warehouse")
    warehouse.write_facts(c.fact_playlist_track, root, "fact_playlist_track", 20240102)
    rows = warehouse.read_facts(c.spark, root, "fact_playlist_track")
    return rows.groupBy(F.col("added_month").cast("date").alias("added_month")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a17_key_range_layout",
    """select release_date_key // 50000 * 50000 as release_bucket, count(*) as n from fact_album_track_all group by 1""",
)
def key_range_layout(c):
    root = working_folder(c.spark, "warehouse")
    warehouse.write_facts(c.fact_album_track(), root, "fact_album_track", 20240102)
    rows = warehouse.read_facts(c.spark, root, "fact_album_track")
    return rows.groupBy("release_bucket").agg(F.count(F.lit(1)).alias("n"))


@query("d10_table_exists", "select user_key, name, url from dim_user")
def table_exists(c):
    """Of two staging tables one exists; only that one is read."""
    root = working_folder(c.spark, "staging")
    warehouse.write_staging(c.dim_user, root, "dim_user")
    tables = [warehouse.read_table(c.spark, root, name) for name in ("dim_user", "dim_user_old")]
    (present,) = [t for t in tables if t is not None]
    return present


@query(
    "g07_dimension_load",
    """select 'dim_album' as table_name, count(*) as n, 0 as closed from dim_album
    union all select 'dim_artist', count(*), 0 from dim_artist union all select 'dim_genre', count(*), 0 from dim_genre
    union all select 'dim_playlist', count(*), 0 from dim_playlist
    union all select 'dim_track', 2 * count(*), count(*) from dim_track
    union all select 'dim_user', count(*), 0 from dim_user""",
)
def dimension_load(c):
    """All configured dimensions, loaded twice; on the second day every track has more plays."""
    places = daily.Places(*[working_folder(c.spark, p) for p in ("lake", "staging", "warehouse")])
    for number, day in enumerate(DAYS[:2]):
        staging = places.staging_of(warehouse.run_number(day))

        def stage(spec, source, number=number, staging=staging):
            rows = source.select(*spec.columns)
            if spec.name == "dim_track":
                rows = rows.withColumn("plays_count", F.col("plays_count") + number)
            warehouse.write_staging(rows, staging, spec.name, spec.staging_format)
            return warehouse.read_table(c.spark, staging, spec.name, spec.staging_format)

        # built once: the rows of the second day are those staged on the first
        sources = [getattr(c, name) for name in DIMENSIONS] if number == 0 else staged
        staged = side_by_side([lambda a=a: stage(*a) for a in zip(DIMENSIONS.values(), sources)])
        daily.load_dimensions(c.spark, places, day)
    result = None
    for spec in DIMENSIONS.values():
        rows = daily.read_dimension(c.spark, places.warehouse, spec.name, open_only=False)
        closed = F.count_if(~F.col("flag")) if spec.scd_type == 2 else F.lit(0)
        part = rows.agg(F.count(F.lit(1)).alias("n"), closed.alias("closed"))
        part = part.select(F.lit(spec.name).alias("table_name"), "n", F.col("closed").cast("int").alias("closed"))
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "g08_fact_load",
    """select 'fact_album_track' as table_name, genre_key, count(*) as n from fact_album_track_all group by 2
    union all select 'fact_playlist_track', genre_key, count(*) from fact_playlist_track group by 2""",
)
def fact_load(c):
    """Both fact tables: some genres on the first day, all of them on the second; staged folded, as by a daily run."""
    places = daily.Places(*[working_folder(c.spark, p) for p in ("lake", "staging", "warehouse")])
    rows = {"fact_album_track": c.fact_album_track(folded=True), "fact_playlist_track": c.fact_playlist_masks}
    rows = {name: stored(c, df, name) for name, df in rows.items()}
    for day, genres in zip(DAYS, (lambda df: at_least(df, 13), lambda df: df)):
        staging = places.staging_of(warehouse.run_number(day))
        for name in FACTS:
            warehouse.write_staging(genres(rows[name]), staging, name)
        for spec in FACTS.values():
            daily.load_fact(c.spark, spec, places, day)
    result = None
    for name in FACTS:
        part = warehouse.read_facts(c.spark, places.warehouse, name).groupBy("genre_key")
        part = part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "genre_key", "n")
        result = part if result is None else result.unionByName(part)
    return result


@query("g09_skip_missing_staging", "select 'dim_user' as loaded, count(*) as n from dim_user")
def skip_missing_staging(c):
    """Only one dimension was staged; the load of the others is skipped."""
    places = daily.Places(*[working_folder(c.spark, p) for p in ("lake", "staging", "warehouse")])
    warehouse.write_staging(c.dim_user, places.staging_of(warehouse.run_number(DAYS[0])), "dim_user")
    loaded = daily.load_dimensions(c.spark, places, DAYS[0])
    rows = daily.read_dimension(c.spark, places.warehouse, "dim_user")
    return rows.agg(F.lit(",".join(loaded)).alias("loaded"), F.count(F.lit(1)).alias("n"))


@query("g11_bulk_insert", "select artist_id, track_id from src_artist_track")
def bulk_insert(c):
    """Two appends of disjoint rows."""
    root, rows = working_folder(c.spark, "lake"), c.src_artist_track
    low = F.col("track_id") < "5"
    lake.append_rows(rows.where(low), root, "artist_track")
    lake.append_rows(rows.where(~low), root, "artist_track")
    return lake.read_if_exists(c.spark.read, lake.path_of(root, "artist_track")).select("artist_id", "track_id")


def warehouse_after(c, days):
    """The warehouse after ingesting and running each day."""
    places = daily.Places(*[working_folder(c.spark, p) for p in ("lake", "staging", "warehouse")])
    for day in days:
        ingest.ingest_all(c.spark, lambda table: changed_until(c, table.name, day), places.lake, day)
        daily.run_day(c.spark, places, day)
    return places


def stored(c, df, name):
    """A table built once for all its readers."""
    root = working_folder(c.spark, "staging")
    warehouse.write_staging(df, root, name)
    return warehouse.read_table(c.spark, root, name)


def text_of(df, table, *columns):
    """Rows of several tables as one: the name of the table and the row's values."""
    return df.select(F.lit(table).alias("table_name"), F.concat_ws("|", *columns).alias("content"))


def genres_of(masks, keys, genres):
    """The names of the genres of each entry, sorted, from its masks: named for each set of genres, not for each entry."""
    parts = F.array_sort(F.collect_list(F.struct(WORD, MASK))).alias("parts")
    entries = masks.groupBy(*keys).agg(parts)
    sets = entries.select("parts").dropDuplicates().select("parts", F.explode("parts").alias("part")).select("parts", "part.*")
    names = unfold(sets, "genre_key", ["parts", "genre_key"]).join(genres, "genre_key").groupBy("parts")
    names = names.agg(F.array_join(F.array_sort(F.collect_list("genre")), ",").alias("genres"))
    return entries.join(names, "parts").select(*keys, "genres")


ALBUM_FACT = ["release_date_key", "album_key", "artist_key", "track_key"]
PLAYLIST_FACT = ["added_date_key", "playlist_key", "user_key", "track_key"]
METRIC = ["release_month", "release_year", "album_key", "artist_key", "tracks_count"]
PREFERENCE = ["name", "genre", "tracks_count", "tracks_plays_count"]


@query(
    "h15_daily_runs",
    """select 'dim_album' as table_name, cast(count(*) as text) as content from dim_album
    union all select 'dim_artist', cast(count(*) as text) from dim_artist
    union all select 'dim_genre', cast(count(*) as text) from dim_genre
    union all select 'dim_playlist', cast(count(*) as text) from dim_playlist
    union all select 'dim_user', cast(count(*) as text) from dim_user
    union all select 'dim_track', cast(count(*) as text) from dim_track
    union all select 'fact_album_track', concat_ws('|', release_date_key, album_key, artist_key, track_key, string_agg(g.name, ',' order by g.name))
      from fact_album_track_all f join dim_genre g using (genre_key) group by release_date_key, album_key, artist_key, track_key
    union all select 'fact_playlist_track', concat_ws('|', added_date_key, playlist_key, user_key, track_key, string_agg(g.name, ',' order by g.name))
      from fact_playlist_track f join dim_genre g using (genre_key) where playlist_key <> 'unknown'
      group by added_date_key, playlist_key, user_key, track_key
    union all select 'album_track_metric', concat_ws('|', d.month_of_year, d.year, album_key, artist_key, count(distinct (release_date_key, track_key)))
      from fact_album_track_all f join dim_date d on f.release_date_key = d.date_key group by d.month_of_year, d.year, album_key, artist_key
    union all select 'user_genre_preference', concat_ws('|', u.name, g.name, count(*), sum(t.plays_count))
      from (select distinct user_key, genre_key, track_key from fact_playlist_track where genre_key <> -1) h, dim_user u, dim_genre g, dim_track t
      where h.user_key = u.user_key and h.genre_key = g.genre_key and h.track_key = t.track_key and u.name <> '' group by u.name, g.name""",
)
def daily_runs(c):
    """Two runs; at the end all is as if everything had come at once.

    Genres are named, as their keys follow the order of arrival. A fact of a playlist that came after its entries stays
    beside the one with the playlist, so facts of unknown playlists are left out, with the mart that counts playlists.
    """
    places = warehouse_after(c, [DAYS[0], DAYS[2]])
    genres = daily.read_dimension(c.spark, places.warehouse, "dim_genre").select("genre_key", F.col("name").alias("genre"))

    def facts_with_genres(table, keys, condition="true"):
        rows = warehouse.read_facts(c.spark, places.warehouse, table).where(condition)
        masks = fold(rows.select(*keys, "genre_key"), "genre_key")
        return text_of(genres_of(masks, keys, genres), table, *keys, "genres")

    parts = [
        daily.read_dimension(c.spark, places.warehouse, name)
        .agg(F.count(F.lit(1)).cast("string").alias("content"))
        .select(F.lit(name).alias("table_name"), "content")
        for name in DIMENSIONS
    ]
    parts.append(facts_with_genres("fact_album_track", ALBUM_FACT))
    parts.append(facts_with_genres("fact_playlist_track", PLAYLIST_FACT, "playlist_key <> 'unknown'"))
    parts.append(text_of(daily.read_metric(c.spark, places.warehouse), "album_track_metric", *METRIC))
    mart = warehouse.read_snapshot(c.spark, places.warehouse, "user_genre_preference")
    parts.append(text_of(mart, "user_genre_preference", *PREFERENCE))
    return reduce(DataFrame.unionByName, parts)


@query(
    "a16_month_compaction",
    """select cast(date_trunc('month', date_actual) as date) as added_month, added_date_key, playlist_key, user_key, track_key,
    count(*) as n_genres from fact_playlist_track group by all""",
)
def month_compaction(c):
    """Facts written by four runs, three of them compacted, the replaced folders removed."""
    root, table = working_folder(c.spark, "warehouse"), "fact_playlist_track"
    part = F.pmod(F.crc32("track_key"), F.lit(4))
    facts = stored(c, c.fact_playlist_masks, table)
    for number in range(4):
        warehouse.write_facts(facts.where(part == number), root, table, 20240101 + number)
    warehouse.compact(c.spark, root, table, 20240101, 20240131)
    warehouse.remove_replaced(c.spark, root, table, keep_runs=1)
    rows = warehouse.read_facts(c.spark, root, table)
    keys = [F.col("added_month").cast("date").alias("added_month"), *PLAYLIST_FACT[:3], "track_key"]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_genres"))
