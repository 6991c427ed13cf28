"""Catalogue tables derived from the given tables.

The texts run in Spark and, without the braces, in DuckDB. They produce partial, blank and NULL
dates, unknown codes, blank labels, NULL names and counts, and genres differing in letter case.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS = {
    "src_album": """
select cast(o_orderkey as string) as album_id, 'album ' || cast(o_orderkey as string) as name,
 case o_orderstatus when 'P' then 'album' when 'F' then 'single' else case when o_orderkey % 3 = 0 then 'ep' else 'compilation' end end as album_type,
 'u/al/' || cast(o_orderkey as string) as url,
 case o_orderkey % 5 when 0 then cast(cast(o_orderdate as date) as string) when 1 then substr(cast(cast(o_orderdate as date) as string),1,7) when 2 then substr(cast(cast(o_orderdate as date) as string),1,4) when 3 then cast(cast(o_orderdate as date) as string) else case when o_orderkey % 10 = 4 then '' else null end end as release_date,
 case o_orderkey % 5 when 0 then 'day' when 1 then 'month' when 2 then 'year' when 3 then 'day' else null end as release_date_precision,
 case when o_orderkey % 7 = 0 then '' when o_orderkey % 7 = 1 then null else 'c/' || cast(o_orderkey as string) end as cover_image,
 case when o_orderkey % 6 = 0 then '' when o_orderkey % 6 = 1 then null else o_orderpriority end as label,
 cast(date '2024-01-01' + cast(o_orderkey % 3 as int) as timestamp) as updated_at from {orders}""",
    "src_artist": """
select cast(s_suppkey as string) as artist_id, case when s_suppkey % 9 = 0 then null else s_name end as name, 'u/ar/' || cast(s_suppkey as string) as url,
 case when s_suppkey % 10 = 0 then null else split(n_name || ',' || r_name || ',' || lower(r_name), ',') end as genres,
 case when s_acctbal < 0 then null else cast(floor(s_acctbal) as int) end as followers_count,
 case when s_suppkey % 4 = 0 then null else cast(s_suppkey * 100 as bigint) end as monthly_listeners,
 cast(date '2024-01-01' + cast(s_suppkey % 3 as int) as timestamp) as updated_at
 from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "src_artist_album": """
select distinct cast(l_suppkey as string) as artist_id, cast(l_orderkey as string) as album_id from {lineitem}""",
    "src_artist_track": """
select distinct cast(l_suppkey as string) as artist_id, cast(l_partkey as string) as track_id from {lineitem}""",
    "src_track": """
select cast(p_partkey as string) as track_id, cast(album as string) as album_id, case when p_partkey % 8 = 0 then '' else p_name end as name, 'u/tr/' || cast(p_partkey as string) as url,
 case when p_partkey % 5 = 0 then null else cast(p_partkey % 2 + 1 as int) end as disc_number, cast(p_size * 10000 as int) as duration_ms,
 case when p_partkey % 6 = 0 then null else p_partkey % 2 = 0 end as explicit, case when p_partkey % 9 = 0 then null else cast(floor(p_retailprice) as bigint) end as plays_count,
 cast(date '2024-01-01' + cast(p_partkey % 3 as int) as timestamp) as created_at
 from {part} join (select l_partkey, min(l_orderkey) as album from {lineitem} group by l_partkey) x on p_partkey = l_partkey""",
    "src_playlist": """
select cast(c_custkey as string) as playlist_id, c_name as name, 'u/pl/' || cast(c_custkey as string) as url, c_custkey % 2 = 0 as collaborative, cast(c_nationkey as string) as user_id, c_custkey % 3 = 0 as public,
 c_mktsegment as snapshot_id, case when c_acctbal < 0 then null else cast(floor(c_acctbal) as int) end as followers_count from {customer}""",
    "src_user": """
select cast(n_nationkey as string) as user_id, case when n_nationkey % 8 = 0 then '' else n_name end as name, 'u/us/' || cast(n_nationkey as string) as url from {nation}""",
    "src_playlist_track": """
select cast(o_custkey as string) as playlist_id, cast(l_partkey as string) as track_id, cast(min(cast(o_orderdate as date)) as string) || 'T00:00:00Z' as added_at
 from {orders} join {lineitem} on o_orderkey = l_orderkey group by o_custkey, l_partkey""",
    "src_metric_event": """
select cast(user_id as string) as artist_id, cast(cast(ts as date) as timestamp) as updated_at, cast(floor(value) as bigint) as followers_count, event_id as kafka_offset from {events}""",
    # two days of track rows: unchanged, changed, NULL turning into a value and back, new on the
    # second day, missing on it, and closed history
    "track_day1": """
select track_id as track_key, name, plays_count, date '2024-01-01' as valid_from, cast(null as date) as valid_to, true as flag
 from {src_track} where created_at < timestamp '2024-01-03 00:00:00'
union all
select track_id, 'old ' || name, plays_count, date '2023-01-01', date '2023-06-01', false
 from {src_track} where created_at < timestamp '2024-01-03 00:00:00' and explicit""",
    "track_day2": """
select track_id as track_key,
 case when duration_ms between 100000 and 250000 then name || 'v2' else name end as name,
 case when duration_ms between 100000 and 250000 then plays_count + 1
      when duration_ms > 400000 then case when plays_count is null then 1 else null end
      else plays_count end as plays_count
 from {src_track} where explicit is not null or created_at = timestamp '2024-01-03 00:00:00'""",
}


class Catalogue:
    """The given tables of one folder and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        """A view or table; asked for once, then kept."""
        if name in VIEWS:
            sources = [t for t in (*BASE_TABLES, *VIEWS) if "{%s}" % t in VIEWS[name]]
            df = self.spark.sql(VIEWS[name], **{t: getattr(self, t) for t in sources})
        elif name in BASE_TABLES:
            df = self.table(name)
        else:
            raise AttributeError(name)
        setattr(self, name, df)
        return df

    # ---- staged warehouse tables over the whole views -------------------------------------

    def versioned(self, df: DataFrame) -> DataFrame:
        from pyspark.sql import functions as F

        return df.withColumns(
            {
                "valid_from": F.lit("2024-01-01").cast("date"),
                "valid_to": F.lit(None).cast("date"),
                "flag": F.lit(True),
            }
        )

    @cached_property
    def dim_album(self) -> DataFrame:
        from tonearm.plans.dims import stage_album

        return stage_album(self.src_album)

    @cached_property
    def dim_artist(self) -> DataFrame:
        from tonearm.plans.dims import stage_artist

        return self.versioned(stage_artist(self.src_artist))

    @cached_property
    def dim_genre(self) -> DataFrame:
        from tonearm.plans.dims import stage_genre, with_unknown_genre

        return with_unknown_genre(stage_genre(self.src_artist))

    @cached_property
    def dim_user(self) -> DataFrame:
        from tonearm.plans.dims import stage_user

        return stage_user(self.src_user)

    @cached_property
    def dim_playlist(self) -> DataFrame:
        from tonearm.plans.dims import stage_playlist

        return self.versioned(stage_playlist(self.src_playlist))

    @cached_property
    def dim_track(self) -> DataFrame:
        from tonearm.plans.dims import stage_track

        return self.versioned(stage_track(self.src_track))

    @cached_property
    def dim_date(self) -> DataFrame:
        from tonearm.plans.dims import date_dimension

        return date_dimension(self.spark)

    @cached_property
    def fact_playlist_track(self) -> DataFrame:
        from tonearm.plans.facts import playlist_track

        return playlist_track(
            self.src_playlist_track, self.src_artist_track, self.dim_playlist, self.dim_artist, self.dim_genre
        )

    @cached_property
    def fact_playlist_masks(self) -> DataFrame:
        """The same facts folded by genre, for queries that reduce them first."""
        from tonearm.plans.facts import playlist_track

        return playlist_track(
            self.src_playlist_track, self.src_artist_track, self.dim_playlist, self.dim_artist, self.dim_genre, folded=True
        )

    def fact_album_track(self, run_date=None, folded=False) -> DataFrame:
        from tonearm.plans.facts import album_track

        return album_track(
            self.src_track, self.src_artist_album, self.dim_album, self.dim_artist, self.dim_genre, run_date, folded
        )
