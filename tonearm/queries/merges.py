"""Slowly changing dimensions, inserts and upserts over two days of track rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tonearm.operators import merge
from tonearm.operators.fold import at_least, unfolded
from tonearm.queries.oracle import STORED_FACTS
from tonearm.queries.registry import query
from tonearm.session import working_folder
from tonearm.sources import warehouse

DAY1, DAY2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
CHANGED = "(t.name is distinct from s.name or t.plays_count is distinct from s.plays_count)"

# ---- type 1 ----------------------------------------------------------------------------------


def _type1_target(c):
    rows = c.track_day1.where("flag").select("track_key", "name", "plays_count")
    return rows.withColumns({"created_at": F.lit(DAY1), "updated_at": F.lit(DAY1)})


SCD1 = f"""select coalesce(t.track_key, s.track_key) as track_key,
    case when s.track_key is null then t.name else s.name end as name,
    case when s.track_key is null then t.plays_count else s.plays_count end as plays_count,
    case when t.track_key is null then timestamp '2024-01-02 00:00:00' else timestamp '2024-01-01 00:00:00' end as created_at,
    case when t.track_key is null or (s.track_key is not null and {CHANGED})
      then timestamp '2024-01-02 00:00:00' else timestamp '2024-01-01 00:00:00' end as updated_at
    from (select * from track_day1 where flag) t full join track_day2 s on t.track_key = s.track_key"""


@query("g01_scd1_merge", SCD1)
def scd1_merge(c):
    return merge.scd1(_type1_target(c), c.track_day2, ["track_key"], DAY2)


@query("g03_scd1_full", SCD1)
def scd1_full(c):
    return merge.scd1(_type1_target(c), c.track_day2, ["track_key"], DAY2, strategy="full")


@query(
    "g03_scd1_two_keys",
    """select coalesce(t.artist_id, s.artist_id) as artist_id, coalesce(t.album_id, s.album_id) as album_id,
    coalesce(s.n, t.n) as n,
    case when t.n is null then timestamp '2024-01-02 00:00:00' else timestamp '2024-01-01 00:00:00' end as created_at,
    case when t.n is null or (s.n is not null and s.n <> t.n) then timestamp '2024-01-02 00:00:00'
      else timestamp '2024-01-01 00:00:00' end as updated_at
    from (select l_suppkey as artist_id, l_orderkey as album_id, count(*) as n from lineitem where l_returnflag <> 'R' group by 1, 2) t
    full join (select l_suppkey as artist_id, l_orderkey as album_id, count(*) as n from lineitem where l_returnflag <> 'A' group by 1, 2) s
    on t.artist_id = s.artist_id and t.album_id = s.album_id""",
)
def scd1_two_keys(c):
    """Line counts per artist and album; the two sides differ in the return flags they hold."""

    def counts(without):
        rows = c.lineitem.where(F.col("l_returnflag") != without)
        keys = [F.col("l_suppkey").alias("artist_id"), F.col("l_orderkey").alias("album_id")]
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    target = counts("R").withColumns({"created_at": F.lit(DAY1), "updated_at": F.lit(DAY1)})
    return merge.scd1(target, counts("A"), ["artist_id", "album_id"], DAY2, strategy="full")


# ---- type 2 ----------------------------------------------------------------------------------

SCD2 = f"""select * from track_day1 where valid_to is not null union all
    select t.track_key, t.name, t.plays_count, t.valid_from,
      case when s.track_key is not null and {CHANGED} then date '2024-01-02' end as valid_to,
      not (s.track_key is not null and {CHANGED}) as flag
    from track_day1 t left join track_day2 s on t.track_key = s.track_key where t.valid_to is null union all
    select s.track_key, s.name, s.plays_count, date '2024-01-02', null, true
    from track_day2 s left join (select * from track_day1 where valid_to is null) t on t.track_key = s.track_key
    where t.track_key is null or {CHANGED}"""


@query("g02_scd2_merge", SCD2)
def scd2_merge(c):
    """Both sides are alike in size, so each is read and shuffled once."""
    return merge.scd2(c.track_day1, c.track_day2, ["track_key"], DAY2.date(), strategy="full")


@query("g02_scd2_second_run", SCD2)
def scd2_second_run(c):
    """Merging the same staging rows again changes nothing."""
    once = merge.scd2(c.track_day1, c.track_day2, ["track_key"], DAY2.date())
    return merge.scd2(once, c.track_day2, ["track_key"], DAY2.date())


@query("g04_scd2_full", SCD2)
def scd2_full(c):
    """The same rows from the form that leaves the target in place."""
    return merge.scd2(c.track_day1, c.track_day2, ["track_key"], DAY2.date(), strategy="delta")


@query(
    "g04_scd2_two_keys",
    """with t as (select l_suppkey as artist_id, l_orderkey as album_id, count(*) as n from lineitem where l_returnflag <> 'R' group by 1, 2),
    s as (select l_suppkey as artist_id, l_orderkey as album_id, count(*) as n from lineitem where l_returnflag <> 'A' group by 1, 2)
    select t.artist_id, t.album_id, t.n, date '2024-01-01' as valid_from,
      case when s.n <> t.n then date '2024-01-02' end as valid_to, coalesce(s.n = t.n, true) as flag
    from t left join s on t.artist_id = s.artist_id and t.album_id = s.album_id union all
    select s.artist_id, s.album_id, s.n, date '2024-01-02', null, true
    from s left join t on t.artist_id = s.artist_id and t.album_id = s.album_id where t.n is null or s.n <> t.n""",
)
def scd2_two_keys(c):
    def counts(without):
        rows = c.lineitem.where(F.col("l_returnflag") != without)
        keys = [F.col("l_suppkey").alias("artist_id"), F.col("l_orderkey").alias("album_id")]
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    target = c.versioned(counts("R"))
    return merge.scd2(target, counts("A"), ["artist_id", "album_id"], DAY2.date(), strategy="full")


# ---- checks and inserts ----------------------------------------------------------------------


@query("g05_schema_check", "select count(*) as staged, 'url' as missing from track_day2")
def schema_check(c):
    """The staging rows lack a column that the target has."""
    target = c.dim_track.select("track_key", "name", "plays_count", "url")
    try:
        merge.require_columns(target, c.track_day2, merge.AUDIT_COLUMNS)
        missing = ""
    except ValueError as error:
        missing = str(error).rsplit(": ", 1)[1]
    return c.track_day2.agg(F.count(F.lit(1)).alias("staged"), F.lit(missing).alias("missing"))


FACT_KEYS = ["added_date_key", "playlist_key", "user_key", "genre_key", "track_key"]


@query(
    "g06_insert_absent",
    """select s.* from stored_facts s where not exists (select 1 from stored_facts p
      where p.genre_key >= 10 and s.added_date_key = p.added_date_key and s.playlist_key = p.playlist_key
      and s.user_key = p.user_key and s.genre_key = p.genre_key and s.track_key = p.track_key)
    and s.date_actual >= date '1997-01-01'""",
    stored_facts=STORED_FACTS,
)
def insert_absent(c):
    """Staged facts since 1997 against facts of some genres, both stored folded by genre."""
    root = working_folder(c.spark, "staging")
    warehouse.write_staging(c.fact_playlist_masks, root, "facts")
    facts = warehouse.read_table(c.spark, root, "facts")
    staged = facts.where("date_actual >= '1997-01-01'")
    held = at_least(facts, 10)
    rows = merge.insert_absent(held, staged, FACT_KEYS, "added_date_key", folded="genre_key")
    return unfolded(rows, "genre_key").select(*FACT_KEYS, "date_actual")


UPSERT_TARGET = """select track_id, album_id, name, plays_count, duration_ms from src_track where disc_number is not null"""


@query(
    "g10_partial_upsert",
    f"""select coalesce(t.track_id, s.track_id) as track_id, coalesce(s.album_id, t.album_id) as album_id, t.name,
    case when s.track_id is null then t.plays_count else s.plays_count end as plays_count, t.duration_ms,
    case when t.track_id is null then timestamp '2024-01-02 00:00:00' else timestamp '2024-01-01 00:00:00' end as created_at,
    case when t.track_id is null or (s.track_id is not null and
        (s.plays_count is distinct from t.plays_count or s.album_id is distinct from t.album_id))
      then timestamp '2024-01-02 00:00:00' else timestamp '2024-01-01 00:00:00' end as updated_at
    from ({UPSERT_TARGET}) t full join
      (select track_id, album_id, nullif(plays_count, 950) as plays_count from src_track where explicit is not null) s
    on t.track_id = s.track_id""",
)
def partial_upsert(c):
    """Records that carry album and play count only, the count being NULL for some."""
    columns = ["track_id", "album_id", "name", "plays_count", "duration_ms"]
    target = c.src_track.where("disc_number is not null").select(*columns)
    target = target.withColumns({"created_at": F.lit(DAY1), "updated_at": F.lit(DAY1)})
    records = c.src_track.where("explicit is not null").select(
        "track_id", "album_id", F.nullif("plays_count", F.lit(950)).alias("plays_count")
    )
    return merge.upsert_partial(target, records, ["track_id"], DAY2)


@query(
    "g10_combine_partial",
    """with r as (select *, row_number() over (partition by l_partkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_suppkey desc) as rn_all
      from lineitem where l_returnflag <> 'R'),
    q as (select *, row_number() over (partition by l_partkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_suppkey desc) as rn_q
      from lineitem where l_returnflag <> 'A')
    select coalesce(r.l_partkey, q.l_partkey) as l_partkey, r.l_suppkey, q.l_orderkey,
      r.l_partkey is not null as has_supplier, q.l_partkey is not null as has_order
    from (select * from r where rn_all = 1) r full join (select * from q where rn_q = 1) q on r.l_partkey = q.l_partkey""",
)
def combine_partial(c):
    """Lines as records: returned ones carry the order only, accepted ones the supplier only."""
    carried = (
        F.when(F.col("l_returnflag") == "R", F.array(F.lit("l_orderkey")))
        .when(F.col("l_returnflag") == "A", F.array(F.lit("l_suppkey")))
        .otherwise(F.array(F.lit("l_orderkey"), F.lit("l_suppkey")))
    )
    records = c.lineitem.select(
        "l_partkey",
        "l_suppkey",
        "l_orderkey",
        "l_shipdate",
        F.col("l_orderkey").alias("seq"),
        "l_linenumber",
        F.col("l_suppkey").alias("last"),
        carried.alias("present"),
    )
    folded = merge.combine_partial(records, ["l_partkey"], ["l_shipdate", "seq", "l_linenumber", "last"], "present")
    return folded.select(
        "l_partkey",
        "l_suppkey",
        "l_orderkey",
        F.array_contains("present", "l_suppkey").alias("has_supplier"),
        F.array_contains("present", "l_orderkey").alias("has_order"),
    )
