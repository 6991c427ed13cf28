"""Lake, warehouse tables and daily runs."""

import datetime as dt
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tonearm.plans import ingest
from tonearm.plans import warehouse as daily
from tonearm.plans.specs import DIMENSIONS, FACTS
from tonearm.queries.fixtures import Catalogue
from tonearm.queries.storage import DAYS, changed_until, warehouse_after
from tonearm.schemas import SOURCE_TABLES
from tonearm.session import working_folder
from tonearm.sources import database, lake, warehouse

USER = SOURCE_TABLES["user"]


def users(spark, *rows):
    """(user_id, day of change) rows of the user table."""
    data = [(i, None, None if d is None else dt.datetime(2024, 1, d, 12), "u", None, i) for i, d in rows]
    return spark.createDataFrame(data, USER.schema)


def day(number):
    return dt.date(2024, 1, number)


def test_second_ingest_takes_only_new_rows(spark, tmp_path):
    root = str(tmp_path)
    assert ingest.ingest_table(spark, users(spark, ("a", 1), ("b", 1)), root, USER, day(1)) == 2
    later = users(spark, ("a", 1), ("b", 2), ("c", 2))
    assert ingest.ingest_table(spark, later, root, USER, day(2)) == 2
    assert ingest.ingest_table(spark, later, root, USER, day(3)) == 0
    assert lake.read_lake(spark, root, USER).count() == 4
    assert lake.read_lake(spark, root, USER, day(2)).count() == 2


def test_rows_changed_later_on_the_last_day_are_not_lost(spark, tmp_path):
    root = str(tmp_path)
    ingest.ingest_table(spark, users(spark, ("a", 1)), root, USER, day(1))
    late = users(spark, ("a", 1), ("b", 1))
    held = lake.read_lake(spark, root, USER)
    assert lake.incremental_rows(late, held, "updated_at", ["user_id"], strict=True).count() == 0
    assert ingest.ingest_table(spark, late, root, USER, day(2)) == 1


def test_repeated_ingest_of_a_day_replaces_it(spark, tmp_path, rows):
    root = str(tmp_path)
    ingest.ingest_table(spark, users(spark, ("a", 1)), root, USER, day(1))
    ingest.ingest_table(spark, users(spark, ("a", 1), ("b", 2)), root, USER, day(2))
    ingest.ingest_table(spark, users(spark, ("a", 1), ("b", 2), ("c", 2)), root, USER, day(2))
    assert rows(lake.read_lake(spark, root, USER), "user_id", "extract_day") == [("a", 1), ("b", 2), ("c", 2)]


def test_no_old_extract_is_read_for_the_watermark(spark, tmp_path, capsys):
    """Only the extract that reaches the latest day is compared with; its note tells which one that is."""
    root = str(tmp_path)
    for number, found in ((1, [("a", 1), ("b", 2)]), (2, [("a", 1), ("b", 2), ("c", 5)]), (3, [("b", 2), ("c", 5)])):
        ingest.ingest_table(spark, users(spark, *found), root, USER, day(number))
    noted = lake.noted_extracts(spark, root, USER, day(4))
    assert [(e.day, e.latest, e.n) for e in noted] == [(day(1), day(2), 2), (day(2), day(5), 1), (day(3), None, 0)]
    held, latest = lake.held_rows(spark, root, USER, day(4))
    assert latest == day(5)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    held.explain()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = capsys.readouterr().out.partition("PartitionFilters: [")[2].partition("]")[0]
    assert re.findall(r"extract_day#\d+ = (\d+)", filters) == ["2"]
    assert [r.user_id for r in held.collect()] == ["c"]
    # a row of the latest day that came later, and one of a day after it
    more = users(spark, ("a", 1), ("c", 5), ("d", 5), ("e", 6))
    assert ingest.ingest_table(spark, more, root, USER, day(4)) == 2
    assert ingest.ingest_table(spark, more, root, USER, day(4)) == 2  # repeated


def test_empty_and_dateless_lakes_mean_a_full_load(spark):
    source = users(spark, ("a", 1), ("b", None))
    assert lake.incremental_rows(source, None, "updated_at").count() == 2
    assert lake.incremental_rows(source, source.where("false"), "updated_at").count() == 2
    assert lake.incremental_rows(source, users(spark, ("x", None)), "updated_at").count() == 2


def test_tables_and_days_are_matched_exactly(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame(
        [("a", "b", dt.datetime(2024, 1, 10), None)], SOURCE_TABLES["artist_album"].schema
    )
    lake.write_extract(lake.stamp_extract_date(rows, day(10)), root, "artist_album")
    assert lake.read_lake(spark, root, SOURCE_TABLES["artist"]) is None
    assert lake.read_lake(spark, root, SOURCE_TABLES["artist_album"], day(1)).count() == 0
    assert lake.read_lake(spark, root, SOURCE_TABLES["artist_album"], day(10)).count() == 1


def test_one_day_read_lists_one_partition(spark, tmp_path, capsys):
    root = str(tmp_path)
    for number in (1, 2):
        lake.write_extract(lake.stamp_extract_date(users(spark, ("a", number)), day(number)), root, "user")
    lake.read_lake(spark, root, USER, day(2)).explain()
    assert "PartitionFilters: [isnotnull(extract_year" in capsys.readouterr().out


def test_watermark_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "source")
    users(spark, ("a", 1), ("b", 2), ("c", 3)).write.parquet(path)
    source = spark.read.schema(USER.schema).parquet(path)
    lake.incremental_rows(source, users(spark, ("a", 1)), "updated_at", strict=True).explain()
    assert "GreaterThanOrEqual(updated_at,2024-01-02" in capsys.readouterr().out


def test_rows_after_the_last_day_are_not_compared(spark, tmp_path, capsys, rows):
    """Of the source, only rows of the last day meet what the lake holds; none is lost or taken twice at midnight."""
    midnight = [(i, None, at, "u", None, i) for i, at in (("e", dt.datetime(2024, 1, 3)), ("f", dt.datetime(2024, 1, 2)))]
    given = users(spark, ("a", 1), ("b", 2), ("c", 3), ("d", None), ("g", 2)).union(spark.createDataFrame(midnight, USER.schema))
    given.write.parquet(f"{tmp_path}/given")
    source = spark.read.parquet(f"{tmp_path}/given")
    found = lake.incremental_rows(source, users(spark, ("b", 2)), "updated_at", ["user_id"])
    assert rows(found, "user_id") == [("c",), ("e",), ("f",), ("g",)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    found.explain()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    compared = capsys.readouterr().out.partition("LeftAnti")[2].partition("PushedFilters: [")[2].partition("]")[0]
    assert "LessThan(updated_at,2024-01-03" in compared


def test_database_conditions_cover_every_row_once():
    conditions = database.day_predicates("updated_at", day(1), day(10), 3)
    assert conditions == [
        "(updated_at < DATE '2024-01-04' OR updated_at IS NULL)",
        "updated_at >= DATE '2024-01-04' AND updated_at < DATE '2024-01-07'",
        "updated_at >= DATE '2024-01-07'",
    ]
    assert len(database.day_predicates("updated_at", day(1), day(2), 64)) == 2
    assert database.day_predicates("c", day(1), day(1), 8) == ["1 = 1"]


def test_run_that_never_committed_is_not_read(spark, tmp_path):
    root, df = str(tmp_path), spark.range(3).withColumn("date_actual", F.lit(day(1)))
    warehouse.write_facts(df, root, "fact_playlist_track", 20240101)
    df.withColumn("added_month", F.lit(day(1))).write.partitionBy("added_month").parquet(
        f"{root}/fact_playlist_track/rows/run=20240102"
    )
    warehouse.write_facts(df, root, "fact_playlist_track", 20240103)
    assert warehouse.read_facts(spark, root, "fact_playlist_track").count() == 6
    assert warehouse.read_facts(spark, root, "fact_playlist_track", before=20240103).count() == 3
    assert warehouse.read_snapshot(spark, root, "nothing") is None


@pytest.mark.parametrize(
    "table, low, high, found",
    [
        ("fact_playlist_track", 20240115, 20240120, {"2024-01-01"}),
        ("fact_playlist_track", 0, 0, {"None"}),
        ("fact_playlist_track", 0, 20240131, {"None", "2023-12-01", "2024-01-01"}),
        ("fact_album_track", 20200000, 20240131, {"20200000"}),
        ("fact_album_track", 0, 20200000, {"0", "20200000"}),
    ],
)
def test_layout_conditions_keep_all_reachable_folders(spark, table, low, high, found):
    layout = warehouse.FACT_LAYOUT[table]
    keys = [(0, None), (20231231, day(1) - dt.timedelta(days=1)), (20240116, day(16)), (20240201, dt.date(2024, 2, 1))]
    if table == "fact_album_track":
        keys = [(0, None), (20240116, None), (20310000, None)]
    df = spark.createDataFrame(keys, "release_date_key int, date_actual date")
    kept = df.withColumn(layout.column, layout.value()).where(layout.reachable(low, high))
    assert {str(r[0]) for r in kept.select(layout.column).collect()} == found


@pytest.fixture(scope="module")
def two_runs(spark):
    c = Catalogue(spark, SMALL)
    return c, warehouse_after(c, [DAYS[0], DAYS[2]])


def test_dimension_invariants(spark, two_runs):
    _, places = two_runs
    for spec in DIMENSIONS.values():
        table = daily.read_dimension(spark, places.warehouse, spec.name, open_only=False)
        in_force = table.where("flag") if spec.scd_type == 2 else table
        assert in_force.count() == in_force.select(spec.key).distinct().count()
        if spec.scd_type == 2:
            assert table.where("flag <> (valid_to is null)").count() == 0


def test_fact_keys_resolve(spark, two_runs):
    _, places = two_runs
    for name, spec in FACTS.items():
        facts = warehouse.read_facts(spark, places.warehouse, name)
        assert facts.count() == facts.select(*spec.keys).distinct().count() > 0
        genres = daily.read_dimension(spark, places.warehouse, "dim_genre")
        assert facts.join(genres, "genre_key", "left_anti").count() == 0
        dates = daily.date_dimension(spark, places).select(F.col("date_key").alias(spec.partition_key))
        assert facts.join(dates, spec.partition_key, "left_anti").count() == 0


def test_no_playlist_entry_is_lost(spark, two_runs):
    """Entries that came before their track's artists have facts once these are known; others stay pending."""
    _, places = two_runs
    read = lambda name: lake.read_lake(spark, places.lake, SOURCE_TABLES[name])
    artists = daily.read_dimension(spark, places.warehouse, "dim_artist").select(F.col("artist_key").alias("artist_id"))
    known = read("artist_track").join(artists, "artist_id", "left_semi").select("track_id")
    due = read("playlist_track").join(known, "track_id", "left_semi").select(F.col("track_id").alias("track_key"))
    facts = warehouse.read_facts(spark, places.warehouse, "fact_playlist_track")
    assert due.join(facts, "track_key", "left_anti").count() == 0


ALL = list(SOURCE_TABLES)


def facts_of(spark, places, rows):
    """Rows of both fact tables; of the entries only those with a playlist, as a late one adds a row."""
    found = {}
    for name, spec in FACTS.items():
        table = warehouse.read_facts(spark, places.warehouse, name)
        known = table.where("playlist_key <> 'unknown'") if "playlist_key" in spec.keys and table is not None else table
        keys = [k for k in spec.keys if k != "genre_key"]
        genres = daily.read_dimension(spark, places.warehouse, "dim_genre").withColumnRenamed("name", "genre")
        found[name] = [] if known is None else rows(known.join(genres, "genre_key").select(*keys, "genre"))
    return found


def run_days(spark, c, plan):
    """Runs; ``plan`` gives for each day the tables it ingests, as they were at the end of the last day."""
    places = daily.Places(*[working_folder(spark, p) for p in ("lake", "staging", "warehouse")])
    done = {}
    for run_day, tables in plan:
        source = lambda t: changed_until(c, t.name, DAYS[2]) if t.name in tables else None  # noqa: B023, E731
        ingest.ingest_all(spark, source, places.lake, run_day)
        done = daily.run_day(spark, places, run_day)
    return places, done


@pytest.fixture(scope="module")
def at_once(spark):
    """Both fact tables when every table comes on one day."""
    c = Catalogue(spark, SMALL)
    places, _ = run_days(spark, c, [(DAYS[0], ALL)])
    take = lambda df, *columns: sorted((tuple(r) for r in df.collect()), key=repr)
    found = facts_of(spark, places, take)
    assert all(found.values())
    return c, found


@pytest.mark.parametrize("late", ["album", "artist", "artist_album", "playlist"])
def test_a_late_table_loses_no_fact(spark, at_once, rows, late):
    """Any table may come after all others: the facts are as if it had come with them."""
    c, expected = at_once
    places, done = run_days(spark, c, [(DAYS[0], [t for t in ALL if t != late]), (DAYS[2], [late])])
    assert facts_of(spark, places, rows) == expected


def test_tables_one_by_one(spark, at_once, rows):
    c, expected = at_once
    order = ["playlist_track", "track", "artist_track", "artist_album", "artist", "user", "playlist", "album"]
    assert sorted(order) == sorted(ALL)
    places, _ = run_days(spark, c, [(day(1 + k), [name]) for k, name in enumerate(order)])
    assert facts_of(spark, places, rows) == expected


def test_artists_that_come_later_give_facts(spark, at_once, rows):
    """Half of the artists on the first day, the rest on the second: albums and entries of both kinds are completed."""
    c, expected = at_once
    places = daily.Places(*[working_folder(spark, p) for p in ("lake", "staging", "warehouse")])
    for number, condition in enumerate(("pmod(crc32(artist_id), 2) = 0", "true")):
        def source(t):
            found = changed_until(c, t.name, DAYS[2])
            if t.name == "artist":
                late = F.pmod(F.crc32("artist_id"), F.lit(2)) == 1
                moved = F.when(late, F.lit(dt.datetime(2024, 1, 4, 12))).otherwise(F.col("updated_at"))
                return found.withColumn("updated_at", moved).where(condition)  # noqa: B023
            return found

        ingest.ingest_all(spark, source, places.lake, day(3 + number))
        daily.run_day(spark, places, day(3 + number))
    assert facts_of(spark, places, rows) == expected


def test_a_run_reads_no_history(spark, two_runs, capsys):
    """The lake is read by day only; what the day touches comes from buckets of the indexes."""
    _, places = two_runs
    changed = daily.changed_artists(spark, places, DAYS[2])
    for candidates in (daily.candidate_tracks, daily.candidate_entries):
        capsys.readouterr()
        candidates(spark, places, DAYS[2], changed).explain("formatted")
        plan = capsys.readouterr().out
        scans = [part for part in plan.split("\n\n") if "Scan parquet" in part and "Location" in part]
        lake_scans = [s for s in scans if places.lake in s]
        assert lake_scans and all("extract_day" in s.partition("PartitionFilters")[2] for s in lake_scans)
        assert any("/tracks_by_" in s or "/entries_by_" in s or "/albums_by_" in s for s in scans)


def test_unchanged_artists_touch_nothing(spark, two_runs):
    """Followers may change: only new artists and other genres count."""
    _, places = two_runs
    held = daily.read_dimension(spark, places.warehouse, "dim_artist", before=20240103)
    found = daily.changed_artists(spark, places, DAYS[2])
    of_day = lake.read_lake(spark, places.lake, SOURCE_TABLES["artist"], DAYS[2])
    same = of_day.join(held.select(F.col("artist_key").alias("artist_id"), F.col("genres").alias("before")), "artist_id")
    same = same.where(F.col("genres").eqNullSafe(F.col("before")))
    assert found.join(same, "artist_id", "left_semi").count() == 0
    assert found.count() + same.select("artist_id").distinct().count() >= of_day.select("artist_id").distinct().count()


# ---- compaction -------------------------------------------------------------------------------


def fact_rows(spark, run, months=("2024-01-05", "2023-11-09")):
    data = [(dt.date.fromisoformat(m), f"t{run}-{k}") for k, m in enumerate(months)] + [(None, f"t{run}-none")]
    return spark.createDataFrame(data, "date_actual date, track_key string")


def files_of(root, table):
    from pathlib import Path

    return [p for p in Path(root, table, "rows").rglob("*.parquet")]


def keys_read(spark, root, table="fact_playlist_track", before=None):
    return sorted(r.track_key for r in warehouse.read_facts(spark, root, table, before).select("track_key").collect())


def test_thirty_runs_become_few_files(spark, tmp_path):
    root, table = str(tmp_path), "fact_playlist_track"
    for number in range(1, 31):
        warehouse.write_facts(fact_rows(spark, number), root, table, 20240100 + number)
    before = keys_read(spark, root)
    plan_files = len(files_of(root, table))
    number = warehouse.compact(spark, root, table, 20240101, 20240131)
    assert keys_read(spark, root) == before and len(before) == 90
    assert warehouse.committed_runs(spark, root, table) == [number, 20240130]  # the last run may be repeated
    # a reader of an earlier state sees that state
    assert len(keys_read(spark, root, before=20240110)) == 27
    # one file a month and one without
    names = warehouse.read_facts(spark, root, table).withColumn("file", F.input_file_name())
    assert names.where("added_month = '2024-01-01'").select("file").distinct().count() == 2
    assert names.select("file").distinct().count() == 6 < plan_files
    # repeating the last run changes nothing
    warehouse.write_facts(fact_rows(spark, 30), root, table, 20240130)
    assert keys_read(spark, root) == before
    assert warehouse.compact(spark, root, table, 20240101, 20240131) is None  # nothing new
    assert warehouse.remove_replaced(spark, root, table) == []  # a reader that began before the last run may be at it
    warehouse.write_facts(fact_rows(spark, 31), root, table, 20240131)
    assert len(warehouse.remove_replaced(spark, root, table)) == 29
    assert keys_read(spark, root, before=20240131) == before
    assert keys_read(spark, root, before=20240130) == [k for k in before if not k.startswith("t30-")]
    assert len(files_of(root, table)) == 9


def test_compaction_that_stops_before_its_commit(spark, tmp_path, monkeypatch):
    root, table = str(tmp_path), "fact_playlist_track"
    for number in range(1, 5):
        warehouse.write_facts(fact_rows(spark, number), root, table, 20240100 + number)
    before = keys_read(spark, root)
    commit = warehouse._commit
    with monkeypatch.context() as broken:
        def stop(*args, **named):
            raise RuntimeError("lost")

        broken.setattr(warehouse, "_commit", stop)
        with pytest.raises(RuntimeError):
            warehouse.compact(spark, root, table, 20240101, 20240131)
    assert keys_read(spark, root) == before  # the folder is there, but stands for nothing
    assert warehouse.committed_runs(spark, root, table) == [20240101, 20240102, 20240103, 20240104]
    assert warehouse.remove_replaced(spark, root, table) == []
    assert warehouse._commit is commit and warehouse.compact(spark, root, table, 20240101, 20240131) < 0
    assert keys_read(spark, root) == before


def test_compacted_folders_are_compacted_again(spark, tmp_path):
    root, table = str(tmp_path), "fact_playlist_track"
    for number in range(1, 8):
        warehouse.write_facts(fact_rows(spark, number), root, table, 20240100 + number)
    before = keys_read(spark, root)
    warehouse.compact(spark, root, table, 20240101, 20240103)
    warehouse.compact(spark, root, table, 20240104, 20240105)
    assert len(warehouse.committed_runs(spark, root, table)) == 4 and keys_read(spark, root) == before
    whole = warehouse.compact(spark, root, table, 20240101, 20240131)
    assert warehouse.committed_runs(spark, root, table) == [whole, 20240107] and keys_read(spark, root) == before
    assert len(warehouse.remove_replaced(spark, root, table, keep_runs=1)) == 8
    assert keys_read(spark, root) == before
    # a reader that began two runs ago keeps its folders
    for number in range(8, 11):
        warehouse.write_facts(fact_rows(spark, number), root, table, 20240100 + number)
    warehouse.compact(spark, root, table, 20240101, 20240131)
    assert warehouse.remove_replaced(spark, root, table, keep_runs=2) == []
    assert len(keys_read(spark, root, before=20240109)) == 24


def test_compaction_between_runs_changes_nothing(spark, rows, at_once):
    """Runs, a compaction and retention in the middle, and a repeated last run."""
    c, expected = at_once
    plan = [(day(1), ["track", "album"]), (day(2), ["artist_album", "artist_track"]), (day(3), ["artist", "user"])]
    places, _ = run_days(spark, c, plan)
    assert "tracks_by_album" in daily.compact_month(spark, places, day(1))
    for number, tables in ((4, ["playlist", "playlist_track"]), (5, []), (5, [])):
        source = lambda t: changed_until(c, t.name, DAYS[2]) if t.name in tables else None  # noqa: B023, E731
        ingest.ingest_all(spark, source, places.lake, day(number))
        daily.run_day(spark, places, day(number))
        daily.compact_month(spark, places, day(1))
    assert facts_of(spark, places, rows) == expected
    assert len(warehouse.committed_runs(spark, places.warehouse, "fact_album_track")) <= 2


def test_repeating_the_last_run_changes_nothing(spark, two_runs, rows):
    _, places = two_runs
    names = list(FACTS) + ["dim_track", "dim_artist", "dim_album"]

    def content():
        tables = {n: warehouse.read_facts(spark, places.warehouse, n) for n in FACTS}
        tables |= {n: daily.read_dimension(spark, places.warehouse, n, open_only=False) for n in names[len(FACTS):]}
        tables["metric"] = daily.read_metric(spark, places.warehouse)
        return {n: rows(t.select(*sorted(t.columns))) for n, t in tables.items()}

    before = content()
    daily.run_day(spark, places, DAYS[2])
    assert content() == before


def test_runs_without_facts(spark, tmp_path):
    root = str(tmp_path)
    facts = spark.createDataFrame(
        [(dt.date(2024, 1, 2), "a")], "date_actual date, track_key string"
    )
    warehouse.write_facts(facts.limit(0), root, "fact_playlist_track", 20240101)
    assert warehouse.read_facts(spark, root, "fact_playlist_track").count() == 0
    warehouse.write_facts(facts, root, "fact_playlist_track", 20240102)
    assert warehouse.read_facts(spark, root, "fact_playlist_track").count() == 1
    assert warehouse.read_facts(spark, root, "fact_playlist_track", before=20240102).count() == 0


def test_day_without_extracts_loads_no_dimension(spark, two_runs):
    _, places = two_runs
    done = daily.run_day(spark, places, dt.date(2024, 2, 1))
    assert done["loaded dimensions"] == []
    assert "fact_playlist_track" not in done["loaded facts"]
