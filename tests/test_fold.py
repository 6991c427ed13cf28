"""Folded rows against plain ones."""

import random

import __spark_entry__ as entry
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tonearm.operators import dedup, fold, lookup, merge
from tonearm.plans import dims, facts, marts
from tonearm.queries import storage
from tonearm.queries.fixtures import Catalogue
from tonearm.sources import warehouse

DDL = "day int, k string, g bigint, extra string"


def some_rows(spark, seed, n=400):
    """Keys below 0, above 64 and NULL, and NULLs in the other columns."""
    pick = random.Random(seed)
    keys = [None, -130, -64, -1, 0, 1, 62, 63, 64, 65, 2**40]
    found = {
        (pick.randrange(3), pick.choice(["a", "b", None]), pick.choice(keys), pick.choice(["x", None])) for _ in range(n)
    }
    return spark.createDataFrame(sorted(found, key=repr), DDL)


def test_unfolded_rows_are_those_folded(spark, rows):
    df = some_rows(spark, 1)
    folded = fold.fold(df.unionByName(df), "g")
    assert folded.count() < df.count()
    back = fold.unfold(folded, "g", df.columns, fold.type_of(df, "g"))
    assert back.schema["g"].dataType == df.schema["g"].dataType
    assert rows(back) == rows(df)


@pytest.mark.parametrize("few", [0, 10**9])
def test_folded_insert_is_the_plain_one(spark, rows, monkeypatch, few):
    monkeypatch.setattr(merge, "FEW_ROWS", few)
    staging, target = some_rows(spark, 2), some_rows(spark, 3, 40)
    keys = ["day", "k", "g"]
    expected = rows(lookup.not_in(staging, target, keys))
    assert 0 < len(expected) < staging.count()
    assert rows(merge.insert_absent(target, staging, keys, "day", folded="g")) == expected


def test_folded_insert_shuffles_entries(spark):
    """One row per entry, not per genre, reaches the join."""
    entries = spark.range(50).select(F.lit(1).alias("day"), F.col("id").cast("string").alias("k"), F.lit("x").alias("extra"))
    facts = entries.withColumn("g", F.explode(F.expr("sequence(0L, 39L)")))
    folded = fold.fold(facts, "g")
    assert (facts.count(), folded.count()) == (2000, 50)
    assert fold.type_of(folded, "_mask") == "bigint"
    assert fold.not_in_folded(facts, facts.where("g >= 10"), ["day", "k", "g"], "g").count() == 500


def test_facts_are_laid_out_folded(spark, rows, tmp_path):
    """What is shuffled to lay facts out by month is entries; what is stored is facts."""
    entries = spark.range(60).select(
        F.lit(20240101).alias("added_date_key"),
        F.col("id").cast("string").alias("playlist_key"),
        F.lit("u").alias("user_key"),
        F.lit("t").alias("track_key"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date_actual"),
    )
    facts = entries.withColumn("genre_key", F.explode(F.expr("sequence(-1L, 38L)"))).select(
        "added_date_key", "playlist_key", "user_key", "genre_key", "track_key", "date_actual"
    )
    shuffled = []

    def noted(df, *args, plain=fold.fold):
        folded = plain(df, *args)
        shuffled.append(folded.count())
        return folded

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(warehouse.folding, "fold", noted)
        warehouse.write_facts(facts, str(tmp_path), "fact_playlist_track", 20240102)
    assert shuffled == [120]  # -1 and 0..38 have a word each
    stored = warehouse.read_facts(spark, str(tmp_path), "fact_playlist_track")
    assert rows(stored, *facts.columns) == rows(facts)


def test_folded_first_rows_are_the_plain_ones(spark, rows):
    df = some_rows(spark, 4)
    keys = ["k", "g", "day"]
    assert rows(dedup.first_rows(df, keys, folded="g"), *keys) == rows(dedup.first_rows(df, keys))


def test_preference_looks_tracks_up_folded(spark, monkeypatch):
    """One row per user and track reaches the join with the tracks, whatever the number of genres."""
    facts = spark.range(5).select(F.lit("u").alias("user_key"), F.col("id").cast("string").alias("track_key"))
    facts = facts.withColumn("genre_key", F.explode(F.expr("sequence(1L, 20L)")))
    users = spark.createDataFrame([("u", "ann")], "user_key string, name string")
    genres = spark.range(1, 21).select(F.col("id").alias("genre_key"), F.concat(F.lit("g"), "id").alias("name"))
    tracks = facts.select("track_key", F.lit(3).alias("plays_count")).distinct()
    seen = []
    monkeypatch.setattr(marts, "unfold", lambda df, *args: seen.append(df.count()) or fold.unfold(df, *args))
    result = marts.user_genre_preference(facts, users, genres, tracks)
    assert {tuple(r)[2:] for r in result.collect()} == {(5, 15)} and result.count() == 20
    assert seen == [5]


def test_counts_reduce_facts_before_tracks_are_looked_up(spark, capsys):
    entry.queries()["c11_fact_date_track"](spark, SMALL).explain()
    assert "partial_sum(entries" in capsys.readouterr().out
    entry.queries()["d04_sum_first_row"](spark, SMALL).explain()
    plan = capsys.readouterr().out.splitlines()  # from the last operator to the first
    found = [i for i, line in enumerate(plan) if "Join" in line]
    keys = [line.split("keys=[")[1].split("]")[0] for line in plan[found[0] : found[1]] if "HashAggregate" in line]
    assert any("user_key" in k and "track_key" in k for k in keys)


@pytest.mark.parametrize("key", ["g08_fact_load", "a16_month_compaction"])
def test_facts_are_built_once(spark, monkeypatch, key):
    built = []
    monkeypatch.setattr(storage, "stored", lambda c, df, name, plain=storage.stored: built.append(name) or plain(c, df, name))
    entry.queries()[key](spark, SMALL)
    assert built.count("fact_playlist_track") == 1


@pytest.mark.parametrize("few", [0, 10**9])
def test_rows_staged_folded_are_inserted_as_plain_ones(spark, rows, monkeypatch, few):
    monkeypatch.setattr(merge, "FEW_ROWS", few)
    staging, target = some_rows(spark, 4), some_rows(spark, 5, 40)
    keys = ["day", "k", "g"]
    left = merge.insert_absent(target, fold.fold(staging, "g"), keys, "day", folded="g")
    assert (fold.MASK in left.columns) == (few == 0)
    if few == 0:
        left = fold.unfold(left, "g", staging.columns)
    assert rows(left, *staging.columns) == rows(lookup.not_in(staging, target, keys))


def test_folded_facts_are_written_as_facts(spark, rows, tmp_path):
    facts = spark.createDataFrame(
        [(20240101, "p", "u", g, "t", None) for g in (-1, 3, 70)] + [(20240102, "p", "u", 5, "t", None)],
        "added_date_key int, playlist_key string, user_key string, genre_key bigint, track_key string, date_actual date",
    )
    warehouse.write_facts(fold.fold(facts, "genre_key"), str(tmp_path), "fact_playlist_track", 20240102)
    stored = warehouse.read_facts(spark, str(tmp_path), "fact_playlist_track")
    assert rows(stored, *facts.columns) == rows(facts)


def test_daily_run_stages_entries_not_facts(spark):
    """A staged row for each entry and 64 genres, also for the albums' tracks."""
    catalogue = Catalogue(spark, SMALL)
    places = storage.warehouse_after(catalogue, storage.DAYS[:1])
    for table in ("fact_playlist_track", "fact_album_track"):
        staged = warehouse.read_table(spark, places.staging_of(20240101), table)
        assert fold.MASK in staged.columns
        assert staged.count() < warehouse.read_facts(spark, places.warehouse, table).count()


@pytest.mark.parametrize(
    "key",
    ["c10_star_join", "e03_first_row_date_track_playlist", "e04_first_row_date_track_user", "h14_favorite_track", "b19_sentinel_filter"],
)
def test_entries_are_reduced_without_a_row_for_each_genre(spark, monkeypatch, key):
    monkeypatch.setattr(Catalogue, "fact_playlist_track", property(lambda self: pytest.fail("built unfolded")))
    assert entry.queries()[key](spark, SMALL).count() > 0


@pytest.mark.parametrize("value", [-1, 0, 63, 64])
def test_a_value_is_taken_out_of_folded_rows(spark, rows, value):
    df = some_rows(spark, 6)
    left = fold.unfold(fold.without(fold.fold(df, "g"), value), "g", df.columns)
    assert rows(left) == rows(df.where(F.col("g") != value))


def test_dimensions_staged_twice_are_built_once(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(Catalogue, "dim_album", property(lambda self: asked.append(1) or dims.stage_album(self.src_album)))
    assert entry.queries()["g07_dimension_load"](spark, SMALL).count() == 6
    assert len(asked) == 1


@pytest.mark.parametrize("sides", [(True, False), (False, True), (True, True)])
def test_anti_join_takes_folded_sides(spark, rows, sides):
    """Known rows hold a column more than the keys, so they are not distinct in these."""
    staging, target = some_rows(spark, 7), some_rows(spark, 8, 60)
    keys = ["day", "k", "g"]
    expected = rows(lookup.not_in(staging, target, keys))
    given = [fold.fold(df, "g") if folded else df for df, folded in zip((staging, target), sides)]
    assert rows(fold.not_in_folded(*given, keys, "g"), *staging.columns) == expected


@pytest.mark.parametrize("key", ["c05_fact_anti_join", "g06_insert_absent", "g08_fact_load", "a16_month_compaction"])
def test_facts_are_stored_folded_to_be_compared(spark, monkeypatch, key):
    monkeypatch.setattr(Catalogue, "fact_playlist_track", property(lambda self: pytest.fail("built unfolded")))
    assert entry.queries()[key](spark, SMALL).count() > 0


@pytest.mark.parametrize("few", [0, 10**9])
def test_insert_compares_with_a_folded_target(spark, rows, monkeypatch, few):
    monkeypatch.setattr(merge, "FEW_ROWS", few)
    staging, target = some_rows(spark, 9), some_rows(spark, 10, 60)
    keys = ["day", "k", "g"]
    left = merge.insert_absent(fold.fold(target, "g"), fold.fold(staging, "g"), keys, "day", folded="g")
    expected = rows(lookup.not_in(staging, target, keys))
    assert rows(fold.unfolded(left, "g"), *staging.columns) == expected


@pytest.mark.parametrize("value", [-65, -1, 0, 1, 62, 63, 64, 2**40])
def test_low_values_are_taken_out_of_folded_rows(spark, rows, value):
    df = some_rows(spark, 11)
    left = fold.unfold(fold.at_least(fold.fold(df, "g"), value), "g", df.columns)
    assert rows(left) == rows(df.where(F.col("g") >= value))


def test_genres_are_named_once_a_set(spark, rows, monkeypatch):
    """Entries with a common set of genres share its names, which are looked up by the masks of the whole set."""
    keys = ["day", "k"]
    given = [(1, str(i), g) for i in range(30) for g in (-1, 3, 70)] + [(2, None, 3), (2, "x", None), (2, "y", 9)]
    genres = spark.createDataFrame([(-1, "unknown"), (3, "rock"), (70, "jazz")], "genre_key bigint, genre string")
    seen = []
    monkeypatch.setattr(storage, "unfold", lambda df, *args: seen.append(df.count()) or fold.unfold(df, *args))
    masks = fold.fold(spark.createDataFrame(given, "day int, k string, g bigint"), "g")
    named = storage.genres_of(masks, keys, genres)
    expected = [(1, str(i), "jazz,rock,unknown") for i in range(30)] + [(2, None, "rock")]
    assert rows(named) == sorted(expected, key=repr)
    assert seen == [3 + 1 + 1 + 1]


def test_placed_tracks_are_looked_for_once(spark, rows, monkeypatch):
    seen = []
    monkeypatch.setattr(facts, "not_in", lambda df, known, *args: seen.append(known.count()) or lookup.not_in(df, known, *args))
    entries = spark.createDataFrame([("a", "p"), ("a", "p"), ("b", "q"), (None, "r")], "track_id string, playlist_id string")
    placed = spark.createDataFrame([("a", i) for i in range(20)] + [(None, 0)], "track_key string, genre_key int")
    assert rows(facts.unplaced_tracks(entries, placed)) == [("b", "q"), (None, "r")]
    assert seen == [2]
