"""Plans and skew: what must hold when tables are large."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tonearm.operators import dedup, numbering
from tonearm.operators.lookup import not_in
from tonearm.plans import facts
from tonearm.queries import all_queries
from tonearm.session import working_folder

# jobs that write tables first; their result only reads them
WRITING = ("a0", "a1", "d10", "g06", "g07", "g08", "g09", "g11", "h15", "i02", "i03", "i04", "i05", "i09_frontier_stream", "j")
PLANNED = [key for key in sorted(all_queries()) if not key.startswith(WRITING)]


@pytest.mark.parametrize("key", PLANNED)
def test_no_cross_join_and_no_python_in_plans(spark, capsys, key):
    all_queries()[key](spark, SMALL).explain()
    plan = capsys.readouterr().out
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan


def test_scan_reads_only_needed_columns(spark, capsys):
    entry.queries()["d09_replacing_latest"](spark, SMALL).explain()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in capsys.readouterr().out


@pytest.fixture
def settings(spark):
    """Change settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_many_staged_tracks_are_joined_with_the_facts_once(spark, capsys):
    entry.queries()["h12_album_track_metric_next"](spark, SMALL).explain()
    plan = capsys.readouterr().out
    assert "LeftAnti" in plan and "LeftSemi" not in plan


def test_a_null_key_is_never_known(spark, rows):
    given = spark.createDataFrame([("a", 1), ("b", None), (None, None), ("c", 3)], "k string, n int")
    for strategy in ("delta", "full"):
        assert rows(not_in(given, given.where("k <> 'c' or k is null"), ["k", "n"], strategy)) == [("b", None), ("c", 3), (None, None)]


def executed_plan(df, capsys):
    df.collect()
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_hot_playlist_is_split(spark, settings, capsys):
    """One playlist holds a third of all entries; its partition is cut when joined."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        adaptive__advisoryPartitionSizeInBytes="50KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        shuffle__partitions="16",
    )
    number = F.col("id")
    entries = spark.range(0, 300_000, numPartitions=8).select(
        F.when(number % 3 == 0, "hot").otherwise((number % 1000).cast("string")).alias("playlist_id"),
        (number % 5000).cast("string").alias("track_id"),
        F.concat(F.lit("2024-01-0"), (1 + number % 9).cast("string"), F.lit("T00:00:00Z")).alias("added_at"),
    )
    playlists = spark.range(1000).select(F.col("id").cast("string").alias("playlist_key"))
    playlists = playlists.unionByName(spark.range(1).select(F.lit("hot").alias("playlist_key")))
    playlists = playlists.withColumn("user_key", F.lit("u")).withColumn("flag", F.lit(True))
    bridge = spark.range(5000).select((F.col("id") % 50).cast("string").alias("artist_id"), F.col("id").cast("string").alias("track_id"))
    artists = spark.range(50).select(
        F.col("id").cast("string").alias("artist_key"), F.array(F.lit("pop"), F.lit("rock")).alias("genres"), F.lit(True).alias("flag")
    )
    genres = spark.createDataFrame([(-1, "unknown"), (1, "pop"), (2, "rock")], "genre_key bigint, name string")
    found = facts.playlist_track(entries, bridge, playlists, artists, genres)
    plan = executed_plan(found, capsys)
    assert "skew=true" in plan
    expected = entries.select("playlist_id", "track_id", F.substring("added_at", 1, 10)).distinct().count() * 2
    assert found.count() == expected


def test_hot_key_is_reduced_before_the_shuffle(spark, capsys):
    rows = spark.range(0, 90_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("at")
    )
    latest = dedup.latest_by_key(rows, ["k"], ["at"])
    plan = executed_plan(latest, capsys)
    assert plan.count("partial_max") >= 1 and "Window" not in plan
    assert latest.where("k = 'hot'").first()["at"] == 89_997


def test_facts_are_not_deduplicated_after_the_explosion(spark, capsys):
    """The rows of the fact come straight from the last join."""
    entry.queries()["h11_fact_playlist_track"](spark, SMALL).explain()
    lines = [line for line in capsys.readouterr().out.splitlines() if line.strip()]
    top = next(line for line in lines if "Join" in line or "HashAggregate" in line)
    assert "Join" in top


def test_numbers_are_those_of_the_order(spark):
    names = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
    names = names.unionByName(spark.createDataFrame([("",), ("a",), ("é",), ("日本",), ("日",)], "name string"))
    numbered = numbering.dense_numbers(names, "name", "n", after=10).collect()
    ordered = sorted((r["name"] for r in numbered), key=lambda s: s.encode())
    assert {r["name"]: r["n"] for r in numbered} == {name: i for i, name in enumerate(ordered, start=11)}


def test_chunks_hold_every_id_once(spark):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("i"))
    chunks = numbering.chunk_ids(ids.unionByName(ids), "i", 7, shards=8).collect()
    flat = [i for row in chunks for i in row["ids"]]
    assert sorted(flat) == sorted(str(n) for n in range(1000))
    assert max(len(row["ids"]) for row in chunks) == 7
    assert sum(len(row["ids"]) < 7 for row in chunks) <= 8


def test_working_folder_is_in_the_shared_folder(spark, settings):
    class Session:
        def __init__(self, **values):
            self.conf = self
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    shared = Session(**{"spark.checkpoint.dir": "hdfs://x/shared/", "spark.master": "yarn"})
    assert working_folder(shared, "lake").startswith("hdfs://x/shared/lake-")
    unset = Session(**{"spark.sql.warehouse.dir": "hdfs://x/warehouse"})
    assert working_folder(unset, "lake").startswith("hdfs://x/warehouse/working/lake-")
