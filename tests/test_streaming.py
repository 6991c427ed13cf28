"""Streams of files: restart, replay, failures between two writes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tonearm.plans import frontier
from tonearm.streaming import changes, crawl

ARTIST = changes.METRIC_TABLES["artist"]


def message(offset, artist, micros, followers, op="u", table="artist"):
    after = f'{{"artist_id": "{artist}", "updated_at": {micros}, "followers_count": {followers}, "name": "n"}}'
    value = f'{{"op": "{op}", "after": {after}, "source": {{"table": "{table}"}}}}'
    return (f"s.public.{table}", value, dt.datetime(2024, 1, 1), offset)


def arrive(spark, folder, messages):
    spark.createDataFrame(messages, changes.MESSAGE_DDL).coalesce(1).write.mode("append").parquet(folder)


def drain(spark, folder, table, checkpoint):
    rows = changes.metric_rows(changes.unwrap_changes(changes.file_messages(spark, folder), ARTIST), ARTIST)
    changes.write_metrics(rows, table, checkpoint, once=True).awaitTermination()


def test_restart_goes_on_and_reading_keeps_the_last_row(spark, tmp_path, rows):
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    second = 1_700_000_000_000_000
    arrive(spark, folder, [message(1, "a", second, 10), message(2, "a", second + 999_999, 11), message(3, "b", second, 1)])
    drain(spark, folder, table, checkpoint)
    arrive(spark, folder, [message(4, "b", second, 2), message(5, "a", second + 1_000_000, 12), message(6, "c", second, 9, op="d")])
    drain(spark, folder, table, checkpoint)
    drain(spark, folder, table, checkpoint)
    stored = spark.read.parquet(table)
    assert stored.count() == 5
    assert rows(changes.latest_metrics(stored.drop("day"), ARTIST), "artist_key", "followers_count") == [
        ("a", 11), ("a", 12), ("b", 2),
    ]


def test_bare_rows_missing_counts_and_other_tables(spark, rows):
    messages = spark.createDataFrame(
        [
            ("s.public.artist", '{"artist_id": "a", "updated_at": 1}', None, 1),
            ("s.public.artist", '{"artist_id": null}', None, 2),
            ("s.public.artist", None, None, 3),
            ("s.public.artist", "not json", None, 4),
            message(5, "x", 1, 1, table="album"),
            message(6, "s", 1, 1, op="r"),
        ],
        changes.MESSAGE_DDL,
    )
    found = changes.metric_rows(changes.unwrap_changes(messages, ARTIST), ARTIST)
    assert rows(found, "artist_key", "followers_count") == [("a", None), ("s", 1)]


def crawl_arrives(spark, folder, ids):
    data = [(frontier.TRACK_WEB, 0, i, None) for i in ids]
    spark.createDataFrame(data, crawl.CRAWL_MESSAGE_DDL).coalesce(1).write.mode("append").parquet(folder)


def run(spark, root, **options):
    stream = spark.readStream.schema(crawl.CRAWL_MESSAGE_DDL).parquet(f"{root}/in")
    crawl.run_frontier(
        stream, f"{root}/work", f"{root}/tracking", f"{root}/checkpoint", frontier.TRACK_WEB, "crawl_track",
        "track_id", lambda: dt.date(2024, 1, 2), chunk=2, shards=2, once=True, **options,
    ).awaitTermination()


def test_ids_are_worked_on_once(spark, tmp_path, rows):
    root = str(tmp_path)
    crawl_arrives(spark, f"{root}/in", ["a", "b", "b", "c", None])
    run(spark, root)
    crawl_arrives(spark, f"{root}/in", ["c", "d"])
    run(spark, root)
    work = spark.read.parquet(f"{root}/work")
    assert rows(work.select(F.explode("ids"), "batch")) == [("a", 0), ("b", 0), ("c", 0), ("d", 1)]
    assert work.where("size(ids) > 2").count() == 0
    assert crawl.read_tracking(spark, f"{root}/tracking").count() == 4


def test_repeated_batch_finds_the_same_ids(spark, tmp_path, rows):
    """A batch that failed after its tracking rows were written, and is run again."""
    root = str(tmp_path)
    own = crawl.stream_id(f"{root}/checkpoint")
    tracked = [("crawl_track", "track_id", i, dt.date(2024, 1, 2), own, b) for i, b in (("a", 0), ("z", 7))]
    spark.createDataFrame(tracked, "function_name string, main_arg_name string, main_arg_value string, tracked_at date, stream string, batch bigint").write.partitionBy("stream", "batch", "function_name", "main_arg_name").parquet(f"{root}/tracking")
    crawl_arrives(spark, f"{root}/in", ["a", "z", "n"])
    run(spark, root)
    assert rows(spark.read.parquet(f"{root}/work").select(F.explode("ids"))) == [("a",), ("n",)]
    assert rows(crawl.read_tracking(spark, f"{root}/tracking"), "main_arg_value") == [("a",), ("n",), ("z",)]


def test_streams_share_what_is_tracked(spark, tmp_path, rows):
    """Another function's stream and a new checkpoint begin at batch 0 too and lose nothing."""
    root = str(tmp_path)
    crawl_arrives(spark, f"{root}/in", ["a", "b"])
    for checkpoint, function in (("one", "f"), ("two", "g"), ("three", "f")):
        crawl.run_frontier(
            spark.readStream.schema(crawl.CRAWL_MESSAGE_DDL).parquet(f"{root}/in"), f"{root}/work_{checkpoint}",
            f"{root}/tracking", f"{root}/{checkpoint}", frontier.TRACK_WEB, function, "track_id",
            lambda: dt.date(2024, 1, 2), once=True,
        ).awaitTermination()
    tracked = rows(crawl.read_tracking(spark, f"{root}/tracking"), "function_name", "main_arg_value")
    assert tracked == [("f", "a"), ("f", "b"), ("g", "a"), ("g", "b")]
    third = spark.read.schema("ids array<string>").parquet(f"{root}/work_three")
    assert third.select(F.explode("ids")).count() == 0


def test_gate_by_function_argument_and_day(spark, rows):
    tracking = spark.createDataFrame(
        [("f", "id", "a", dt.date(2024, 1, 1)), ("f", "id", "b", dt.date(2024, 1, 2)), ("g", "id", "c", dt.date(2024, 1, 2))],
        "function_name string, main_arg_name string, main_arg_value string, tracked_at date",
    )
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    assert rows(frontier.should_crawl(ids, "id", tracking, "f", "id")) == [("c",)]
    assert rows(frontier.should_crawl(ids, "id", tracking, "f", "id", today=dt.date(2024, 1, 2))) == [("a",), ("c",)]
    assert len(rows(frontier.should_crawl(ids, "id", tracking, "f", "id", refresh=True))) == 3
    fresh = frontier.newly_tracked(ids, "id", tracking, "f", "id", dt.date(2024, 1, 2))
    assert rows(fresh, "main_arg_value") == [("a",), ("c",)]


def test_unknown_search_kind(spark):
    with pytest.raises(ValueError):
        frontier.search_messages("label", spark.range(1))
