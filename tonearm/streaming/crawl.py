"""Crawl messages in micro-batches: distinct ids, gate, chunks, bookkeeping."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonearm.operators.numbering import chunk_ids
from tonearm.plans import frontier
from tonearm.schemas import TRACKING_DDL
from tonearm.sources.lake import read_if_exists

CRAWL_MESSAGE_DDL = "topic string, key_ts bigint, object_id string, error string"


def distinct_ids_by_topic(messages: DataFrame) -> DataFrame:
    """Each id once per topic; empty and failed messages are dropped."""
    good = F.col("object_id").isNotNull() & F.col("error").isNull()
    return messages.where(good).select("topic", "object_id").dropDuplicates()


def stream_id(checkpoint: str) -> str:
    """Name of the stream that a checkpoint belongs to: batch numbers are its own only."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()


def read_tracking(spark: SparkSession, path: str, other_than: tuple[str, int] | None = None) -> DataFrame:
    """Tracked work of all streams, without what a repeated micro-batch of a stream wrote itself."""
    schema = f"{TRACKING_DDL}, stream string, batch bigint"
    tracking = read_if_exists(spark.read.schema(schema), path)
    if tracking is None:
        tracking = spark.createDataFrame([], schema)
    if other_than is not None:
        stream, batch = other_than
        tracking = tracking.where((F.col("stream") != stream) | (F.col("batch") != batch))
    return tracking.drop("stream", "batch")


def frontier_batch(
    messages: DataFrame,
    tracking: DataFrame,
    topic: str,
    function_name: str,
    arg_name: str,
    refresh: bool = False,
) -> DataFrame:
    """Ids of one topic in the micro-batch that are still to be fetched."""
    ids = distinct_ids_by_topic(messages).where(F.col("topic") == topic).select("object_id")
    return frontier.should_crawl(ids, "object_id", tracking, function_name, arg_name, refresh)


def run_frontier(
    messages: DataFrame,
    work_path: str,
    tracking_path: str,
    checkpoint: str,
    topic: str,
    function_name: str,
    arg_name: str,
    day_of: Callable[[], dt.date],
    chunk: int = frontier.OTHER_CHUNK,
    shards: int = 64,
    refresh: bool = False,
    once: bool = False,
) -> StreamingQuery:
    """Turn crawl messages into chunks of ids to fetch, and record them as tracked.

    Each micro-batch writes to folders carrying its stream and number and overwrites them when
    repeated; a stream is what has one checkpoint. The gate sees what all streams have tracked.
    The chunks are written first and the tracking rows are taken from them, so a repeat after a
    failure between the two finds the same ids.
    """
    stream = stream_id(checkpoint)

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        tracking = read_tracking(spark, tracking_path, other_than=(stream, number))
        ids = frontier_batch(batch, tracking, topic, function_name, arg_name, refresh)
        work = f"{work_path}/stream={stream}/batch={number}"
        chunk_ids(ids, "object_id", chunk, shards).write.mode("overwrite").parquet(work)
        taken = spark.read.parquet(work).select(F.explode("ids").alias("object_id"))
        rows = frontier.newly_tracked(
            taken, "object_id", tracking, function_name, arg_name, day_of()
        )
        # the gate asks for one function and argument, so these are folders
        rows.write.mode("overwrite").partitionBy("function_name", "main_arg_name").parquet(
            f"{tracking_path}/stream={stream}/batch={number}"
        )

    writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
