"""Change records of three source tables to metrics over time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonearm.functions.dates import micros_to_timestamp
from tonearm.operators.dedup import replacing_latest


@dataclass(frozen=True)
class MetricTable:
    """A captured table: its key and the counts followed over time."""

    name: str
    counts: tuple[str, ...]

    @property
    def source_key(self) -> str:
        return f"{self.name}_id"

    @property
    def key(self) -> str:
        return f"{self.name}_key"

    @property
    def topic(self) -> str:
        return f"public.{self.name}"

    @property
    def row_ddl(self) -> str:
        counts = ", ".join(f"{count}: bigint" for count in self.counts)
        return f"struct<{self.source_key}: string, updated_at: bigint, {counts}>"


# fixed values: captured tables and columns
METRIC_TABLES = {
    table.name: table
    for table in (
        MetricTable("artist", ("followers_count", "monthly_listeners")),
        MetricTable("playlist", ("followers_count",)),
        MetricTable("track", ("plays_count",)),
    )
}

MESSAGE_DDL = "topic string, value string, kafka_time timestamp, kafka_offset bigint"


def file_messages(spark: SparkSession, folder: str, fmt: str = "parquet", **options) -> DataFrame:
    """Stream of messages from files that arrive in a folder."""
    return spark.readStream.schema(MESSAGE_DDL).options(**options).format(fmt).load(folder)


def kafka_messages(spark: SparkSession, servers: str, topics: list[str], **options) -> DataFrame:
    """Stream of messages from Kafka, for sessions that have its data source."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .options(**options)
        .load()
    )
    return records.select(
        "topic",
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("kafka_time"),
        F.col("offset").alias("kafka_offset"),
    )


def unwrap_changes(messages: DataFrame, table: MetricTable) -> DataFrame:
    """The new state of the rows of one table; deletions and other tables are left out.

    Messages are either the envelope with ``after``, or the bare row. Snapshot records look like
    insertions and pass.
    """
    wrapped = F.from_json(
        "value", f"op string, after {table.row_ddl}, source struct<table: string>"
    )
    bare = F.from_json("value", table.row_ddl)
    row = F.when(wrapped["op"].isNotNull(), wrapped["after"]).otherwise(bare)
    of_table = F.when(
        wrapped["source"]["table"].isNotNull(), wrapped["source"]["table"] == table.name
    ).otherwise(F.col("topic").endswith(table.topic))
    kept = of_table & (F.coalesce(wrapped["op"], F.lit("")) != "d")
    return (
        messages.where(kept)
        .select(row.alias("row"), "kafka_time", "kafka_offset")
        .where(F.col(f"row.{table.source_key}").isNotNull())
        .select("row.*", "kafka_time", "kafka_offset")
    )


def metric_rows(changes: DataFrame, table: MetricTable) -> DataFrame:
    """Counts with the second at which the source row changed."""
    return changes.select(
        F.col(table.source_key).alias(table.key),
        micros_to_timestamp("updated_at").alias("tracked_at"),
        *table.counts,
        "kafka_time",
        "kafka_offset",
    )


def write_metrics(metrics: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append metric rows to a table partitioned by day.

    The file sink commits a micro-batch whole or not at all, also after a restart.
    """
    writer = (
        metrics.withColumn("day", F.to_date("tracked_at"))
        .writeStream.format("parquet")
        .partitionBy("day")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest_metrics(rows: DataFrame, table: MetricTable) -> DataFrame:
    """One row per key and second: the one inserted last."""
    return replacing_latest(rows, [table.key, "tracked_at"], "kafka_offset")
