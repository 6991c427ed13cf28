"""Numbers and chunks without a window over the whole data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_numbers(
    df: DataFrame, column: str, name: str, after: Column | int = 0, prefix: int = 2
) -> DataFrame:
    """Number distinct texts 1, 2, … in their order, starting after ``after``.

    Rows are numbered inside buckets of texts that begin alike; the start of a bucket is the
    running total of the bucket sizes. Only those sizes, one row per beginning, pass through
    a window over everything.
    """
    bucketed = df.withColumn("_bucket", F.substring(column, 1, prefix))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(column))
    after = F.lit(after) if isinstance(after, int) else after
    return (
        bucketed.withColumn("_inside", inside)
        .join(starts, "_bucket")
        .withColumn(name, (after + F.col("_start") + F.col("_inside")).cast("bigint"))
        .drop("_bucket", "_inside", "_start")
    )


def chunk_ids(df: DataFrame, column: str, size: int, shards: int) -> DataFrame:
    """Cut distinct ids into chunks of at most ``size``: rows ``(shard, chunk, ids)``.

    Ids are spread over ``shards`` by hash and numbered inside their shard, so the work of one
    task is the number of ids over the number of shards. Only the last chunk of a shard may be
    short.
    """
    shard = F.pmod(F.xxhash64(column), F.lit(shards)).cast("int")
    ordered = Window.partitionBy("shard").orderBy(column)
    return (
        df.select(column)
        .dropDuplicates()
        .withColumn("shard", shard)
        .withColumn("chunk", F.floor((F.row_number().over(ordered) - 1) / size).cast("int"))
        .groupBy("shard", "chunk")
        .agg(F.array_sort(F.collect_list(column)).alias("ids"))
    )
