"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

Result = TypeVar("Result")

# Runtime settings every job here relies on. Nothing sets a partition count: adaptive
# execution sizes partitions from what was really shuffled.
RUNTIME_SETTINGS = {
    # dates are cut from timestamps, so all sessions must agree on the zone
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a playlist, artist or album holding a large share of the rows: its partition is split
    # at run time, also when two joins on the same key follow each other
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # what a query shuffled goes when it ends, not when the driver happens to collect garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # a task that writes a few layout folders keeps their files open, instead of sorting its rows first
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # what a Python worker is handed at once; it holds such a batch besides what it makes of it
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for tables a job writes and reads back.

    It lies in the shared folder named by ``spark.checkpoint.dir`` or, where that is unset, in
    the warehouse, which all executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/working"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def side_by_side(jobs: Sequence[Callable[[], Result]], at_once: int = 4) -> list[Result]:
    """Run independent jobs on one session at the same time; results in their order.

    The daily tables differ in size, so that one after the other would leave executors idle.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return [future.result() for future in [pool.submit(job) for job in jobs]]
