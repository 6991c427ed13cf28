"""Registration of this subpackage's queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tonearm.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a function of a session and a folder of tables under ``key``."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        run.__name__ = key
        run.__doc__ = build.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register
