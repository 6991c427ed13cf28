"""Registration of queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tonearm.queries.fixtures import Catalogue
from tonearm.queries.oracle import with_ctes
from tonearm.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, **ctes: str):
    """Register a function of the catalogue under ``key``."""

    def register(build: Callable[[Catalogue], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Catalogue(tune(spark), sf_dir))

        run.__name__ = key
        run.__doc__ = build.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_ctes(sql, ctes)
        return build

    return register
