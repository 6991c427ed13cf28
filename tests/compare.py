"""Run registered queries in Spark and their checking SQL in DuckDB, and compare the rows.

Usage: python tests/compare.py [folder] [key prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    from tonearm.queries.fixtures import BASE_TABLES

    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and not math.isnan(value) and value == int(value):
        return int(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return int(value) if value.__class__.__name__ == "Decimal" else value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(con, df, sql) -> tuple[int, str]:
    """Row count and, when the results differ, a description."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return 0, f"columns {sorted(df.columns)} against {sorted(relation.columns)}"
    spark_rows = as_bag(df.columns, df.collect())
    sql_rows = as_bag(relation.columns, relation.fetchall())
    total = sum(spark_rows.values())
    if spark_rows == sql_rows:
        return total, ""
    only_spark = list((spark_rows - sql_rows).items())[:3]
    only_sql = list((sql_rows - spark_rows).items())[:3]
    return total, f"rows {total} against {sum(sql_rows.values())}; only Spark {only_spark}; only SQL {only_sql}"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles, failed = entry.oracle_sql(), 0
    for key, run in entry.queries().items():
        if not key.startswith(prefixes):
            continue
        start = time.time()
        try:
            if key in oracles:
                total, problem = compare(con, run(spark, folder), oracles[key])
            else:
                total, problem = run(spark, folder).count(), ""
        except Exception as error:  # keep going: one report for all queries
            total, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        state = "FAIL" if problem else ("ok  " if key in oracles else "rows")
        failed += bool(problem)
        print(f"{state} {key} {total} {time.time() - start:.1f}s {problem}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
