"""Warehouse tables: staging, snapshots, versioned dimensions, facts.

Parquet has no transactions, so a run never overwrites what it reads. A run has a number that
grows (the date as ``YYYYMMDD``). It writes to folders carrying that number, and the number
becomes visible by one small commit row at the end. Reading for a run looks only at lower
numbers: repeating the last run, for instance after executors were lost, gives the same tables.
Folders of a run that never committed are not read.

Tables to which each run adds are compacted: the rows of a range of runs are written once more, into one folder with few
files, and one commit row lets it stand for these runs. Folders of the runs stay until ``remove_replaced`` finds that no
reader of the last runs can need them.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tonearm.operators import fold as folding
from tonearm.schemas import UNKNOWN_DATE_KEY
from tonearm.sources.lake import path_of, read_if_exists


def run_number(date: dt.date) -> int:
    return date.year * 10000 + date.month * 100 + date.day


def write_staging(df: DataFrame, root: str, table: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.format(fmt).mode(mode).save(path_of(root, table))


def read_table(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame | None:
    """A staging or warehouse table, None when it does not exist."""
    return read_if_exists(spark.read, path_of(root, table), fmt)


COMMIT = "run int, first int, last int, columns string"


def _commit(
    spark: SparkSession, root: str, table: str, run: int, schema: StructType, first: int | None = None, last: int | None = None
) -> None:
    """Make a run visible, and note which columns it wrote: a run without rows leaves no file that tells.

    ``first`` and ``last`` are the runs that a compacted folder stands for.
    """
    row = (run, run if first is None else first, run if last is None else last, schema.json())
    done = spark.range(1).select(*(F.lit(v).alias(c.split()[0]) for c, v in zip(COMMIT.split(", "), row)))
    done.write.mode("overwrite").parquet(f"{path_of(root, table)}/commits/run_{run}")


@dataclass(frozen=True)
class Unit:
    """A folder of rows and the runs it stands for: one, or a range if it is compacted (its number is negative)."""

    run: int
    first: int
    last: int

    def stands_for(self, other: Unit) -> bool:
        """Whether this folder holds the rows of another."""
        if self == other or not (self.first <= other.first and other.last <= self.last):
            return False
        return (self.last - self.first, -self.run) > (other.last - other.first, -other.run)


def committed_units(spark: SparkSession, root: str, table: str, before: int | None = None) -> list[Unit]:
    """All committed folders of runs under ``before``, replaced ones too."""
    commits = read_if_exists(spark.read.schema(COMMIT), f"{path_of(root, table)}/commits/*")
    if commits is None:
        return []
    run = F.col("run")
    units = commits.select("run", F.coalesce("first", run).alias("first"), F.coalesce("last", run).alias("last"))
    if before is not None:
        units = units.where(F.col("last") < before)
    return sorted((Unit(*row) for row in units.dropDuplicates().collect()), key=lambda u: (u.last, u.first, u.run))


def visible_units(spark: SparkSession, root: str, table: str, before: int | None = None) -> list[Unit]:
    """The committed folders that hold every row once."""
    units = committed_units(spark, root, table, before)
    return [u for u in units if not any(other.stands_for(u) for other in units)]


def committed_runs(
    spark: SparkSession, root: str, table: str, before: int | None = None
) -> list[int]:
    """Numbers of the folders to read, the last run's at the end; a compacted folder stands for many runs."""
    return [unit.run for unit in visible_units(spark, root, table, before)]


def latest_unit(spark: SparkSession, root: str, table: str, before: int | None = None) -> Unit | None:
    units = visible_units(spark, root, table, before)
    return units[-1] if units else None


def _rows(spark: SparkSession, root: str, table: str, run: int) -> DataFrame:
    """The rows of all runs with the columns that a run noted."""
    noted = spark.read.schema("columns string").parquet(f"{path_of(root, table)}/commits/run_{run}").first()
    schema = StructType.fromJson(json.loads(noted["columns"])).add("run", IntegerType())
    return spark.read.schema(schema).parquet(f"{path_of(root, table)}/rows")


def latest_run(spark: SparkSession, root: str, table: str, before: int | None = None) -> int | None:
    """The last committed run."""
    runs = committed_runs(spark, root, table, before)
    return runs[-1] if runs else None


def write_snapshot(df: DataFrame, root: str, table: str, run: int) -> None:
    """A whole new content of a table."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path_of(root, table)}/rows/run={run}")
    _commit(spark, root, table, run, df.schema)


def read_snapshot(
    spark: SparkSession, root: str, table: str, before: int | None = None
) -> DataFrame | None:
    run = latest_run(spark, root, table, before)
    if run is None:
        return None
    return spark.read.parquet(f"{path_of(root, table)}/rows/run={run}")


def write_versions(df: DataFrame, root: str, table: str, run: int) -> None:
    """Outcome of a type-2 merge of the open versions: those still open, and those closed now.

    Versions closed by earlier runs stay in their own folders and are not written again.
    """
    spark = df.sparkSession
    is_open = F.col("valid_to").isNull()
    rows = df.withColumn("state", F.when(is_open, "open").otherwise("closed"))
    rows.write.mode("overwrite").partitionBy("state").parquet(f"{path_of(root, table)}/rows/run={run}")
    _commit(spark, root, table, run, rows.schema)


def read_versions(
    spark: SparkSession, root: str, table: str, before: int | None = None, open_only: bool = False
) -> DataFrame | None:
    """All versions of a type-2 table, or those in force; partition filters pick the folders."""
    runs = committed_runs(spark, root, table, before)
    if not runs:
        return None
    df = _rows(spark, root, table, runs[-1])
    in_force = (F.col("run") == runs[-1]) & (F.col("state") == "open")
    history = F.col("run").isin(runs) & (F.col("state") == "closed")
    return df.where(in_force if open_only else in_force | history).drop("run", "state")


def month_of(date: Column | str) -> Column:
    """Partition value of facts laid out by month."""
    return F.trunc(date, "MM").cast("date")


KEY_RANGE_WIDTH = 50_000  # fixed value: five years of YYYYMMDD keys


def key_bucket(key: Column | str) -> Column:
    """Partition value of facts laid out by ranges of an integer date key."""
    key = F.col(key) if isinstance(key, str) else key
    return (F.floor(key / KEY_RANGE_WIDTH) * KEY_RANGE_WIDTH).cast("int")


@dataclass(frozen=True)
class Layout:
    """The partition column of a fact table, its value, and the folders a key range can lie in.

    ``folded`` names the key whose values repeat the rest of the row; such rows are distinct.
    """

    column: str
    value: Callable[[], Column]
    reachable: Callable[[int, int], Column]
    folded: str | None = None


def _months_between(low: int, high: int) -> Column:
    def month(key: int) -> Column:
        return F.to_date(F.lit(f"{key // 100}01"), "yyyyMMdd")

    column = F.col("added_month")
    if low == UNKNOWN_DATE_KEY:  # rows without a date have no month
        return column.isNull() if high == low else column.isNull() | (column <= month(high))
    return column.between(month(low), month(high))


INDEX_BUCKETS = 64


def bucket_of(key: Column | str) -> Column:
    """Partition value of tables in which rows are looked up by an id."""
    return F.pmod(F.xxhash64(key), F.lit(INDEX_BUCKETS)).cast("int")


def _index(key: str) -> Layout:
    return Layout("bucket", lambda: bucket_of(key), lambda low, high: F.lit(True))


FACT_LAYOUT = {
    "fact_playlist_track": Layout(
        "added_month", lambda: month_of(F.col("date_actual")), _months_between, "genre_key"
    ),
    "fact_album_track": Layout(
        "release_bucket",
        lambda: key_bucket("release_date_key"),
        lambda low, high: F.col("release_bucket").between(
            low // KEY_RANGE_WIDTH * KEY_RANGE_WIDTH, high // KEY_RANGE_WIDTH * KEY_RANGE_WIDTH
        ),
        "genre_key",
    ),
    "tracks_by_album": _index("album_id"),
    "albums_by_artist": _index("artist_id"),
    "artists_by_album": _index("album_id"),
    "tracks_by_artist": _index("artist_id"),
    "artists_by_track": _index("track_id"),
    "entries_by_track": _index("track_id"),
    "entries_by_playlist": _index("playlist_id"),
}


def write_facts(df: DataFrame, root: str, table: str, run: int) -> None:
    """Add the new facts of a run, laid out for pruning.

    Rebalancing gathers each layout value into few files, and cuts a value holding a large share
    of the rows into several. Facts are moved folded, and unfolded where they are written; they may come folded.
    """
    laid_out = _write_laid_out(df, root, table, run)
    _commit(df.sparkSession, root, table, run, laid_out.schema)


def _write_laid_out(df: DataFrame, root: str, table: str, run: int) -> DataFrame:
    layout = FACT_LAYOUT[table]
    laid_out = df.withColumn(layout.column, layout.value())
    if folding.MASK in df.columns:
        plain = [layout.folded if c == folding.MASK else c for c in laid_out.columns if c != folding.WORD]
        laid_out = folding.unfold(laid_out.hint("rebalance", layout.column), layout.folded, plain)
    elif layout.folded in df.columns:
        moved = folding.fold(laid_out, layout.folded).hint("rebalance", layout.column)
        laid_out = folding.unfold(moved, layout.folded, laid_out.columns, folding.type_of(df, layout.folded))
    else:
        laid_out = laid_out.hint("rebalance", layout.column)
    (
        laid_out.write.mode("overwrite")
        .partitionBy(layout.column)
        .parquet(f"{path_of(root, table)}/rows/run={run}")
    )
    return laid_out


def read_facts(
    spark: SparkSession, root: str, table: str, before: int | None = None
) -> DataFrame | None:
    """All rows of committed runs; for tables to which each run adds.

    The columns are those of the last commit, so runs without facts can be read too.
    """
    runs = committed_runs(spark, root, table, before)
    if not runs:
        return None
    return _rows(spark, root, table, runs[-1]).where(F.col("run").isin(runs))


def read_index(spark: SparkSession, root: str, table: str, keys: DataFrame, before: int | None = None) -> DataFrame | None:
    """The rows of an index whose key is among ``keys`` (one column of the index's key); only their buckets are read."""
    rows = read_facts(spark, root, table, before)
    if rows is None:
        return None
    (key,) = keys.columns
    buckets = [row[0] for row in keys.select(bucket_of(key)).distinct().collect()]  # INDEX_BUCKETS numbers at most
    return rows.where(F.col("bucket").isin(buckets)).drop("run", "bucket").join(keys, key, "left_semi")


# ---- compaction and retention ----------------------------------------------------------------


def compact(spark: SparkSession, root: str, table: str, first: int, last: int) -> int | None:
    """Write the rows of runs ``first`` to ``last`` into one folder that stands for them; its number.

    The last committed run is left out, since it may be repeated; nothing happens with fewer than two folders. Readers
    see either the folders of the runs or the compacted one: the commit row, written at the end, decides. A compaction
    that stopped before it is done again from the start; one that is done already is not written again, as it may be
    read. Compacted folders can be compacted again, together with others.
    """
    units = visible_units(spark, root, table)
    if not units:
        return None
    last = min(last, max(u.last for u in units[:-1])) if len(units) > 1 else first - 1
    parts = [u for u in units if first <= u.first and u.last <= last]
    if len(parts) < 2:
        return None
    tier = 1 + max(-u.run % 100 if u.run < 0 else 0 for u in parts)
    number = -(parts[-1].last * 100 + tier)
    rows = _rows(spark, root, table, parts[-1].run).where(F.col("run").isin([u.run for u in parts]))
    laid_out = _write_laid_out(rows.drop("run", FACT_LAYOUT[table].column), root, table, number)
    _commit(spark, root, table, number, laid_out.schema, parts[0].first, parts[-1].last)
    return number


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_replaced(spark: SparkSession, root: str, table: str, keep_runs: int = 2) -> list[int]:
    """Delete the folders that compacted ones stand for; their numbers.

    A reader that began before one of the last ``keep_runs`` runs may still be reading the folders of its time, so a
    folder goes only if what stands for it was complete before these runs. The commit row goes first: a folder without
    one is not read.
    """
    units = committed_units(spark, root, table)
    runs = sorted({u.last for u in units})
    if len(runs) <= keep_runs:
        return []
    limit = runs[-keep_runs]
    old = [u for u in units if any(other.stands_for(u) and other.last < limit for other in units)]
    for unit in old:
        _delete(spark, f"{path_of(root, table)}/commits/run_{unit.run}")
    for unit in old:
        _delete(spark, f"{path_of(root, table)}/rows/run={unit.run}")
    return [unit.run for unit in old]


def remove_snapshots(spark: SparkSession, root: str, table: str, keep_runs: int = 2) -> list[int]:
    """Delete all snapshots of a table but the last ``keep_runs``; their numbers."""
    old = committed_runs(spark, root, table)[:-keep_runs]
    for run in old:
        _delete(spark, f"{path_of(root, table)}/commits/run_{run}")
        _delete(spark, f"{path_of(root, table)}/rows/run={run}")
    return old
