"""Tables and files in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid
import weakref

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from tonearm.session import working_folder


#: Where the tables that ``stored`` wrote lie.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame as a table in the shared folder and read it back.

    This cuts the lineage: what follows a lost executor starts from the table.
    """
    spark = df.sparkSession
    path = working_folder(spark, purpose)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that ``stored`` wrote and nothing will read again: all that came of it is stored as well."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(_PATHS.pop(table))
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_file(folder: str, suffix: str) -> str:
    """A file name no other attempt of the same task uses.

    A repeated task writes another file; only files named by the manifest that Spark commits count.
    """
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    """A binary stream writing ``uri``, on any store that Arrow knows by its scheme."""
    store, path = pafs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A seekable binary file."""
    store, path = pafs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def one_task_per_file(manifest: DataFrame, widest: int = 20_000) -> DataFrame:
    """Deal the rows of a manifest out so that files are read side by side."""
    return manifest.repartition(max(1, min(manifest.count(), widest)))
