"""What all document jobs share: parsing bodies, and rows out of nested values."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rows:
    """Rows for one table. Their columns are exactly those the documents carry."""

    table: str
    df: DataFrame


def parse_bodies(bodies: DataFrame, ddl: str, needs: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents of (…, body) rows as column ``doc``, and the rows that cannot be used.

    Each body is parsed once: as the output of a generator, ``doc`` is not put into the conditions on it, where Spark would
    parse the body again for each of them. Empty bodies are dropped. Malformed ones, and those lacking the field ``needs``, are returned
    with a reason, to be fetched again. When several tables are taken from the documents, write
    them once and read them back, or every table parses the bodies anew.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = bodies.where("trim(body) not in ('', 'null')").select(
        "*", F.explode(F.array(F.from_json("body", f"struct<{ddl}, _corrupt_record: string>", options))).alias("doc")
    )
    reason = F.when(F.col("doc._corrupt_record").isNotNull(), "malformed")
    if needs:
        reason = reason.when(F.col(f"doc.{needs}").isNull(), f"no {needs}")
    parsed = parsed.where("doc is not null").withColumn("reason", reason)
    good = parsed.where("reason is null").drop("body", "reason")
    return good, parsed.where("reason is not null").drop("doc")


def items(array: Column) -> Column:
    """The elements of an array that are not NULL; none for a missing array."""
    return F.filter(array, lambda item: item.isNotNull())


def one_row(docs: DataFrame, row: Column) -> DataFrame:
    """One row per document."""
    return docs.select("fetched_at", row.alias("row")).select("fetched_at", "row.*")


def row_each(docs: DataFrame, array: Column, row: Callable[[Column], Column]) -> DataFrame:
    """One row per element of an array in the documents."""
    rows = F.explode(F.transform(items(array), row)).alias("row")
    return docs.select("fetched_at", rows).select("fetched_at", "row.*")


def doc_each(docs: DataFrame, array: Column) -> DataFrame:
    """The elements of an array as documents of their own; other columns are kept."""
    kept = [c for c in docs.columns if c != "doc"]
    return docs.select(*kept, F.explode(items(array)).alias("doc"))


def named(**columns: Column) -> Column:
    """A row with the given columns."""
    return F.struct(*[column.alias(name) for name, column in columns.items()])
