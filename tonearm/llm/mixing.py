"""Documents sampled so that sources, languages and topics take target shares of the tokens.

Tokens are added up by cell, a cell being a source, language and topic that occur together. Iterative proportional
fitting multiplies the cells' weights until the three sets of margins meet their targets; a document is given as often
as the factor of its cell says, a fraction being drawn. Everything is columns, aggregates and joins; no Python runs in
the tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.llm.files import stored

NOT_BLANK_RUN = r"[^\x20\x09-\x0D]+"
NONE = "(none)"
SWEEPS = 10


def margin_columns(margins: Mapping[str, Column]) -> dict[str, Column]:
    """The categories of a document; an unknown one is a category of its own."""
    return {f"margin_{name}": F.coalesce(column.cast("string"), F.lit(NONE)) for name, column in margins.items()}


def token_cells(docs: DataFrame, margins: Mapping[str, Column], tokens: Column) -> DataFrame:
    """Tokens by cell, stored. A source of a third of all documents sends a few rows a task."""
    keys = margin_columns(margins)
    rows = docs.select(*(c.alias(k) for k, c in keys.items()), tokens.cast("double").alias("tokens"))
    return stored(rows.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "token-cells")


def smoothed(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """category and share, proportional to a power below one of the tokens it has."""
    mass = cells.groupBy(F.col(f"margin_{margin}").alias("category")).agg(F.sum("tokens").alias("tokens"))
    raised = F.pow("tokens", F.lit(power))
    total = mass.where("tokens > 0").agg(F.sum(raised)).first()[0] or 1.0
    return mass.where("tokens > 0").select("category", (raised / total).alias("share"))


def fixed(cells: DataFrame, margin: str, weights: Mapping[str, float]) -> DataFrame:
    """category and share by given weights.

    Categories without a weight keep the share they have; the others divide what is left by their weights. Weights of
    categories that no document has are left out.
    """
    spark = cells.sparkSession
    mass = cells.groupBy(F.col(f"margin_{margin}").alias("category")).agg(F.sum("tokens").alias("tokens"))
    given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "category string, weight double")
    rows = mass.where("tokens > 0").join(given, "category", "left")
    sums = rows.agg(
        F.sum("tokens").alias("all"),
        F.sum(F.when(F.col("weight").isNull(), F.col("tokens"))).alias("rest"),
        F.sum("weight").alias("weights"),
    ).first()
    every, rest = sums["all"] or 1.0, (sums["rest"] or 0.0) / (sums["all"] or 1.0)
    share = F.when(F.col("weight").isNull(), F.col("tokens") / every)
    return rows.select("category", share.otherwise(F.col("weight") / (sums["weights"] or 1.0) * (1 - rest)).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """Cells with the factor that makes their tokens meet all targets.

    One sweep scales the cells to each margin in turn. Cells of a category without tokens or target keep their factor.
    Each step is stored, as it reads the cells twice: the plan stays short and a lost executor costs one step.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    targets = {name: stored(frame, f"target-{name}") for name, frame in targets.items()}
    fitted = cells.withColumn("factor", F.lit(1.0))
    for _ in range(sweeps):
        for name, target in targets.items():
            key = f"margin_{name}"
            mass = fitted.groupBy(key).agg(F.sum(F.col("tokens") * F.col("factor")).alias("mass")).where("mass > 0")
            scale = F.col("share") * total / F.col("mass")
            scales = mass.join(target.withColumnRenamed("category", key), key).select(key, scale.alias("scale"))
            fitted = fitted.join(scales, key, "left").withColumn("factor", F.col("factor") * F.coalesce("scale", F.lit(1.0)))
            fitted = stored(fitted.drop("scale"), "raked-cells")
    return fitted


def uniform(key: Column, seed: str) -> Column:
    """A number from 0 to below 1 that depends on key and seed alone."""
    text = F.concat(F.lit(seed + "-"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(1 << 48)


def sample(
    docs: DataFrame,
    fitted: DataFrame,
    margins: Mapping[str, Column],
    key: str = "doc_id",
    rate: float = 1.0,
    seed: str = "mix",
) -> DataFrame:
    """``doc`` (all columns), the margins, the probability, whether the document is taken, and in how many copies.

    A document is wanted ``rate`` times the factor of its cell: it has as many copies as that has whole parts, and one
    more by a draw for the rest, so the expected tokens of every cell are the raked ones. ``probability`` is that of at
    least one copy, ``taken`` says whether there is one. The draw is a hash of the key, so it is the same in every run
    and for all rows of one key; rows without a key share one draw. The cells were stored, so Spark knows their size
    when it plans the join.
    """
    keys = margin_columns(margins)
    rows = docs.select(F.struct("*").alias("doc"), uniform(F.col(key), seed).alias("draw"), *(c.alias(k) for k, c in keys.items()))
    wanted = F.round(F.lit(rate) * F.col("factor"), 9)
    joined = rows.join(fitted.select(*keys, F.least(F.lit(1.0), wanted).alias("probability"), wanted.alias("wanted")), list(keys))
    whole = F.floor("wanted")
    copies = whole + (F.col("draw") < F.col("wanted") - whole).cast("long")
    return joined.withColumns({"taken": F.col("draw") < F.col("probability"), "copies": copies}).drop("draw", "wanted")


def repeated(sampled: DataFrame) -> DataFrame:
    """The documents of a sample, each as often as it has copies, with their columns only."""
    taken = sampled.where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_BLANK_RUN))


def form_of(text: Column) -> Column:
    """A topic told from the form of a text: licence, table, contact, brief or prose."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(text.contains("icense"), "licence")
        .when(text.contains(" | "), "table")
        .when(text.contains("@"), "contact")
        .when(F.length(text) < 600, "brief")
        .otherwise("prose")
    )


def mix(docs: DataFrame, languages: Mapping[str, float], power: float = 0.7, sweeps: int = SWEEPS) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, ...) drawn to smoothed sources and topics and given languages.

    One row per row of ``docs``: repeated rows are drawn alike, very long texts count with all their tokens.
    Unknown sources and languages are categories of their own, a null text has no tokens, and no documents give none.
    """
    margins = {"source": F.col("source"), "lang": F.col("lang"), "topic": form_of(F.col("text"))}
    cells = token_cells(docs, margins, word_count(F.col("text")))
    targets = {
        "source": smoothed(cells, "source", power),
        "lang": fixed(cells, "lang", languages),
        "topic": smoothed(cells, "topic", power),
    }
    return sample(docs, rake(cells, targets, sweeps), margins)
