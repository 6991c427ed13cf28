"""Connected components of a graph kept as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.files import discard, stored


def _fingerprint(edges: DataFrame) -> tuple:
    """Tells whether two tables of edges hold the same rows; one row reaches the driver."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node goes to the smallest node among it and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its neighbours below it go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    near = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return near.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root, the smallest node it reaches, for every node of ``edges`` (a, b) but the roots.

    Alternates stars until every component is one star. Smallest neighbours are found by aggregates and joined back, so
    a node with very many edges is no single task's work. Each round is stored, so a lost executor costs one round.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    for round_ in range(most_rounds):
        last, edges = edges, stored(_small_star(_large_star(edges)), f"edges-{round_}")
        discard(last)
        now = _fingerprint(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError("components did not settle")
