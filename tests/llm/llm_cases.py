"""Rows that every operator must take, and plain versions to hold results against."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("row", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("length", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("tokens", T.StringType()),
        T.StructField("tie", T.StringType()),
    ]
)
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))
EDGES = [
    (1, "Some plain words of a first text, and then a few more of them."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, LONG),
    (6, "Some plain words of a first text, and then a few more of them."),
    (6, "Some plain words of a first text, and then a few more of them."),
    (None, "A row without an id, with words of its own."),
    (7, "é ü 中文 words😀 ́ ok"),
    (8, "one"),
]


def docs(spark, rows, lang="en", source="s"):
    return spark.createDataFrame(
        [(i, t, lang, source, None if t is None else len(t), "r", "n", "d", "l", "k", "t", "e") for i, t in rows], DOCS
    )


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def texts_of(spark):
    return [(r.doc_id, r.text) for r in table(spark, "documents").select("doc_id", "text").collect()]


def components(nodes, links):
    """Smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near_components(rows, width, percent):
    """Component of each document by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, width) for i, t in rows}
    holders = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    links = []
    for i, own in sets.items():
        for j in {j for s in own for j in holders[s] if j < i}:
            shared = len(own & sets[j])
            if 100 * shared >= percent * (len(own) + len(sets[j]) - shared):
                links.append((i, j))
    return {i: len(s) for i, s in sets.items()}, components(sets, links)
