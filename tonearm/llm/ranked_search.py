"""Ranked lexical search: the best documents of every query, by the mask of the query's terms that they hold.

1. One pass over the documents keeps, of each chunk, the occurrences of the queries' terms by term, and all counts of
   terms that the weights need. The chunks are stored.
2. Numbers of documents and terms, and of documents holding each term, are added up over the chunks.
3. In a chunk, a query ORs one bit a term over the documents holding it, so each document has the mask of the terms it
   holds, and documents fall into groups of one mask. A group's score is at most the sum of its terms' largest parts in
   the chunk. Groups are taken by descending bound, and their documents scored, until the bound lies below the last of
   the best found so far by this task; no document after that can enter the list.
4. Each task returns a list per query, and the lists of all tasks are merged.

Queries are dealt into blocks of bounded size, each searched in all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.files import stored
from tonearm.llm.words import text_chunks

U64 = np.uint64
#: ASCII other than letters and digits is blank, letters are in lower case; all other bytes belong to terms.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
CHUNKS = "n_docs long, n_terms long, df array<int>, doc_ids binary, missing binary, sizes binary, firsts binary, docs binary, tfs binary"
HITS = "number int, doc_id long, missing boolean, score long"


@dataclass(frozen=True)
class Ranking:
    """Documents returned per query, and bytes of queries searched at once."""

    top: int = 10
    block_bytes: int = 4_000_000


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per chunk of documents: counts, and for each term of the vocabulary the documents holding it and how often; stored."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                sizes, rows, numbers = [], [], []
                for text in texts:
                    terms = terms_of(text)
                    held = [vocabulary[t] for t in terms if t in vocabulary]
                    sizes.append(len(terms))
                    rows.append(len(held))
                    numbers += held
                doc = np.repeat(np.arange(len(texts)), rows)
                place, tf = np.unique(np.array(numbers, np.int64) * len(texts) + doc, return_counts=True)
                df = np.bincount(place // len(texts), minlength=len(vocabulary))
                own = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "n_docs": sum(n > 0 for n in sizes),
                            "n_terms": sum(sizes),
                            "df": df.tolist(),
                            "doc_ids": own.fill_null(0).to_numpy().astype(np.int64).tobytes(),
                            "missing": own.is_null().to_numpy(zero_copy_only=False).tobytes(),
                            "sizes": np.array(sizes, np.int64).tobytes(),
                            "firsts": np.cumsum(np.append(0, df)).astype(np.int64).tobytes(),
                            "docs": (place % len(texts)).astype(np.int32).tobytes(),
                            "tfs": tf.astype(np.int32).tobytes(),
                        }
                    ],
                    CHUNK_SCHEMA,
                )

    return stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(chunks, CHUNKS), "postings")


CHUNK_SCHEMA = pa.schema(
    [("n_docs", pa.int64()), ("n_terms", pa.int64()), ("df", pa.list_(pa.int32()))]
    + [(name, pa.binary()) for name in ("doc_ids", "missing", "sizes", "firsts", "docs", "tfs")]
)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def masks_of(terms: list[np.ndarray], n_docs: int) -> np.ndarray:
    """One row of 64-bit words per document: bit k is set where ``terms[k]`` holds the document."""
    masks = np.zeros((n_docs, max(1, -(-len(terms) // 64))), U64)
    for k, docs in enumerate(terms):
        masks[docs, k // 64] |= U64(1 << k % 64)
    return masks


def grouped(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct masks that are not empty; documents ordered by mask, and where each mask's documents start."""
    holding = np.flatnonzero(masks.any(axis=1))
    own = masks[holding]
    order = np.lexsort(own.T)
    own = own[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]).any(axis=1)
    return own[new], holding[order], np.append(np.flatnonzero(new), len(own))


class Best:
    """The best documents of one query so far: highest score, then smallest doc_id, those without one last."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.rows = np.zeros((0, 3), np.int64)  # score, no doc_id, doc_id

    @property
    def least(self) -> int:
        """A score below this cannot enter."""
        return int(self.rows[-1, 0]) if len(self.rows) == self.top else 1

    def add(self, scores: np.ndarray, missing: np.ndarray, doc_ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([scores, missing, doc_ids], axis=1)[scores > 0]])
        self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[: self.top]]


class Chunk:
    """A stored chunk's postings with the part of a score that does not depend on the query."""

    def __init__(self, row: dict, n_docs: int, n_terms: int) -> None:
        self.doc_ids, self.sizes, self.firsts = (np.frombuffer(row[c], np.int64) for c in ("doc_ids", "sizes", "firsts"))
        self.missing = np.frombuffer(row["missing"], bool).astype(np.int64)
        self.docs = np.frombuffer(row["docs"], np.int32)
        tf = np.frombuffer(row["tfs"], np.int32).astype(np.int64)
        length = 100 - 75 + (75 * self.sizes * n_docs) // max(1, n_terms)
        self.parts = (1_000_000_000 * tf) // (1000 * tf + 8 * length[self.docs])

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.firsts[term], self.firsts[term + 1])
        return self.docs[own], self.parts[own]

    def search(self, terms: list[int], factors: np.ndarray, best: Best, at_once: int = 64) -> None:
        """Add this chunk's documents to the best of a query with these distinct terms, mask by mask."""
        found = [(*self.of(t), f) for t, f in zip(terms, factors.tolist())]
        found = [(docs, parts, f) for docs, parts, f in found if len(docs) and f > 0]
        if not found:
            return
        bounds = np.array([int(parts.max()) * f for _, parts, f in found], np.int64)
        if bounds.sum() < best.least:
            return
        distinct, docs, starts = grouped(masks_of([docs for docs, _, _ in found], len(self.doc_ids)))
        bound = np.zeros(len(distinct), np.int64)
        for k, most in enumerate(bounds.tolist()):
            bound += np.where(distinct[:, k // 64] >> U64(k % 64) & U64(1), most, 0)
        order = np.argsort(-bound, kind="stable")
        taken = 0
        while taken < len(order) and bound[order[taken]] >= best.least:
            some = order[taken : taken + at_once]
            some = some[bound[some] >= best.least]
            taken, at_once = taken + len(some), 2 * at_once
            own = np.sort(np.concatenate([docs[starts[g] : starts[g + 1]] for g in some.tolist()]))
            scores = np.zeros(len(own), np.int64)
            for held, parts, f in found:
                at = np.minimum(np.searchsorted(held, own), len(held) - 1)
                scores += np.where(held[at] == own, parts[at] * f, 0)
            best.add(scores, self.missing[own], self.doc_ids[own])


def best_documents(docs: DataFrame, queries: list[list[bytes]], ranking: Ranking) -> DataFrame:
    """number (of the query), doc_id, missing and score: for each query the best of each task, a superset of its best."""
    vocabulary: dict[bytes, int] = {}
    for terms in queries:
        for term in terms:
            vocabulary.setdefault(term, len(vocabulary))
    chunks = postings(docs, vocabulary)
    n_docs, n_terms = chunks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    holders = chunks.select(F.posexplode("df").alias("term", "n")).groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = dict(holders)
    asked = []
    for terms in queries:
        times = Counter(vocabulary[t] for t in terms)
        factors = np.array([n * weight(df.get(t, 0), n_docs) for t, n in times.items()], np.int64)
        asked.append((list(times), factors))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [Best(ranking.top) for _ in asked]
        for batch in batches:
            for k in range(len(batch)):
                chunk = Chunk({c: batch.column(c)[k].as_py() for c in batch.schema.names}, n_docs, n_terms)
                for (terms, factors), best in zip(asked, lists):
                    chunk.search(terms, factors, best)
        counts = [len(best.rows) for best in lists]
        rows = np.concatenate([best.rows for best in lists]) if lists else np.zeros((0, 3), np.int64)
        columns = [
            pa.array(np.repeat(np.arange(len(lists)), counts), pa.int32()),
            pa.array(rows[:, 2], mask=rows[:, 1] > 0),
            pa.array(rows[:, 1] > 0),
            pa.array(rows[:, 0]),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["number", "doc_id", "missing", "score"])

    return chunks.drop("n_docs", "n_terms", "df").mapInArrow(search, HITS)


def ranked(docs: DataFrame, items: DataFrame, ranking: Ranking = Ranking()) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the best documents of each item of ``items`` (item_id, text).

    Scores above 0 only; equal scores by ascending doc_id, rows without one last. Terms are runs of ASCII letters and
    digits and of all other characters, A to Z in lower case. A null text has no terms: as a document it is never found
    and not counted, as an item it finds nothing. Rows of ``docs`` that share a doc_id are documents of their own.
    Repeated items are searched once. No documents or no items give no rows; further columns are not looked at.
    """
    spark = docs.sparkSession
    items = stored(items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").distinct(), "search-items")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / ranking.block_bytes))
    of_block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    order = Window.partitionBy("number").orderBy(F.desc("score"), "missing", "doc_id")
    found = None
    for block in range(blocks):
        own = items.where(of_block == block).collect()  # some block_bytes of queries
        hits = best_documents(docs, [terms_of(row["text"].encode("utf-8", "surrogatepass")) for row in own], ranking)
        hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranking.top)
        ids = spark.createDataFrame([(n, row["item_id"]) for n, row in enumerate(own)], items.select(F.lit(0).alias("number"), "item_id").schema)
        hits = stored(hits.join(ids, "number").select("item_id", "rank", "doc_id", "score"), f"search-block-{block}")
        found = hits if found is None else found.unionByName(hits)
    return found
