"""Passages that earlier documents have already, removed unit by unit.

Units are lines, and the sentences of lines that have several. Neighbours too short to be compared alone are compared
together, from each place on. Units are normalised and digested; over all documents the digest's smallest doc_id keeps
it, and within a document its first place. A repeated line goes whatever its length; sentences inside a line only in
runs with enough words, so a single repeated sentence stays in the line it belongs to.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.llm.files import stored

#: A unit ends behind these.
UNIT_END = re.compile(r"[.!?]+\s+|[。！？]+\s*|\n+")
#: Signs of scripts written without blanks between words (Thai to Tibetan, Burmese, Khmer, kana, Han).
UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
#: Two such signs count as a word.
WORDS = re.compile(f"[{UNSPACED}]{{1,2}}|[^\\s{UNSPACED}]+")
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
REWRITTEN = "doc_id long, text string, n_removed long, removed array<struct<start:long,end:long>>"


@dataclass(frozen=True)
class Repeats:
    """Words a unit needs to be compared, and words of a run of sentences inside lines that is removed."""

    unit_words: int = 4
    run_words: int = 30


class Piece(NamedTuple):
    """A sentence or the rest of a line."""

    start: int
    end: int
    words: list[str]
    line: int


class Unit(NamedTuple):
    """Pieces ``first`` to before ``last`` of a text that are compared as one; whole lines or part of one."""

    first: int
    last: int
    words: list[str]
    whole: bool


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower()) if HAS_UNSPACED.search(text) else text.lower().split()


def pieces_of(text: str) -> list[Piece]:
    """Pieces follow each other without a gap; offsets count code points."""
    found, start, line = [], 0, 0
    for end in [m.end() for m in UNIT_END.finditer(text)] + [len(text)]:
        if end > start:
            found.append(Piece(start, end, words_of(text[start:end]), line))
            line += "\n" in text[start:end]
            start = end
    return found


def joined(spans: list[tuple[int, int, list[str]]], least: int, whole: bool) -> Iterator[Unit]:
    """Each span with as many of those behind it as it takes to reach ``least`` words; at the end, of those before it."""
    for k, (first, last, words) in enumerate(spans):
        ahead, back = k + 1, k
        if len(words) < least:
            if not words:
                continue
            words = list(words)
            while len(words) < least and ahead < len(spans):
                words += spans[ahead][2]
                last = spans[ahead][1]
                ahead += 1
            while len(words) < least and back > 0:
                back -= 1
                words = spans[back][2] + words
                first = spans[back][0]
        if len(words) >= least:
            yield Unit(first, last, words, whole)


def compared(pieces: list[Piece], rules: Repeats) -> list[Unit]:
    """The units of a text in the order of their first piece, lines before the sentences in them."""
    lines, sentences = [], []
    for _, own in groupby(range(len(pieces)), lambda k: pieces[k].line):
        own = list(own)
        words = [w for k in own for w in pieces[k].words]
        lines.append((own[0], own[-1] + 1, words))
        if len(own) > 1 and len(words) >= rules.unit_words:
            sentences += joined([(k, k + 1, pieces[k].words) for k in own], rules.unit_words, False)
    return sorted([*joined(lines, rules.unit_words, True), *sentences], key=lambda u: (u.first, not u.whole))


def units(text: str, rules: Repeats = Repeats()) -> list[tuple[int, int, list[str]]]:
    """Start, end and words of each unit that is compared; lines overlap their sentences, and joined units each other."""
    pieces = pieces_of(text)
    return [(pieces[u.first].start, pieces[u.last - 1].end, u.words) for u in compared(pieces, rules)]


def digest(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))


def text_key(doc_id: Column, text: Column) -> Column:
    return F.when(doc_id.isNull(), F.xxhash64(text))


def unit_digests(docs: DataFrame, rules: Repeats) -> DataFrame:
    """doc_id, text_key and digest of the distinct units of each document; stored.

    text_key tells rows without a doc_id apart and is null for all others.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, keys, found = [], [], []
            for doc_id, text, key in zip(*(batch.column(k).to_pylist() for k in range(3))):
                own = {digest(words) for _, _, words in units(text or "", rules)}
                doc_ids += [doc_id] * len(own)
                keys += [key] * len(own)
                found += own
            columns = [pa.array(doc_ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "digest"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key(F.col("doc_id"), F.col("text")))
    return stored(rows.mapInArrow(digests, "doc_id long, text_key long, digest binary"), "unit-digests")


def later_units(found: DataFrame) -> DataFrame:
    """doc_id, text_key and the digests of its units that a smaller doc_id has too; stored.

    The smallest doc_id is an aggregate, so a unit that a third of all documents have reaches its reducer as one row a
    task, and adaptive execution splits it where it is joined back. The list of a document is no longer than its text.
    """
    first = found.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    repeated = first.where("n > 1 and first_id is not null").select("digest", "first_id")
    later = found.join(repeated, "digest").where("doc_id is null or doc_id <> first_id")
    return stored(later.groupBy("doc_id", "text_key").agg(F.collect_set("digest").alias("digests")), "later-units")


def removed_spans(text: str, later: set[bytes], rules: Repeats) -> list[tuple[int, int]]:
    """Spans of the repeated lines, and of the runs of repeated units that are long enough."""
    pieces = pieces_of(text)
    again, gone = [False] * len(pieces), [False] * len(pieces)
    seen: dict[bytes, int] = {}  # digest → last piece of its first place
    for unit in compared(pieces, rules):
        key = digest(unit.words)
        # a place that overlaps the first one is no repeat of it
        if key in later or seen.setdefault(key, unit.last) <= unit.first:
            again[unit.first : unit.last] = [True] * (unit.last - unit.first)
            if unit.whole:
                gone[unit.first : unit.last] = [True] * (unit.last - unit.first)

    def close(start: int, end: int) -> None:
        if sum(len(p.words) for p in pieces[start:end]) >= rules.run_words:
            gone[start:end] = [True] * (end - start)

    start = end = -1  # of the run so far; short pieces between repeated ones belong to it
    for k, piece in enumerate(pieces):
        if again[k]:
            start, end = (k if start < 0 else start), k + 1
        elif start >= 0 and len(piece.words) >= rules.unit_words:
            close(start, end)
            start = -1
    if start >= 0:
        close(start, end)

    spans: list[tuple[int, int]] = []
    for k, piece in enumerate(pieces):
        if gone[k]:
            if spans and spans[-1][1] == piece.start:
                spans[-1] = (spans[-1][0], piece.end)
            else:
                spans.append((piece.start, piece.end))
    return spans


def without(text: str, spans: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return "".join([*kept, text[at:]])


def remove_repeats(docs: DataFrame, rules: Repeats = Repeats()) -> DataFrame:
    """doc_id, text without its repeated passages, and the spans removed, in offsets of the original text.

    One row per row of ``docs``. Rows of one doc_id are one document: none of them is a repeat of the other. A row
    without a doc_id comes after all others. A null text stays null; a text that repeats others throughout becomes
    empty. No documents give no rows; further columns are not looked at.
    """
    later = later_units(unit_digests(docs, rules))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text, digests in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = removed_spans(text, set(digests or ()), rules) if text else []
                spans.append([{"start": a, "end": b} for a, b in own])
                texts.append(without(text, own) if own else text)
            columns = [
                batch.column(0),
                pa.array(texts, pa.string()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array(spans, SPANS),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_removed", "removed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    later = later.select(F.col("doc_id").alias("later_id"), F.col("text_key").alias("later_key"), "digests")
    key = text_key(F.col("doc_id"), F.col("text"))
    same = F.col("doc_id").eqNullSafe(F.col("later_id")) & key.eqNullSafe(F.col("later_key"))
    joined = rows.join(later, same, "left").select("doc_id", "text", "digests")
    return joined.mapInArrow(rewrite, REWRITTEN)
