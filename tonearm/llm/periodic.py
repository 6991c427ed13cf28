"""Periodic runs of words: found by splitting at rare words, then by comparing what is left with itself at every lag.

A run of period q has 2q words or more, so each word in it occurs there at least twice. A word that occurs once within
a segment is in no run of it and splits it. The parts are counted anew, until no segment has such a word; parts shorter
than a run are dropped. Only what is left is scanned lag by lag.

A lag's run of r equal places holds a whole block of places from a multiple of r // 2 on, so a lag is sampled at these
places only: hashes of four words at the block's two ends are compared for all lags at once, and places where both agree
are extended word by word, exactly. All lags of a segment of S words take some S log S comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.words import text_chunks

U64 = np.uint64
GRAM = 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


@dataclass(frozen=True)
class Periods:
    """Words a run has at least; it also has two periods at least."""

    least: int = 12

    def __post_init__(self) -> None:
        if self.least < 2 * GRAM:
            raise ValueError(f"runs of fewer than {2 * GRAM} words cannot be sampled by {GRAM} words")

    def equal_places(self, lag: np.ndarray) -> np.ndarray:
        """Consecutive places that equal those a lag behind them, in a run of that period."""
        return np.maximum(self.least - lag, lag)


def segments(words: np.ndarray, doc_starts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of ``words``, each within one document, in which every word occurs twice or more."""
    stable: list[tuple[int, int]] = []
    lengths = np.diff(np.append(doc_starts, len(words)))
    starts, lengths = doc_starts[lengths >= least], lengths[lengths >= least]
    kinds = int(words.max()) + 1 if len(words) else 1
    while len(starts):
        owner = np.repeat(np.arange(len(starts)), lengths)
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
        _, number, count = np.unique(owner * kinds + words[places], return_inverse=True, return_counts=True)
        rare = count[number] == 1
        split = np.bincount(owner, rare, len(starts)) > 0
        stable += zip(starts[~split].tolist(), (starts + lengths)[~split].tolist())
        left = ~rare & split[owner]
        places, owner = places[left], owner[left]
        if not len(places):
            break
        first = np.flatnonzero(np.concatenate([[True], (np.diff(places) != 1) | (np.diff(owner) != 0)]))
        starts, lengths = places[first], np.diff(np.append(first, len(places)))
        starts, lengths = starts[lengths >= least], lengths[lengths >= least]
    return sorted(stable)


def agree(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The widest stretch of places around ``at`` that equal those ``lag`` behind them."""
    first, last, step = at, at, 64
    while last < len(words) - lag:
        end = min(last + step, len(words) - lag)
        other = np.flatnonzero(words[last:end] != words[last + lag : end + lag])
        if len(other):
            last += int(other[0])
            break
        last, step = end, 2 * step
    step = 64
    while first > 0:
        begin = max(0, first - step)
        other = np.flatnonzero(words[begin:first] != words[begin + lag : first + lag])
        if len(other):
            first = begin + int(other[-1]) + 1
            break
        first, step = begin, 2 * step
    return first, last


def lag_scan(words: np.ndarray, rules: Periods, at_once: int = 1_000_000) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of every run of one segment, by start and period."""
    size = len(words)
    spread = (words.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15)
    spread ^= spread >> U64(31)
    gram = np.zeros(max(0, size - GRAM + 1), U64)
    for k in range(GRAM):
        gram = gram * U64(0xC2B2AE3D27D4EB4F) + spread[k : k + len(gram)]
    found: dict[tuple[int, int], int] = {}
    low = 1
    while low <= size // 2:
        # the lags from here on whose samples are not too many together
        lags = np.arange(low, min(size // 2, low + max(1, at_once * max(1, low // 2) // size)) + 1)
        low = int(lags[-1]) + 1
        equal = rules.equal_places(lags)
        step = equal // 2
        block = equal - step + 1
        count = np.maximum(0, (size - lags - block) // step + 1)
        lag, step, block = (np.repeat(x, count) for x in (lags, step, block))
        at = (np.arange(len(lag)) - np.repeat(np.cumsum(count) - count, count)) * step
        for half in (0, 2, 1):
            inner = (block - GRAM) * half // 2
            same = gram[at + inner] == gram[at + inner + lag]
            at, lag, block = at[same], lag[same], block[same]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        while len(at):
            place, period = int(at[0]), int(lag[0])
            first, last = agree(words, place, period)
            end = last + period
            if last - first >= int(rules.equal_places(np.int64(period))):
                period = found.setdefault((first, end), period)
                # at a multiple of its period, places inside this run give the same run again
                inside = (lag % period == 0) & (at >= first) & (at + lag < end)
            else:
                inside = (lag == period) & (at >= first) & (at < max(last, place + 1))
            at, lag = at[~inside], lag[~inside]
    return sorted((start, end - start, period) for (start, end), period in found.items())


def runs_of(words: np.ndarray, doc_starts: np.ndarray, rules: Periods) -> list[list[tuple[int, int, int]]]:
    """The runs of each document, in places of that document."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in doc_starts]
    for start, end in segments(words, doc_starts, rules.least):
        doc = int(np.searchsorted(doc_starts, start, "right")) - 1
        begin = start - int(doc_starts[doc])
        found[doc] += [(begin + a, n, q) for a, n, q in lag_scan(words[start:end], rules)]
    return found


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def dropped_words(runs: list[tuple[int, int, int]], n_words: int) -> np.ndarray:
    """Which words a run repeats: all but its first period."""
    change = np.zeros(n_words + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def periodic_runs(docs: DataFrame, rules: Periods = Periods()) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and collapsed, the words that no run repeats joined by blanks.

    One row per row of ``docs`` (doc_id, text), repeated ones too; a null doc_id stays null. Words are cut at ASCII
    white space. A null text has no words, no runs and collapses to an empty text, as do texts without words. Of runs
    that overlap, each is given; runs are ordered by start and period. No documents give no rows; further columns are
    not looked at.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                numbers = _Numbers()
                split = [text.split() for text in texts]
                counts = np.fromiter(map(len, split), np.int64, len(split))
                total = int(counts.sum())
                words = np.fromiter((numbers[w] for own in split for w in own), np.int64, total)
                starts = np.cumsum(counts) - counts
                # documents without words have no start of their own
                filled = np.flatnonzero(counts)
                found: list[list[tuple[int, int, int]]] = [[] for _ in split]
                for k, runs in zip(filled.tolist(), runs_of(words, starts[filled], rules)):
                    found[k] = runs
                collapsed = []
                for own, runs in zip(split, found):
                    if runs:
                        own = [own[i] for i in np.flatnonzero(~dropped_words(runs, len(own))).tolist()]
                    collapsed.append(b" ".join(own))
                flat = [run for runs in found for run in runs]
                columns = [pa.array([run[c] for run in flat], pa.int64()) for c in range(3)]
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, fields=list(RUN))),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, FOUND)
