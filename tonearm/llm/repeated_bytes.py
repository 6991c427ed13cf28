"""Removal of every byte that a long enough repeated byte string covers, by prefix-free parsing.

1. Parsing. A rolling hash of ``window`` bytes triggers where it is divisible by ``modulus``; a phrase runs from one
   trigger to the end of the next, so phrases overlap by the window and no proper suffix of a phrase longer than the
   window is the prefix of another. A string of ``width`` bytes therefore starts in a phrase's suffix of a fixed length
   and goes on with the same parse wherever it occurs. The starts of a phrase whose strings reach the trigger at its
   end form a segment, ``reach`` starts at most; farther ones form a second segment, and starts of strings that hold no
   trigger at all stand alone.
2. Candidates. A segment's key is a digest of bytes that all its strings hold at a fixed distance from the trigger (the
   bytes behind it, or for the second segment those before it), so equal strings have equal keys. Keys counted once
   are no repeats and go.
3. Copies. A segment's name is a digest of all bytes of its strings. A name that occurs again repeats all its strings.
   Within a document this is seen while parsing, so a text of one period, which may have no trigger at all, gives a
   segment for each place of the period only. From here on a name has one segment.
4. Corpus order. What is left are names that occur once, at the ends of repeats, and the other names of their keys. In
   a key, the suffix array of the dictionary is the order of the phrases read backwards from the trigger, with the
   lengths of the suffixes that neighbours share; the suffix array of the parse is the order of what follows the
   trigger, with the lengths of the prefixes that neighbours share. Both are cut into ranks at each distance; a string
   is repeated where another segment has its pair of ranks.
5. Names of a key are ordered by one task if there are ``group_names`` at most; the strings of larger keys are digested
   and counted one by one instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.files import discard, stored
from tonearm.llm.words import text_chunks

U32 = np.uint32
#: ``place`` holds start, number of starts and distance from the first start to the trigger's end (0: no trigger).
#: Rows without a key are starts whose strings a segment before them in the document has.
SEGMENTS = "row long, place long, key long, name long, copies int"
STRINGS = "key long, row long, place long, copies long, bytes binary"
WINDOWS = "high long, low long, row long, start int, copies long"
CLEANED = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>"


@dataclass(frozen=True)
class Parsing:
    """Bytes of a repeated string, window and modulus of the triggers, bytes from a segment's first start to its
    trigger's end at most, and names of a key that one task orders."""

    width: int = 400
    window: int = 16
    modulus: int = 64
    reach: int = 208
    group_names: int = 4096

    def __post_init__(self) -> None:
        if not self.window < self.reach < self.width:
            raise ValueError("the window must be shorter than the reach, and the reach than the string")
        if self.width >> 16:
            raise ValueError("strings must be shorter than 65536 bytes")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def packed(start: int, n: int, ahead: int) -> int:
    return start << 32 | n << 16 | ahead


def unpacked(place: int) -> tuple[int, int, int]:
    return place >> 32, place >> 16 & 0xFFFF, place & 0xFFFF


def triggers(data: np.ndarray, parsing: Parsing) -> np.ndarray:
    """Places where the hash of the window that starts there is divisible by the modulus."""
    # h(2k) at i is h(k) at i times a power, plus h(k) at i + k; the window is a sum of such powers of two
    spread = (data.astype(U32) + U32(1)) * U32(0x9E3779B1)
    spread ^= spread >> U32(15)
    hashed, length, power = spread, 1, U32(0x85EBCA6B)
    total, covered = np.zeros(len(data) + 1, U32), 0
    left = parsing.window
    while True:
        if left & 1:
            n = max(0, len(data) - covered - length + 1)
            with np.errstate(over="ignore"):
                total = total[:n] * power + hashed[covered : covered + n]
            covered += length
        left >>= 1
        if not left:
            break
        n = max(0, len(hashed) - length)
        with np.errstate(over="ignore"):
            hashed = hashed[:n] * power + hashed[length : length + n]
            power = power * power
        length *= 2
    total = total ^ (total >> U32(16))
    with np.errstate(over="ignore"):
        total = total * U32(0xC2B2AE35)
    return np.flatnonzero((total >> U32(8)) % U32(parsing.modulus) == 0)


def segments(size: int, at: np.ndarray, parsing: Parsing) -> Iterator[tuple[int, int, int]]:
    """First start, number of starts, and distance to the end of the trigger ahead, for all strings of a text.

    The trigger is within reach, or farther but within the string; where the string has none, the distance is 0 and
    there is one start.
    """
    last = size - parsing.width  # the last start
    if last < 0:
        return
    ends = (at[at > 0] + parsing.window).tolist()
    begin = 0
    for end in [*ends, size + parsing.width + 1]:
        stop = min(end - parsing.window, last + 1)  # starts from begin to before stop have this trigger ahead
        lone = min(stop, end - parsing.width)
        for start in range(begin, lone):
            yield start, 1, 0
        far = max(begin, lone)
        near = min(stop, max(far, end - parsing.reach))
        if far < near:
            yield far, near - far, end - far
        if near < stop:
            yield near, stop - near, end - near
        begin = max(begin, stop)
        if begin > last:
            return


def parse(docs: DataFrame, parsing: Parsing) -> DataFrame:
    """The segments of every row of ``docs`` (row, text) with their keys and names; stored.

    A document gives a name once, with its number of copies there; the starts of the others follow without a key.
    """
    behind = parsing.width - parsing.reach

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for first, texts in text_chunks(batch.column(1), 1_000_000):
                rows, places, keys, names, copies = [], [], [], [], []
                again: list[tuple[int, int]] = []  # row and place
                at = triggers(np.frombuffer(b"".join(texts), np.uint8), parsing)
                begin = 0
                for row, text in zip(batch.column(0).slice(first, len(texts)).to_pylist(), texts):
                    low, high = np.searchsorted(at, (begin, begin + len(text) - parsing.window + 1))
                    view = memoryview(text)
                    first_of: dict[tuple[int, int], int] = {}
                    spans: list[list[int]] = []
                    for start, n, ahead in segments(len(text), at[low:high] - begin, parsing):
                        end = start + ahead
                        if not ahead:
                            key = digest(view[start : start + parsing.width], 2)
                        elif ahead > parsing.reach:
                            key = digest(view[end - parsing.reach : end], 1)
                        else:
                            key = digest(view[end - parsing.window : end + behind], 0)
                        name = digest(view[start : start + n - 1 + parsing.width], 3)
                        held = first_of.setdefault((key, name), len(rows))
                        if held < len(rows):
                            copies[held] += 1
                            if spans and sum(spans[-1]) == start and spans[-1][1] + n < 1 << 16:
                                spans[-1][1] += n
                            else:
                                spans.append([start, n])
                            continue
                        rows.append(row)
                        places.append(packed(start, n, ahead))
                        keys.append(key)
                        names.append(name)
                        copies.append(1)
                    again += [(row, packed(start, n, 0)) for start, n in spans]
                    begin += len(text)
                lone = len(again)
                columns = [
                    pa.array(rows + [r for r, _ in again], pa.int64()),
                    pa.array(places + [p for _, p in again], pa.int64()),
                    *(pa.concat_arrays([pa.array(np.array(x, np.uint64).view(np.int64)), pa.nulls(lone, pa.int64())]) for x in (keys, names)),
                    pa.array(copies + [0] * lone, pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row", "place", "key", "name", "copies"])

    return stored(docs.mapInArrow(parsed, SEGMENTS), "segments")


def candidates(found: DataFrame) -> DataFrame:
    """The segments whose key occurs again; stored."""
    found = found.where("key is not null")
    again = found.groupBy("key").agg(F.sum("copies").alias("times")).where("times > 1").select("key")
    return stored(found.join(again, "key").select("key", "name", "row", "place", "copies"), "candidate-segments")


def names_of(found: DataFrame) -> DataFrame:
    """key, name, copies and one segment of every name; stored."""
    one = F.min(F.struct("row", "place")).alias("one")
    names = found.groupBy("key", "name").agg(F.sum("copies").alias("copies"), one)
    return stored(names.select("key", "name", "copies", "one.*"), "segment-names")


def open_names(names: DataFrame) -> DataFrame:
    """The names of keys that have a name occurring once besides others, with the number of names of the key; stored."""
    keys = names.groupBy("key").agg(F.count(F.lit(1)).alias("n_names"), F.min("copies").alias("fewest"))
    keys = keys.where("n_names > 1 and fewest = 1").select("key", "n_names")
    return stored(names.join(keys, "key").select("key", "row", "place", "copies", "n_names"), "open-names")


def with_bytes(docs: DataFrame, wanted: DataFrame, to_rows, schema: str) -> DataFrame:
    """Rows that ``to_rows`` makes of (text, row, wanted segment), for all wanted segments of ``docs`` (row, text)."""
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("key", "place", "copies")).alias("wanted")).withColumnRenamed("row", "wanted_row")
    names = [part.split()[0] for part in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch.column(1), 1_000_000):
                made = []
                lists = batch.column(2).slice(first, len(texts)).to_pylist()
                for row, text, own in zip(batch.column(0).slice(first, len(texts)).to_pylist(), texts, lists):
                    for segment in own:
                        made += to_rows(text, row, segment)
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in made], pa_schema(schema))

    both = docs.join(lists, F.col("row") == F.col("wanted_row")).select("row", "text", "wanted")
    return stored(both.mapInArrow(cut, schema), "segment-bytes")


def pa_schema(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "byte": pa.int8()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def neighbours(parts: list[bytes], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the parts within their keys, and the bytes that each shares with the one before it (-1: another key)."""
    order = np.array(sorted(range(len(parts)), key=lambda i: (keys[i], parts[i])), np.int64)
    shared = np.full(len(parts), -1, np.int64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    wide = int(lengths.max())
    padded = np.frombuffer(b"".join(p.ljust(wide, b"\0") for p in parts), np.uint8).reshape(len(parts), wide)[order]
    differs = padded[1:] != padded[:-1]
    until = np.where(differs.any(axis=1), differs.argmax(axis=1), wide)
    until = np.minimum(until, np.minimum(lengths[order][1:], lengths[order][:-1]))
    key = np.array(keys, np.int64)[order]
    shared[1:] = np.where(key[1:] == key[:-1], until, -1)
    return order, shared


def repeated_starts(keys: list[int], places: list[int], copies: list[int], strings: list[bytes], parsing: Parsing) -> list[tuple[int, int]]:
    """(segment, start) of the strings that another segment of the key has.

    A string that starts d bytes before the trigger's
    end is its phrase's suffix of d bytes and width - d bytes behind. Two are equal if no neighbour between them in the
    dictionary's order shares fewer than d bytes, and none in the parse's order fewer than width - d.
    """
    starts, counts, anchors = (np.array(x, np.int64) for x in zip(*map(unpacked, places)))
    once = np.array(copies, np.int64) == 1
    before = [s[:a][::-1] for s, a in zip(strings, anchors.tolist())]
    behind = [s[a:] for s, a in zip(strings, anchors.tolist())]
    dictionary, shared_suffix = neighbours(before, keys)
    parse_, shared_prefix = neighbours(behind, keys)
    left, right = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    most, fewest = anchors, anchors - counts + 1  # distances of a segment's first and last start
    by_most = np.argsort(-most, kind="stable")
    found = []
    for d in range(int(fewest.min()), int(most.max()) + 1):
        own = by_most[: np.searchsorted(-most[by_most], -d, "right")]
        own = own[fewest[own] <= d]
        if len(own) < 2:
            continue
        left[dictionary] = np.cumsum(shared_suffix < d)
        right[parse_] = np.cumsum(shared_prefix < parsing.width - d)
        _, number = np.unique(left[own] * (len(keys) + 1) + right[own], return_inverse=True)
        again = np.bincount(number)[number] > 1
        again &= once[own]  # names that occur again are repeated already
        found += [(s, int(starts[s] + most[s] - d)) for s in own[again].tolist()]
    return found


def runs(found: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(segment, first start, number) of starts that follow each other."""
    found.sort()
    first = 0
    for k in range(1, len(found) + 1):
        if k == len(found) or found[k][0] != found[k - 1][0] or found[k][1] != found[k - 1][1] + 1:
            yield found[first][0], found[first][1], k - first
            first = k


def ordered(strings: DataFrame, parsing: Parsing, at_once: int = 8_000_000) -> DataFrame:
    """row, start and n of repeated starts, found by ordering the segments of each key."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def close() -> pa.RecordBatch:
            made = []
            if held:
                found = repeated_starts([r["key"] for r in held], [r["place"] for r in held], [r["copies"] for r in held], [r["bytes"] for r in held], parsing)
                made = [{"row": held[s]["row"], "start": start, "n": n} for s, start, n in runs(found)]
            return pa.RecordBatch.from_pylist(made, pa_schema("row long, start int, n int"))

        for batch in batches:
            for k in range(0, len(batch), 1000):
                for row in batch.slice(k, 1000).to_pylist():
                    if size >= at_once and row["key"] != held[-1]["key"]:
                        yield close()
                        held.clear()
                        size = 0
                    held.append(row)
                    size += len(row["bytes"])
        yield close()

    by_key = strings.repartition("key").sortWithinPartitions("key")
    return by_key.mapInArrow(search, "row long, start int, n int")


def counted(windows: DataFrame) -> DataFrame:
    """row, start and n of repeated starts, found by counting the digests of their strings."""
    one = F.min(F.struct("row", "start")).alias("one")
    sums = windows.groupBy("high", "low").agg(F.sum("copies").alias("times"), F.count(F.lit(1)).alias("rows"), one)
    again = sums.where("rows > 1").select("high", "low")
    return windows.where("copies = 1").join(again, ["high", "low"]).select("row", "start", F.lit(1).alias("n"))


def repeated_spans(docs: DataFrame, parsing: Parsing) -> DataFrame:
    """row and spans (first start, number of starts) of the strings of ``docs`` (row, text) that occur again; stored."""
    width = parsing.width

    def string(text: bytes, row: int, segment: dict) -> list[tuple]:
        start, n, _ = unpacked(segment["place"])
        return [(segment["key"], row, segment["place"], segment["copies"], text[start : start + n - 1 + width])]

    def each_string(text: bytes, row: int, segment: dict) -> list[tuple]:
        first, n, _ = unpacked(segment["place"])
        digests = [xxhash.xxh3_128_intdigest(text[k : k + width]) for k in range(first, first + n)]
        return [(signed(d >> 64), signed(d & (1 << 64) - 1), row, first + k, segment["copies"]) for k, d in enumerate(digests)]

    every = parse(docs, parsing)
    found = candidates(every)
    within = stored(every.where("key is null").select("row", "place"), "repeats-within")
    discard(every)
    names = names_of(found)
    copied = found.join(names.where("copies > 1").select("key", "name"), ["key", "name"])
    copied = copied.select("row", "place").unionByName(within).select(
        "row", F.shiftright("place", 32).cast("int").alias("start"), (F.shiftright("place", 16) % 65536).cast("int").alias("n")
    )
    wanted = open_names(names)
    small = with_bytes(docs, wanted.where(F.col("n_names") <= parsing.group_names), string, STRINGS)
    large = wanted.where(F.col("n_names") > parsing.group_names)
    spans = copied.unionByName(ordered(small, parsing))
    if not large.isEmpty():
        spans = spans.unionByName(counted(with_bytes(docs, large, each_string, WINDOWS)))
    lists = spans.groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return stored(lists, "repeated-spans")


def covered(spans: list[dict], width: int) -> list[tuple[int, int]]:
    """Maximal stretches of bytes that the strings starting in ``spans`` cover."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["start"] + s["n"] - 1 + width) for s in spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def remove_repeated(docs: DataFrame, parsing: Parsing = Parsing()) -> DataFrame:
    """doc_id, kept (the bytes left), n_bytes, n_removed and the spans removed, in offsets of the original bytes.

    One row per row of ``docs`` (doc_id, text); rows that share a doc_id or are equal are documents of their own, so an
    equal row of enough bytes is removed throughout. A null text counts as empty and keeps nothing; a null doc_id stays
    null. No documents give no rows; further columns are not looked at.
    """
    width = parsing.width
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(source.withColumn("row", F.monotonically_increasing_id()), "numbered-documents")
    spans = repeated_spans(rows.select("row", "text"), parsing)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch.column(1), 1_000_000):
                kept, removed, gone = [], [], []
                for text, own in zip(texts, batch.column(2).slice(first, len(texts)).to_pylist()):
                    own = covered(own or [], width)
                    parts, at = [], 0
                    for start, end in own:
                        parts.append(text[at:start])
                        at = end
                    kept.append(b"".join([*parts, text[at:]]))
                    removed.append(sum(end - start for start, end in own))
                    gone.append([{"start": start, "end": end} for start, end in own])
                columns = [
                    batch.column(0).slice(first, len(texts)),
                    pa.array(kept, pa.binary()),
                    pa.array(list(map(len, texts)), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(gone, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kept", "n_bytes", "n_removed", "spans"])

    both = rows.join(spans.withColumnRenamed("row", "span_row"), F.col("row") == F.col("span_row"), "left")
    return both.select("doc_id", "text", "spans").mapInArrow(clean, CLEANED)
