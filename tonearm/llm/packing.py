"""Documents packed into sequences of bounded length by the sum-of-squares rule.

Documents are cut only where they are longer than a sequence. Pieces shorter than a sequence are dealt into groups of a
few thousand, each packed by one task: of all gaps that take a piece, it goes to the one after which the sum of squares
of the numbers of open sequences per gap is smallest; pieces come in descending length. Sequences left with a wide gap
are taken apart again and their pieces, of all groups, packed in a next round with fewer groups.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.files import stored
from tonearm.llm.token_store import bits_for, pack, unpack
from tonearm.llm.words import TOKEN_CHUNK, releasing, text_chunks, token_encoder

GROUP_PIECES = 8192
ROUNDS = 4
PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long"


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the gap each bin is left with.

    Placing a length s into a gap g takes one from the count of g and adds one to that of g - s, which changes the sum
    of squares by 2 (n[g-s] - n[g] + 1), or by 1 - 2 n[g] where the bin is filled; a new bin changes it by
    2 n[capacity-s] + 1. Ties go to the smallest gap, and to an open bin before a new one.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_at = np.zeros(capacity + 1, np.int64)
    stacks: dict[int, list[int]] = {}
    gaps: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = np.flatnonzero(open_at[size:])
        place = -1
        if len(fitting):
            left = 2 * (open_at[fitting] + 1)
            if fitting[0] == 0:
                left[0] = 1
            change = left - 2 * open_at[size + fitting]
            best = int(change.argmin())
            if change[best] <= 2 * open_at[capacity - size] + 1:
                place = int(fitting[best]) + size
        if place < 0:
            number, place = len(gaps), capacity
            gaps.append(capacity)
        else:
            number = stacks[place].pop()
            open_at[place] -= 1
        bins[i], offsets[i] = number, capacity - place
        gap = gaps[number] = place - size
        if gap:
            stacks.setdefault(gap, []).append(number)
            open_at[gap] += 1
    return bins, offsets, np.array(gaps, np.int64)


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, vocabulary: int, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` ids with their ids packed to the vocabulary's bits, if asked for; stored.

    Every document ends with ``end_id``; a null text counts as empty and is that id alone. ``piece_row`` numbers the
    rows of the table, so that rows which repeat a doc_id stay apart.
    """
    bits = bits_for(max(vocabulary, end_id + 1))
    names = ["doc_id", "piece", "start", "length", "ids", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_encoder(tokenizer, end_id)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, texts in text_chunks(batch.column(1), TOKEN_CHUNK):
                ids, sizes = encoder.encode(texts)
                ends = np.cumsum(sizes).tolist()
                rows = []
                for k, (size, end) in enumerate(zip(sizes.tolist(), ends)):
                    for piece, start in enumerate(range(0, size, capacity)):
                        own = ids[end - size + start : min(end, end - size + start + capacity)]
                        sum_ = zlib.crc32(np.ascontiguousarray(own, "<u4"))
                        rows.append((doc_ids[first + k], piece, start, len(own), pack(own, bits) if with_ids else None, sum_))
                columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, names)

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(releasing(pieces), PIECES)
    return stored(own.withColumn("piece_row", F.monotonically_increasing_id()), "token-pieces")


def place(
    pieces: DataFrame, capacity: int, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS, gap_share: float = 0.004
) -> DataFrame:
    """piece_row, sequence_id and offset of every piece of ``pieces`` (piece_row, length up to ``capacity``).

    Pieces that fill a sequence are one. Groups are hashes of piece_row, so equal lengths or doc_ids do not meet in
    one; their number follows the number of pieces. Every round is stored; only its number of loose pieces reaches the
    driver. A round's sequences count if their gap is at most ``gap_share`` of the capacity; in the last round all do.
    """
    widest = int(capacity * gap_share)

    def packer(base: int, width: int, last: bool):
        def packed(table: pa.Table) -> pa.Table:
            bins, offsets, gaps = sum_of_squares(table["length"].to_numpy(), capacity)
            return pa.table(
                {
                    "piece_row": table["piece_row"],
                    "length": table["length"],
                    "sequence_id": pa.array(base + table["group"][0].as_py() * width + bins),
                    "offset": pa.array(offsets),
                    "closed": pa.array((gaps[bins] <= widest) | last),
                }
            )

        return packed

    full = pieces.where(F.col("length") == capacity).select(
        "piece_row", (-1 - F.col("piece_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    done, loose = [full], pieces.where(F.col("length") < capacity).select("piece_row", "length")
    count, before = loose.count(), 0
    for round_ in range(rounds):
        if not count:
            break
        groups = max(1, math.ceil(count / group_pieces))
        last = round_ == rounds - 1 or groups == before == 1
        before = groups
        width = (1 << 60) // groups // rounds

        dealt = loose.withColumn("group", F.pmod(F.xxhash64("piece_row", F.lit(round_)), F.lit(groups)))
        schema = "piece_row long, length long, sequence_id long, offset long, closed boolean"
        result = stored(dealt.groupBy("group").applyInArrow(packer(round_ * groups * width, width, last), schema), f"packing-round-{round_}")
        done.append(result.where("closed").select("piece_row", "sequence_id", "offset"))
        loose = result.where("not closed").select("piece_row", "length")
        count = loose.count()
    return reduce(DataFrame.unionByName, done)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, capacity: int = 2048, with_ids: bool = True
) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): where it comes from, its ids, and its place in a sequence.

    ``ids`` are packed to the bits of the vocabulary; ``ids_crc32`` is the checksum of the ids in 32 bits each. A
    repeated row is packed each time, a null doc_id stays null, no documents give no pieces, and further columns are
    not looked at.
    """
    pieces = cut(docs, tokenizer, end_id, capacity, vocabulary, with_ids)
    placed = place(pieces.select("piece_row", "length"), capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    return pieces.select("piece_row", *columns).join(placed, "piece_row").drop("piece_row")


def sequences(packed: DataFrame, vocabulary: int) -> DataFrame:
    """One row per sequence: its ids, and the doc_id and first place of each document in it."""
    bits = bits_for(vocabulary)

    def join_ids(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        ids = [unpack(d, n, bits) for d, n in zip(table["ids"].to_pylist(), table["length"].to_pylist())]
        return pa.table(
            {
                "sequence_id": table["sequence_id"].slice(0, 1),
                "ids": pa.array([np.concatenate(ids).astype(np.int32)], pa.list_(pa.int32())),
                "doc_ids": pa.array([table["doc_id"].to_pylist()], pa.list_(pa.int64())),
                "offsets": pa.array([table["offset"].to_pylist()], pa.list_(pa.int64())),
            }
        )

    return packed.groupBy("sequence_id").applyInArrow(
        join_ids, "sequence_id long, ids array<int>, doc_ids array<long>, offsets array<long>"
    )
