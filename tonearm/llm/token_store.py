"""Token ids in files of fixed-width fields, with random access.

A file holds ids packed with the smallest number of bits that takes the whole vocabulary, in blocks of a fixed number
of ids; a block begins at a byte. Behind the blocks lie the documents (ids and first token of each), the offsets of the
blocks and a trailer, all little-endian:

    header    8 bytes of magic, uint32 bits, uint32 ids in a block
    blocks    ids, first id in the lowest bits
    documents int64 id each, uint8 "has an id" each, int64 first token each and one more for the end
    offsets   int64 of each block and one more for the end
    trailer   int64 ids, documents, blocks, place of the documents, place of the offsets; 8 bytes of magic

Every task writes files of its own under names of its own; the manifest that Spark commits says which files count, so
a task that ran twice after the loss of an executor leaves no ids twice.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.files import new_file, one_task_per_file, open_input, open_output, stored
from tonearm.llm.words import TOKEN_CHUNK, releasing, text_chunks, token_encoder
from tonearm.session import working_folder

MAGIC = b"TOKBITS1"
BLOCK_IDS = 65_536
FILE_IDS = 1 << 27
MANIFEST = "part int, number int, path string, n_docs long, n_tokens long"
DOCUMENT_DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
DOCUMENT_IDS = "doc_id long, start long, ids array<int>"


def bits_for(vocabulary: int) -> int:
    """The smallest width that takes ids 0 to ``vocabulary`` - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in fields of ``bits`` bits; the last byte is filled with zeros."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return raw[:, : bits // 8].tobytes()
    fields = np.unpackbits(raw, axis=1, count=bits, bitorder="little")
    return np.packbits(fields, bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of packed data."""
    raw = np.frombuffer(data, np.uint8)
    full = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        full[:, : bits // 8] = raw[: count * bits // 8].reshape(count, bits // 8)
    else:
        fields = np.unpackbits(raw, count=count * bits, bitorder="little").reshape(count, bits)
        packed = np.packbits(fields, axis=1, bitorder="little")
        full[:, : packed.shape[1]] = packed
    return full.view("<u4").ravel()


class TokenWriter:
    """Writes one file, holding no more than a block of ids and the places of the documents."""

    def __init__(self, path: str, bits: int, block_ids: int = BLOCK_IDS) -> None:
        self.path, self.bits, self.block_ids = path, bits, block_ids
        self.out = open_output(path)
        self.place = 0
        self.offsets: list[int] = []
        self.held = np.zeros(0, np.uint32)
        self.docs: list[np.ndarray] = []
        self.known: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.n_tokens = 0
        self._put(MAGIC + np.array([bits, block_ids], "<u4").tobytes())

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.place += len(data)

    def _block(self, ids: np.ndarray) -> None:
        self.offsets.append(self.place)
        self._put(pack(ids, self.bits))

    def add(self, doc_ids: np.ndarray, known: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"an id needs more than {self.bits} bits")
        self.docs.append(doc_ids.astype("<i8"))
        self.known.append(known.astype(np.uint8))
        self.sizes.append(sizes)
        self.n_tokens += len(ids)
        self.held = np.concatenate([self.held, ids])
        whole = len(self.held) // self.block_ids * self.block_ids
        for first in range(0, whole, self.block_ids):
            self._block(self.held[first : first + self.block_ids])
        self.held = self.held[whole:]

    def close(self) -> tuple[str, int, int]:
        if len(self.held):
            self._block(self.held)
        self.offsets.append(self.place)
        documents = self.place
        sizes = np.concatenate([np.zeros(1, np.int64), *self.sizes])
        self._put(np.concatenate([np.zeros(0, "<i8"), *self.docs]).tobytes())
        self._put(np.concatenate([np.zeros(0, np.uint8), *self.known]).tobytes())
        self._put(np.cumsum(sizes).astype("<i8").tobytes())
        offsets = self.place
        self._put(np.array(self.offsets, "<i8").tobytes())
        counts = [self.n_tokens, len(sizes) - 1, len(self.offsets) - 1, documents, offsets]
        self._put(np.array(counts, "<i8").tobytes() + MAGIC)
        self.out.close()
        return self.path, len(sizes) - 1, self.n_tokens


class TokenReader:
    """Random access to a file: any run of ids, any document."""

    def __init__(self, path: str) -> None:
        self.file = open_input(path)
        end = self.file.size()
        head, tail = self._at(0, 16), self._at(max(0, end - 48), 48)
        if head[:8] != MAGIC or tail[40:] != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        self.bits, self.block_ids = (int(x) for x in np.frombuffer(head[8:], "<u4"))
        self.n_tokens, self.n_docs, n_blocks, documents, offsets = (int(x) for x in np.frombuffer(tail[:40], "<i8"))
        n = self.n_docs
        self.doc_ids = np.frombuffer(self._at(documents, 8 * n), "<i8")
        self.known = np.frombuffer(self._at(documents + 8 * n, n), np.uint8).astype(bool)
        self.starts = np.frombuffer(self._at(documents + 9 * n, 8 * (n + 1)), "<i8")
        self.offsets = np.frombuffer(self._at(offsets, 8 * (n_blocks + 1)), "<i8")

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def block(self, number: int) -> np.ndarray:
        data = self._at(int(self.offsets[number]), int(self.offsets[number + 1] - self.offsets[number]))
        return unpack(data, min(self.block_ids, self.n_tokens - number * self.block_ids), self.bits)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` - 1 of the file, reading only the blocks that hold them."""
        if first >= last:
            return np.zeros(0, np.uint32)
        low = first // self.block_ids
        blocks = [self.block(k) for k in range(low, (last - 1) // self.block_ids + 1)]
        return np.concatenate(blocks)[first - low * self.block_ids : last - low * self.block_ids]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))

    def runs(self, at_once: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """First and last document and the ids of runs of documents with about ``at_once`` ids."""
        first = 0
        while first < self.n_docs:
            limit = int(self.starts[first]) + at_once
            last = max(first + 1, int(np.searchsorted(self.starts, limit, "right")) - 1)
            last = min(last, self.n_docs)
            yield first, last, self.ids(int(self.starts[first]), int(self.starts[last]))
            first = last

    def close(self) -> None:
        self.file.close()


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, folder: str, file_ids: int = FILE_IDS
) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order; returns the manifest, stored.

    Files follow each other by (part, number). A null text counts as empty and gives the end id alone. Null doc_ids
    come first; rows of one doc_id follow each other in the order of their texts' hashes, and since the hash is part of
    the range key, many rows of one doc_id may lie in several files. No rows give a manifest of no rows.
    """
    bits = bits_for(max(vocabulary, end_id + 1))
    text = F.coalesce("text", F.lit(""))
    ordered = (
        docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_encoder(tokenizer, end_id)
        writer, rows = None, []
        for batch in batches:
            doc_ids = batch.column(0)
            known = ~np.asarray(doc_ids.is_null())
            values = np.asarray(doc_ids.fill_null(0))
            for first, texts in text_chunks(batch.column(1), TOKEN_CHUNK):
                ids, sizes = encoder.encode(texts)
                writer = writer or TokenWriter(new_file(folder, ".tok"), bits)
                own = slice(first, first + len(texts))
                writer.add(values[own], known[own], ids, sizes)
                if writer.n_tokens >= file_ids:
                    rows.append(writer.close())
                    writer = None
        if writer:
            rows.append(writer.close())
        part = TaskContext.get().partitionId()
        columns = [[part] * len(rows), list(range(len(rows))), *([r[k] for r in rows] for k in range(3))]
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        names = ["part", "number", "path", "n_docs", "n_tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return stored(ordered.mapInArrow(releasing(write), MANIFEST), "token-manifest")


def _files(manifest: DataFrame) -> DataFrame:
    """Path and number of ids before each file; one row a file, so the running sum stays small."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start")
    return one_task_per_file(manifest.select("path", starts))


def token_digests(manifest: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens and ids_crc32 of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = TokenReader(path)
                for first, last, ids in reader.runs():
                    cuts = reader.starts[first : last + 1]
                    data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                    places = (4 * (cuts - cuts[0])).tolist()
                    sums = [zlib.crc32(data[a:b]) for a, b in zip(places, places[1:])]
                    columns = [
                        pa.array(reader.doc_ids[first:last], mask=~reader.known[first:last]),
                        pa.array(start + cuts[:-1]),
                        pa.array(np.diff(cuts)),
                        pa.array(sums, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
                reader.close()

    return _files(manifest).mapInArrow(read, DOCUMENT_DIGESTS)


def token_documents(manifest: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start and ids of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = TokenReader(path)
                for first, last, ids in reader.runs():
                    cuts = reader.starts[first : last + 1]
                    columns = [
                        pa.array(reader.doc_ids[first:last], mask=~reader.known[first:last]),
                        pa.array(start + cuts[:-1]),
                        pa.ListArray.from_arrays(pa.array((cuts - cuts[0]).astype(np.int32)), pa.array(ids.astype(np.int32))),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "ids"])
                reader.close()

    return _files(manifest).mapInArrow(read, DOCUMENT_IDS)


def token_folder(docs: DataFrame) -> str:
    return working_folder(docs.sparkSession, "token-files")
