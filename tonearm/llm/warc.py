"""Web archives: pages written as WARC records, and a sequential reader.

One gzip member holds one record. A page whose payload another page with a larger page_id has too is written as a
revisit: the HTTP headers, which give the length of the payload, and the payload's digest, but not the payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.files import new_file, one_task_per_file, open_input, open_output, stored

FILE_BYTES = 256 << 20
CHUNK = 1 << 18
MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long,"
    " digests_ok boolean, payload binary"
)
PAGE_URN = re.compile(r"<urn:page:(-?\d+)>")


class BrokenArchive(ValueError):
    """A record that is not framed or digested as it says."""


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def header_text(value: str) -> str:
    """A header value on one line: control characters are written in percent form."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def member(kind: str, fields: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """A record as a gzip member."""
    lines = [("WARC-Type", kind), *fields]
    lines += [("WARC-Block-Digest", "sha1:" + base32_sha1(hashlib.sha1(block).digest()))]
    lines += [("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head.encode("utf-8", "replace")) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def page_urn(page_id: int | None) -> str:
    return "<urn:page:unknown>" if page_id is None else f"<urn:page:{page_id}>"


def page_member(page_id: int | None, url: str | None, payload: bytes, digest: bytes, first: int | None, date: str) -> bytes:
    """The record of a page; ``first`` is the page it repeats, if it does."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Record-ID", page_urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", header_text(url)))
    fields.append(("Content-Type", "application/http; msgtype=response"))
    fields.append(("WARC-Payload-Digest", "sha1:" + base32_sha1(digest)))
    if first is None:
        return member("response", fields, http + payload)
    fields.append(("WARC-Refers-To", page_urn(first)))
    fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    return member("revisit", fields, http)


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest and the page a record refers to (null for a response).

    Of equal payloads of at least ``min_bytes`` bytes, that with the largest page_id is the response. The largest is
    found by an aggregate, so a payload of a third of all pages reaches its reducer as one row a task; only payloads
    that occur again are joined back, and adaptive execution splits the hot ones. A null html is an empty payload. Rows
    of one page_id with one payload are all responses if no larger page_id has it; a page without an id is a revisit if
    any page with an id has its payload, and a response else.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload"))).withColumn("size", F.octet_length("payload"))
    largest = (
        rows.where(F.col("size") >= min_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and response_id is not null")
        .drop("n")
    )
    refers = F.when(F.col("page_id").eqNullSafe(F.col("response_id")), None).otherwise(F.col("response_id"))
    return rows.join(largest, ["digest", "size"], "left").select(
        "page_id", "url", "payload", "digest", refers.alias("refers_to")
    )


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to gzipped archives; returns the manifest, stored.

    Every task writes its own files, a new one beyond ``file_bytes``; only files of the manifest count. No pages give a
    manifest of no rows. ``date`` is the capture date of all records.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, count, size, rows = None, "", 0, 0, []
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, digest, first = (batch.column(k)[i].as_py() for k in range(5))
                if out is None:
                    path, count, size = new_file(folder, ".warc.gz"), 0, 0
                    out = open_output(path)
                    info = [("WARC-Record-ID", "<urn:archive:info>"), ("WARC-Date", date)]
                    info.append(("Content-Type", "application/warc-fields"))
                    out.write(member("warcinfo", info, b"format: WARC File Format 1.1\r\n"))
                data = page_member(page_id, url, payload, digest, first, date)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= file_bytes:
                    out.close()
                    rows.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            rows.append((path, count, size))
        types = (pa.string(), pa.int64(), pa.int64())
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, ["path", "n_records", "n_bytes"])

    return stored(mark_revisits(pages, min_bytes).mapInArrow(write, MANIFEST), "warc-manifest")


class Members:
    """Bytes of one gzip member after the other, decompressed as they are asked for."""

    def __init__(self, file) -> None:
        self.file, self.packed, self.plain = file, b"", b""
        self.unpacker = None

    def open_next(self) -> bool:
        """Go to the next member; False at the end of the file."""
        self.packed = self.packed or self.file.read(CHUNK)
        self.plain = b""
        self.unpacker = zlib.decompressobj(31)
        return bool(self.packed)

    def _more(self) -> bool:
        """Decompress up to a chunk more of this member."""
        while not self.unpacker.eof:
            self.packed = self.packed or self.file.read(CHUNK)
            if not self.packed:
                raise BrokenArchive("the file ends within a record")
            got = self.unpacker.decompress(self.packed, CHUNK)
            self.packed = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
            if got:
                self.plain += got
                return True
        return False

    def head(self) -> bytes:
        """Up to and without the next empty line."""
        while (end := self.plain.find(b"\r\n\r\n")) < 0:
            if not self._more():
                raise BrokenArchive("a header without an end")
        found, self.plain = self.plain[:end], self.plain[end + 4 :]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """Exactly ``size`` bytes, in pieces."""
        while size:
            if not self.plain and not self._more():
                raise BrokenArchive("a record shorter than its content length")
            piece, self.plain = self.plain[:size], self.plain[size:]
            size -= len(piece)
            yield piece

    def rest(self) -> bytes:
        """What is left of this member; a few bytes in a sound archive."""
        while len(self.plain) <= 4 and self._more():
            pass
        return self.plain


def fields_of(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with a blank goes on with the field before it."""
    found: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def records(file, keep_payload: Callable[[dict[str, str]], bool] = lambda fields: False) -> Iterator[dict]:
    """The records of an archive in their order, each checked against its length and digests.

    Works through the file once with bounded memory; a payload is gathered only where ``keep_payload`` says so.
    """
    members = Members(file)
    while members.open_next():
        head = members.head()
        if not head.startswith(b"WARC/"):
            raise BrokenArchive("a member without a WARC record")
        fields = fields_of(head)
        left = int(fields["content-length"])
        block_sum, payload_sum = hashlib.sha1(), hashlib.sha1()
        kept: list[bytes] | None = [] if keep_payload(fields) else None
        http: dict[str, str] = {}
        size, pending = 0, b""
        in_http = fields.get("content-type", "").startswith("application/http")
        for piece in members.take(left):
            block_sum.update(piece)
            if in_http:  # the payload begins behind the HTTP header
                pending += piece
                end = pending.find(b"\r\n\r\n")
                if end < 0:
                    continue
                http, piece, in_http = fields_of(pending[:end]), pending[end + 4 :], False
            payload_sum.update(piece)
            size += len(piece)
            if kept is not None:
                kept.append(piece)
        if members.rest() != b"\r\n\r\n":
            raise BrokenArchive("a record that does not end where its content length says")
        digests = [("warc-block-digest", block_sum)]
        if fields.get("warc-type") != "revisit":
            digests.append(("warc-payload-digest", payload_sum))
        sound = all(
            fields[name] == "sha1:" + base32_sha1(own.digest()) for name, own in digests if name in fields
        )
        yield {
            "fields": fields,
            "payload_bytes": int(http.get("content-length", size)) if fields.get("warc-type") == "revisit" else size,
            "digests_ok": sound,
            "payload": None if kept is None else b"".join(kept),
        }


def page_of(urn: str | None) -> int | None:
    found = PAGE_URN.fullmatch(urn or "")
    return int(found.group(1)) if found else None


def read_archives(manifest: DataFrame, with_payload: bool = False, strict: bool = True, at_once: int = 32 << 20) -> DataFrame:
    """One row per page record of the manifest's archives; each file is read in sequence by one task.

    A record whose block or payload does not give its digest fails the read, or with ``strict`` off has digests_ok
    false. With ``with_payload`` the payloads of responses are returned too.
    """
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "digests_ok", "payload"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_input(path) as file:
                    for record in records(file, lambda fields: with_payload and fields.get("warc-type") == "response"):
                        fields = record["fields"]
                        kind = fields.get("warc-type")
                        if kind not in ("response", "revisit"):
                            continue
                        if strict and not record["digests_ok"]:
                            raise BrokenArchive(f"{path}: digest of {fields.get('warc-record-id')} does not match")
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        page, refers = page_of(fields.get("warc-record-id")), page_of(fields.get("warc-refers-to"))
                        rows.append((page, fields.get("warc-target-uri"), kind, record["payload_bytes"], digest, refers, record["digests_ok"], record["payload"]))
                        held += len(record["payload"] or b"") + 200
                        if held >= at_once:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    return one_task_per_file(manifest.select("path")).mapInArrow(read, RECORDS)
