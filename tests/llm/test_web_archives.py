import base64
import gzip
import hashlib
import io
from pathlib import Path

import pytest
from llm_cases import SMALL, table

from tonearm.llm import warc
from tonearm.llm.queries import all_queries


def expected(rows, min_bytes=0):
    payloads = [(i, (h or "").encode()) for i, h in rows]
    largest = {}
    for i, p in payloads:
        if i is not None and i > largest.get(p, -1):
            largest[p] = i
    found = []
    for i, p in payloads:
        first = largest.get(p)
        again = len(p) >= min_bytes and first is not None and first != i
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        found.append((i, len(p), digest, "revisit" if again else "response", first if again else None))
    return sorted(found, key=repr)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_op2_against_hashes(spark):
    found = all_queries()["op2_web_archives"](spark, SMALL).select(*COLUMNS).collect()
    rows = [(r.page_id, r.html) for r in table(spark, "pages").collect()]
    assert sorted(map(tuple, found), key=repr) == expected(rows)


PAGES = [
    (1, "http://a", "<p>same</p>"), (5, "http://b\r\nX: y", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "", None), (9, "u", ""),
    (5, "http://b", "<p>same</p>"), (None, "n", "<p>same</p>"), (None, "n", "alone"), (7, "ü", "WARC/1.1\r\n\r\n" * 3), (8, "l", "é" * 400_000),
]


def test_edge_pages_with_payloads(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string")
    manifest = warc.write_archives(pages, str(tmp_path), file_bytes=600)
    assert manifest.count() > 1
    found = warc.read_archives(manifest, with_payload=True).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found), key=repr) == expected([(p[0], p[2]) for p in PAGES])
    payloads = {(r.page_id, bytes(r.payload)) for r in found if r.record_type == "response"}
    assert (8, ("é" * 400_000).encode()) in payloads and (None, b"alone") in payloads
    assert {r.url for r in found if r.page_id == 5} == {"http://b%0D%0AX: y", "http://b"}
    files = [row.path for row in manifest.collect()]
    for path in files:  # any gzip reader can read them, one member a record
        assert gzip.decompress(Path(path).read_bytes()).startswith(b"WARC/1.1\r\n")
    none = warc.write_archives(pages.limit(0), str(tmp_path))
    assert warc.read_archives(none).count() == 0


def test_threshold_for_revisits(spark, tmp_path):
    pages = spark.createDataFrame([(p[0], p[1], p[2]) for p in PAGES], "page_id long, url string, html string")
    found = warc.read_archives(warc.write_archives(pages, str(tmp_path), min_bytes=12)).select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == expected([(p[0], p[2]) for p in PAGES], 12)


def record(payload=b"abc", digest=None):
    return warc.page_member(1, "u", payload, digest or hashlib.sha1(payload).digest(), None, "d")


def test_reader_checks_framing_and_digests():
    assert [r["digests_ok"] for r in warc.records(io.BytesIO(record() + record(b"")))] == [True, True]
    assert [r["digests_ok"] for r in warc.records(io.BytesIO(record(digest=b"0" * 20)))] == [False]
    whole = gzip.decompress(record())
    for broken in (whole[:-6], whole + b"x", whole.replace(b"Content-Length: 8", b"Content-Length: 7")):
        if broken != whole:
            with pytest.raises(warc.BrokenArchive):
                list(warc.records(io.BytesIO(gzip.compress(broken))))
    with pytest.raises(warc.BrokenArchive):
        list(warc.records(io.BytesIO(record()[:-20])))
