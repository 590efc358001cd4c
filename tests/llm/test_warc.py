from __future__ import annotations

import hashlib
import io
import struct
from collections import Counter

import pyarrow.fs as pafs
from tests.conftest import SMALL

from finloom.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload string"


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", None) for i, u, h in rows], SCHEMA)


def brute(rows) -> Counter:
    first: dict = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    out = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        to = first.get(raw)
        revisit = to is not None and to != i
        out[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", to if revisit else None] += 1
    return out


def _check(spark, rows):
    manifest = warc.write_warc(_pages(spark, rows))
    found = warc.read_warc(manifest).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == brute(rows)
    sent = Counter((i, (h or "").encode()) for i, _, h in rows)
    assert all(sent[r.page_id, bytes(r.payload)] for r in found if r.record_type == "response")
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    return manifest


def test_real_pages(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    _check(spark, rows)


def test_awkward(spark):
    same, long = "s" * 100, "".join(f"w{i} " for i in range(60_000))
    rows = [(3, "u", same), (1, "u\r\nX: y", same), (2, None, same), (None, "u", same), (1, "u", same), (4, "", None), (5, "u", ""), (6, "u", "s" * 99), (7, "u", "s" * 99), (8, "é", "日本" * 40), (9, "u", long), (10, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n")]
    _check(spark, rows)


def test_empty(spark):
    assert warc.read_warc(warc.write_warc(_pages(spark, []))).count() == 0


def test_archives_stand_alone(spark, monkeypatch):
    """Every archive starts with its dictionary in a skippable frame, and
    records are frames of their own."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 50_000)
    rows = [(i, f"http://h/{i}", f"<p>{'common words of a page ' * 40}{i}</p>") for i in range(200)]
    manifest = _check(spark, rows)
    archives = manifest.collect()
    assert len(archives) > 2 and sum(a.n_records for a in archives) == 200
    for a in archives:
        fs, place = pafs.FileSystem.from_uri(a.archive)
        with fs.open_input_stream(place) as source:
            data = source.read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == warc.DICTIONARY_MAGIC and 0 < size < len(data)
        assert data[8 + size :].count(b"\x28\xb5\x2f\xfd") >= a.n_records
        assert len(list(warc.read_archive(io.BytesIO(data)))) == a.n_records
