from __future__ import annotations

import hashlib
import io
import zipfile
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from finloom.llm import media
from tests.llm.helpers import awkward, documents


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=400))
def test_image_round_trip(raw):
    n, samples = media.decode_png(media.encode_png(raw))
    assert (n, samples.tobytes()) == (len(raw), media.pad(raw))
    assert len(media.pad(raw)) % 64 == 0 and len(media.pad(raw)) >= 64


def test_damage_is_noticed():
    data = bytearray(media.encode_png(b"text"))
    data[60] ^= 1
    with pytest.raises(Exception):
        media.decode_png(bytes(data))


def test_awkward_round_trip(spark):
    docs = awkward(spark)
    manifest = media.write_archives(docs)
    found = Counter(
        (r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32)
        for r in media.media_features(media.read_archives(spark, manifest, range_bytes="2000")).collect()
    )
    expected = Counter()
    for r in docs.collect():
        raw = (r.text or "").encode()
        padded = media.pad(raw)
        expected[r.doc_id, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:])] += 1
    assert found == expected
    assert media.media_features(media.read_archives(spark, media.write_archives(documents(spark, [])))).count() == 0


def test_many_archives_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(media, "ARCHIVE_BYTES", 3000)
    texts = [f"text {i} " * (i % 50) for i in range(300)]
    manifest = media.write_archives(documents(spark, texts).coalesce(2))
    for size in ("500", "4000", "100000000"):
        rows = media.read_archives(spark, manifest, range_bytes=size).collect()
        assert Counter(r.doc_id for r in rows) == Counter(range(300))
        assert all(media.decode_png(r.media)[1].tobytes() == media.pad(texts[r.doc_id].encode()) for r in rows)


def test_a_member_is_fetched_again_by_itself(tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as archive:
        for i in range(3):
            archive.writestr(f"{i}", f"member {i}" * 10)
        infos = archive.infolist()
    calls = Counter()

    def opened(place, anew):
        calls[anew] += 1
        if not anew and calls[False] == 2:
            return io.BytesIO(b"cut short")
        return io.BytesIO(buffer.getvalue())

    got = [media.fetch_member(opened, "x", m.header_offset, m.compress_size, m.CRC, wait=0) for m in infos]
    assert got == [f"member {i}".encode() * 10 for i in range(3)]
    assert calls == {False: 3, True: 1}
    with pytest.raises(OSError):
        media.fetch_member(lambda *_: io.BytesIO(b""), "x", 0, 5, 0, attempts=2, wait=0)


def test_feature_depends_on_the_samples_alone():
    a = np.arange(128, dtype=np.uint8).reshape(2, 64)
    assert media.feature(a) == media.feature(a.copy()) != media.feature(a[::-1] + np.uint8(1))


def test_plans_stay_small():
    archives = [(f"a{i}", 100 + 37 * i) for i in range(40)]
    for range_bytes, most in ((50, 1000), (50, 7), (10**9, 5)):
        parts = media.planned(archives, range_bytes, most)
        assert len(parts) <= 2 * most + 1
        pieces = [r for p in parts for r in p.ranges]
        assert [(a, e - s) for a, s, e in sorted(pieces, key=lambda x: (int(x[0][1:]), x[1]))] == [(a, e - s) for a, s, e in pieces]
        for name, size in archives:
            own = [(s, e) for a, s, e in pieces if a == name]
            assert own[0][0] == 0 and own[-1][1] == size and all(x[1] == y[0] for x, y in zip(own, own[1:]))
    assert media.planned([], 50) == []


def test_a_directory_is_fetched_again(tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("one", b"1")
    tries = []

    def opened(place, anew):
        tries.append(anew)
        if len(tries) < 3:
            raise OSError("gone")
        return open(place, "rb")

    assert [m.filename for m in media.fetch_directory(opened, str(path), wait=0.0)] == ["one"]
    assert tries == [False, True, True]
    with pytest.raises(OSError):
        media.fetch_directory(lambda place, anew: io.BytesIO(b"no archive"), str(path), attempts=2, wait=0.0)
