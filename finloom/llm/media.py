"""Media columns: payloads as images in archives, read by a data source.

Texts are stored losslessly as 8-bit grey images (PNG, 64 samples a row) inside
ZIP archives.  ``MediaArchiveSource`` reads them back: it plans byte ranges of
the archives, a task takes the members that start in its range by the archive's
own directory, streams them as Arrow batches, and fetches a member that fails
again by its offset, without touching the others.
"""

from __future__ import annotations

import hashlib
import io
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from finloom.llm.common import filesystem, rows, shared_dir, text_column

#: Samples of a row; payloads are padded to a positive multiple of it.
WIDTH = 64
#: Bytes of an archive, of a planned range, and of a batch.
ARCHIVE_BYTES, RANGE_BYTES, BATCH_BYTES = 64 << 20, 16 << 20, 4 << 20
#: Partitions that a plan holds at most: beyond that, ranges grow and take in
#: several archives.
PARTITIONS = 50_000
ATTEMPTS = 4
ZLIB_LEVEL = 1
# Signature and chunk names of the format.
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_LOCAL_HEADER = 30


def pad(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % WIDTH or (0 if raw else WIDTH))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(raw: bytes) -> bytes:
    """Bytes, padded, as the samples of an image that also states their number."""
    samples = np.frombuffer(pad(raw), np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(samples), WIDTH + 1), np.uint8)  # each begins with filter 0
    lines[:, 1:] = samples
    header = struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 0, 0, 0, 0)
    return b"".join(
        [
            _SIGNATURE,
            _chunk(b"IHDR", header),
            _chunk(b"tEXt", b"n_bytes\0" + str(len(raw)).encode()),
            _chunk(b"IDAT", zlib.compress(lines, ZLIB_LEVEL)),
            _chunk(b"IEND", b""),
        ]
    )


def decode_png(data: bytes) -> tuple[int, np.ndarray]:
    """Number of unpadded bytes and samples of an image written by encode_png."""
    if data[:8] != _SIGNATURE:
        raise ValueError("not a PNG image")
    at, n_bytes, size, packed = 8, -1, (0, 0), []
    while at < len(data):
        (length,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + length]
        if struct.unpack_from(">I", data, at + 8 + length)[0] != zlib.crc32(kind + body):
            raise ValueError("a chunk is damaged")
        if kind == b"IHDR":
            size = struct.unpack_from(">II", body)
        elif kind == b"tEXt":
            n_bytes = int(body.partition(b"\0")[2])
        elif kind == b"IDAT":
            packed.append(body)
        at += 12 + length
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(size[1], size[0] + 1)
    if lines[:, 0].any():
        raise ValueError("only filter 0 is written")
    return n_bytes, lines[:, 1:]


def feature(samples: np.ndarray) -> str:
    """Height, mean and variance of the samples in thousandths, and 64 bits:
    which columns are brighter than the image."""
    wide = samples.astype(np.int64)
    total, n = int(wide.sum()), samples.size
    columns = wide.sum(axis=0)
    variance = int((wide * wide).sum()) * n - total * total
    bits = int("".join("1" if c * WIDTH > total else "0" for c in columns.tolist()), 2)
    return f"h={len(samples)};mean={total * 1000 // n};var={variance * 1000 // (n * n)};bits={bits:016x}"


class _Appended(io.RawIOBase):
    """A store's output as a file that can't seek, which is all an archive needs."""

    def __init__(self, out: pa.NativeFile):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(data)
        return len(data)


def write_archives(docs: DataFrame, path: str | None = None) -> str:
    """Store every text as a member of archives under ``path`` (a fresh shared
    folder if None) and return the path of their manifest.

    Null text counts as empty: one row of zeros.  Members carry the doc_id in
    their name (empty for null), so repeated rows are members of their own.
    Attempts of a task write under names of their own, and the manifest has the
    archives of committed tasks only.
    """
    spark = docs.sparkSession
    folder = path or shared_dir(spark, "media")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = filesystem(folder)
        fs.create_dir(place, recursive=True)

        def close() -> pa.RecordBatch:
            n = len(archive.infolist())
            archive.close()
            size = out.tell()
            out.close()
            return pa.RecordBatch.from_pylist([{"archive": f"{folder}/{name}", "n_members": n, "n_bytes": size}])

        # Members are streamed: a task holds one of them, not the archive.
        archive = None
        for batch in rows(batches, 64):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if archive is None:
                    name = f"{uuid.uuid4().hex}.zip"
                    out = fs.open_output_stream(f"{place}/{name}")
                    archive = zipfile.ZipFile(_Appended(out), "w", zipfile.ZIP_STORED)
                member = f"{len(archive.infolist()):08d}-{'' if doc_id is None else doc_id}.png"
                archive.writestr(zipfile.ZipInfo(member), encode_png(text.encode()))
                if out.tell() >= ARCHIVE_BYTES:
                    yield close()
                    archive = None
        if archive is not None:
            yield close()

    written = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(
        write, "archive string, n_members long, n_bytes long"
    )
    manifest = shared_dir(spark, "media-manifest")
    written.write.parquet(manifest)
    return manifest


class ArchiveRanges(InputPartition):
    """Byte ranges (archive, start, end) that one task reads."""

    def __init__(self, ranges: list[tuple[str, int, int]]):
        self.ranges = ranges


def planned(archives: Iterable[tuple[str, int]], range_bytes: int, partitions: int = PARTITIONS) -> list[ArchiveRanges]:
    """Partitions of about ``range_bytes``, or of an equal share of all bytes if
    that would be too many of them."""
    archives = list(archives)
    range_bytes = max(range_bytes, -(-sum(size for _, size in archives) // partitions))
    out, held = [], range_bytes
    for archive, size in archives:
        for start in range(0, size, range_bytes):
            end = min(size, start + range_bytes)
            if held + end - start > range_bytes:
                out.append(ArchiveRanges([]))
                held = 0
            out[-1].ranges.append((archive, start, end))
            held += end - start
    return out


def fetch_member(opened, place: str, offset: int, size: int, crc: int, attempts: int = ATTEMPTS, wait: float = 0.2) -> bytes:
    """The bytes of one stored member by its offset.  A read that fails or whose
    checksum is wrong is tried again with a newly opened file, this member only."""

    def fetch(source) -> bytes:
        source.seek(offset)
        header = source.read(_LOCAL_HEADER)
        name, extra = struct.unpack_from("<HH", header, 26)
        source.seek(offset + _LOCAL_HEADER + name + extra)
        data = source.read(size)
        if len(data) != size or zlib.crc32(data) != crc:
            raise OSError("the member is damaged or cut short")
        return data

    return _tried(fetch, opened, place, f"member at {offset} of {place}", attempts, wait)


def fetch_directory(opened, place: str, attempts: int = ATTEMPTS, wait: float = 0.2) -> list[zipfile.ZipInfo]:
    """The members of an archive, tried again in the same way."""

    def fetch(source) -> list[zipfile.ZipInfo]:
        with zipfile.ZipFile(source) as archive:
            return archive.infolist()

    return _tried(fetch, opened, place, f"directory of {place}", attempts, wait)


def _tried(fetch, opened, place: str, what: str, attempts: int, wait: float):
    for attempt in range(attempts):
        try:
            return fetch(opened(place, attempt > 0))
        except (OSError, struct.error, zipfile.BadZipFile) as e:
            if attempt + 1 == attempts:
                raise OSError(f"{what}: {e}") from e
            time.sleep(wait * 2**attempt)
    raise ValueError("attempts must be positive")


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.manifest = options["path"]
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.attempts = int(options.get("attempts", ATTEMPTS))

    def partitions(self) -> list[ArchiveRanges]:
        """Byte ranges of the archives, from their manifest: names and sizes of
        archives of 64 MB each; the plan never looks at members."""
        fs, place = filesystem(self.manifest)
        files = [f.path for f in fs.get_file_info(pafs.FileSelector(place)) if f.path.endswith(".parquet")]
        if not files:
            return []
        table = pads.dataset(files, filesystem=fs, format="parquet").to_table(columns=["archive", "n_bytes"])
        return planned(zip(*(c.to_pylist() for c in table.columns)), self.range_bytes)

    def read(self, partition: ArchiveRanges | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's call for a plan without partitions
            return
        for archive, start, end in partition.ranges:
            yield from self._members(archive, start, end)

    def _members(self, archive: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
        """The members that start in a range."""
        fs, place = filesystem(archive)
        files: dict[str, pa.NativeFile] = {}

        def opened(path: str, anew: bool = False) -> pa.NativeFile:
            if anew or path not in files:
                files[path] = fs.open_input_file(path)
            return files[path]

        members = fetch_directory(opened, place, self.attempts)
        files.clear()
        found: list[dict] = []
        held = 0
        for m in members:
            if not start <= m.header_offset < end:
                continue
            data = fetch_member(opened, place, m.header_offset, m.compress_size, m.CRC, self.attempts)
            number = m.filename.rpartition(".")[0].partition("-")[2]
            found.append({"archive": archive, "member": m.filename, "offset": m.header_offset, "doc_id": int(number) if number else None, "media": data})
            held += len(data)
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(found, _MEMBER)
                found, held = [], 0
        if found:
            yield pa.RecordBatch.from_pylist(found, _MEMBER)


_MEMBER = pa.schema(
    [("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("doc_id", pa.int64()), ("media", pa.binary())]
)


class MediaArchiveSource(DataSource):
    """``spark.read.format("media_archive").load(manifest)``.

    Options: range_bytes (bytes of a planned range), attempts (reads of a
    member before its task fails; nothing is ever skipped).
    """

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return "archive string, member string, offset long, doc_id long, media binary"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def read_archives(spark: SparkSession, manifest: str, **options: str) -> DataFrame:
    spark.dataSource.register(MediaArchiveSource)
    return spark.read.format("media_archive").options(**options).load(manifest)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    for batch in rows(batches, 256):
        found = []
        for doc_id, media in zip(*(c.to_pylist() for c in batch.columns)):
            n_bytes, samples = decode_png(media)
            payload = samples.tobytes()
            found.append(
                (doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples))
            )
        yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, pa.int64()) for i, c in enumerate(zip(*found))], names)


def media_features(media: DataFrame) -> DataFrame:
    """Digests and features of the media column, one row a member."""
    return media.select("doc_id", "media").mapInArrow(
        _describe,
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, "
        "media_bytes long, media_sha256 string, feature string",
    )
