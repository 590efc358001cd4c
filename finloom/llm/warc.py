"""WARC archives with dictionary-compressed records.

Records are compressed one by one as Zstandard frames.  Every archive builds a
dictionary from its own records and carries it in a leading skippable frame, so
it can be read without anything else.  A payload that an earlier page already
has is written as a revisit record, which names that page and holds no payload.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.llm.common import filesystem, materialise, rows, shared_dir, spread

#: Payloads of fewer bytes never become revisits.
MIN_REVISIT_BYTES = 100
#: Raw bytes of records in an archive, of the dictionary, and of the records
#: that it is built from.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES = 32 << 20, 64 << 10, 2 << 20
LEVEL = 3
#: Tasks that read archives, at most.
READ_TASKS = 50_000
# The skippable frame of a dictionary, the first bytes of a trained
# dictionary, and the profile of a revisit.
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_HEAD = b"\x37\xa4\x30\xec"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"


def with_verdicts(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest (SHA-256), refers_to (null: a response).

    Among equal payloads of at least MIN_REVISIT_BYTES the smallest page_id is
    the response.  A null page_id is the largest; if no page of a payload has an
    id, all are responses, as are rows that repeat the smallest id.
    """
    records = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    long = F.octet_length("payload") >= MIN_REVISIT_BYTES
    firsts = (
        records.where(long)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .select(F.col("digest").alias("f_digest"), "first")
    )
    # A payload that very many pages share is a hot key with one row on the
    # right, dealt evenly first so that adaptive execution can split the left.
    # Short payloads don't meet at all.
    joined = records.where(long).join(spread(firsts), F.col("digest") == F.col("f_digest"), "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )
    return joined.unionByName(spread(records.where(~long)).withColumn("refers_to", F.lit(None).cast("long")))


def _record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None, date: str) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest.hex()}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {' '.join(url.split())}")
    if revisit:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from whole records spread evenly over the archive, of
    SAMPLE_BYTES together at most or one record."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    sample, held = [], 0
    for record in records[::step]:
        held += len(record)
        if sample and held > SAMPLE_BYTES:
            break
        sample.append(record)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=512, d=8, level=LEVEL)
    except zstandard.ZstdError:  # too few records to train on: use their bytes
        return zstandard.ZstdCompressionDict(b"".join(sample)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(records: list[bytes], out) -> None:
    dictionary = build_dictionary(records)
    content = dictionary.as_bytes()
    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
    for record in records:
        out.write(compressor.compress(record))


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive, in order."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive has no dictionary frame")
    content = source.read(size)
    trained = content[:4] == DICTIONARY_HEAD
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=kind)
    frames = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True)
    stream = io.BufferedReader(frames, 1 << 20)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if len(block) != int(headers["Content-Length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError("the archive is cut short")
        yield headers, block


def write_warc(pages: DataFrame, path: str | None = None, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the pages as archives under ``path`` (a fresh shared folder if
    None) and return their manifest: archive, n_records, n_bytes.

    Attempts of a task write under names of their own; only the archives of
    committed tasks are in the manifest.  See ``with_verdicts`` for nulls and
    ties; an empty table has no archives.
    """
    folder = path or shared_dir(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = filesystem(folder)
        fs.create_dir(place, recursive=True)

        def close(records: list[bytes]) -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{place}/{name}") as out:
                write_archive(records, out)
                n_bytes = out.tell()
            return pa.RecordBatch.from_pylist([{"archive": f"{folder}/{name}", "n_records": len(records), "n_bytes": n_bytes}])

        records: list[bytes] = []
        held = 0
        for batch in rows(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                records.append(_record(*row, date))
                held += len(records[-1])
                if held >= ARCHIVE_BYTES:
                    yield close(records)
                    records, held = [], 0
        if records:
            yield close(records)

    manifest = with_verdicts(pages).mapInArrow(write, "archive string, n_records long, n_bytes long")
    return materialise(manifest, "warc-manifest")


def read_warc(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest and, if ``payloads``, payload (null for a
    revisit).  A response's digest is computed anew and must agree with the
    one stored."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    fields = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    if payloads:
        names, schema, fields = [*names, "payload"], schema + ", payload binary", [*fields, pa.binary()]

    def page(uri: str) -> int | None:
        number = uri[1:-1].removeprefix(_ID)
        return int(number) if number else None

    def row(headers: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(http.rpartition(b"Content-Length: ")[2])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
        revisit = headers["WARC-Type"] == "revisit"
        if not revisit and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != length):
            raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
        refers_to = page(headers["WARC-Refers-To"]) if revisit else None
        found = (page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), headers["WARC-Type"], refers_to, length, digest)
        return (*found, None if revisit else payload)[: len(names)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), fields)], names)

        for archives in batches:
            for archive in archives.column(0).to_pylist():
                fs, place = filesystem(archive)
                found: list[tuple] = []
                with fs.open_input_stream(place) as source:
                    for record in read_archive(source):
                        found.append(row(*record))
                        if len(found) == 512:
                            yield batch(found)
                            found = []
                if found:
                    yield batch(found)

    # Ranges of names, which are random, give each task as many archives.
    tasks = max(1, min(manifest.count(), READ_TASKS))
    return manifest.select("archive").repartitionByRange(tasks, "archive").mapInArrow(read, schema)
