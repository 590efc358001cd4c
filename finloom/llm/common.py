"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column
from pyspark.sql import functions as F

from finloom.storage import discard, hand_over, materialise, shared_dir, spread  # noqa: F401  used by the operators

#: A word: a run of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store that holds ``uri`` and the path in it (a plain path is local)."""
    if not urlparse(uri).scheme:
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), urlparse(uri).path
    return pafs.FileSystem.from_uri(uri)


def text_hash(text: Column) -> Column:
    """With the document id, the identity of a row: rows that agree in both are
    interchangeable, so every operator may treat them alike."""
    return F.xxhash64(text, F.length(text))


def text_column(name: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def rows(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the Python objects of few rows are alive at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)
