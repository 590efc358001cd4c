"""Words of lower-cased text: runs of letters a to z, digits and non-ASCII characters.

Only A to Z are lower-cased; every other ASCII character parts words.  Works on
UTF-8 bytes, where all bytes of a non-ASCII character count as letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

_LETTERS = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
#: Byte by byte: lower case, a space for what parts words.
FOLD = bytes(c if c in _LETTERS else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Bytes of a long text whose words are held at once.
PIECE_BYTES = 1 << 20


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The folded text, cut at spaces into pieces of about ``size``."""
    folded = text.translate(FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + size)
        end = len(folded) if end < 0 else end
        yield folded[at:end]
        at = end


def overlapping(text: bytes, keep: int, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Words by pieces: the number of the first word, how many of the words were in
    the piece before (the last ``keep`` of it at most), and the words."""
    at, held = 0, []
    for piece in pieces(text, size):
        if new := piece.split():
            words = held + new
            yield at, len(held), words
            held = words[-keep:] if keep else []
            at += len(words) - len(held)


def as_bytes(column: pa.Array) -> list[bytes]:
    """A column of strings as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
