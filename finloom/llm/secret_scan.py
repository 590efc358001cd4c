"""Secret scans: keyword prefilter, anchored patterns, checksum validation.

An Aho-Corasick automaton finds every keyword in one pass; a pattern is tried
only where its keyword was found, anchored there.  Kinds whose format embeds a
checksum are reported only if it holds.  Runs of hexadecimal digits have no
keyword, so their pattern runs by itself.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.llm.common import rows, text_column

# The kinds in the order in which they are listed, their keywords
# and patterns, and public token formats with an embedded checksum.
KINDS = ("assign", "access", "hex", "github", "npm", "xprv")
KEYWORDS = {
    "password": "assign",
    "passwd": "assign",
    "secret": "assign",
    "token": "assign",
    "apikey": "assign",
    "api_key": "assign",
    "akia": "access",
    "ghp_": "github",
    "gho_": "github",
    "ghu_": "github",
    "ghs_": "github",
    "ghr_": "github",
    "npm_": "npm",
    "xprv": "xprv",
}
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
GITHUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
XPRV = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
MIN_ASSIGNED, MIN_ACCESS = 6, 20


def base62_crc32(payload: str) -> str:
    """CRC-32 in six base-62 digits, as public token formats append it."""
    value, digits = zlib.crc32(payload.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def base58check(text: str) -> bool:
    """Whether the last four bytes are the double SHA-256 of those before."""
    value = 0
    for c in text:
        value = value * 58 + BASE58.index(c)
    raw = value.to_bytes(max(5, (value.bit_length() + 7) // 8), "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def _crc_holds(match: re.Match) -> bool:
    return base62_crc32(match[1]) == match[2]


#: Kind, pattern, validation.
_RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= MIN_ASSIGNED),
    "access": (ACCESS, lambda m: len(m[0]) >= MIN_ACCESS),
    "github": (GITHUB, _crc_holds),
    "npm": (NPM, _crc_holds),
    "xprv": (XPRV, lambda m: base58check(m[0])),
}


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def _folded(text: str) -> str:
    """Lower case, position by position."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c.isascii() else c for c in text)


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed.

    Matches of one kind don't overlap: the leftmost is taken, and one that
    fails its validation still uses up its characters.
    """
    spans = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    free = dict.fromkeys(_RULES, 0)
    for last, (kind, length) in _automaton().iter(_folded(text)):
        start = last - length + 1
        pattern, valid = _RULES[kind]
        if start >= free[kind] and (m := pattern.match(text, start)):
            free[kind] = m.end()
            if valid(m):
                spans.append((kind, start, m.end()))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in rows(batches):
        found = [
            [{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(x)] for x in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], ["doc_id", "secrets"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and secrets, an array of (kind, start, end), for every row.

    Null text counts as empty; repeated rows give equal rows; columns other
    than doc_id and text are ignored.  No shuffle.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(
        _scan_batches, "doc_id long, secrets array<struct<kind:string,start:long,end:long>>"
    )
