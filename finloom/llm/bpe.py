"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens.  A minimal perfect hash over the vocabulary
resolves a pre-token that is itself a token; the others are merged from their
bytes with a heap of candidate pairs over a linked list.  Ids of what was seen
lately are remembered in a cache of bounded size.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.llm.common import rows, text_column

#: Pre-tokens in one of the cache's two generations (about 100 MB), and the longest one kept.
CACHE_ENTRIES, CACHED_CHARS = 600_000, 64

_MASK = (1 << 64) - 1
_STEP, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


class PerfectHash:
    """Minimal perfect hash by displacement: n keys to the slots 0 to n - 1.

    Keys fall into about n / 4 buckets; the largest buckets first, each takes
    the first displacement that puts all its keys into free slots.  Buckets of
    one key take what is left.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.n_buckets = max(1, (self.n + 3) // 4)
        buckets: dict[int, list[tuple[int, int]]] = {}
        for i, key in enumerate(keys):
            bucket, h = self._hashes(key)
            buckets.setdefault(bucket, []).append((h, i))
        displacements = [0] * self.n_buckets
        key_at = [0] * self.n
        free = np.ones(self.n, bool)
        largest_first = sorted(buckets.items(), key=lambda x: -len(x[1]))
        for bucket, members in largest_first:
            if len(members) > 1:
                d, places = self._displace(np.array([h for h, _ in members], np.uint64), free)
                displacements[bucket] = d
                free[places] = False
                for (_, i), place in zip(members, places.tolist()):
                    key_at[place] = i
        left = iter(np.flatnonzero(free).tolist())
        for bucket, members in largest_first:
            if len(members) == 1:
                place = next(left)
                displacements[bucket] = -1 - place
                key_at[place] = members[0][1]
        self.displacements, self.key_at = displacements, key_at

    def _hashes(self, key: bytes) -> tuple[int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        return (h >> 64) % self.n_buckets, h & _MASK

    def _displace(self, hashes: np.ndarray, free: np.ndarray) -> tuple[int, np.ndarray]:
        for start in range(0, 1 << 24, 1024):
            d = np.arange(start, start + 1024, dtype=np.uint64)
            x = hashes[None, :] + (d * np.uint64(_STEP))[:, None]
            x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX)
            places = ((x ^ (x >> np.uint64(29))) % np.uint64(self.n)).astype(np.int64)
            fits = np.flatnonzero(free[places].all(axis=1))
            for k in fits:
                if len(set(places[k].tolist())) == len(hashes):
                    return start + int(k), places[k]
        raise ValueError("keys must be distinct")

    def candidate(self, key: bytes) -> int:
        """The index of the only key that ``key`` can be."""
        bucket, h = self._hashes(key)
        d = self.displacements[bucket]
        if d < 0:
            return self.key_at[-1 - d]
        x = (h + d * _STEP) & _MASK
        x = ((x ^ (x >> 32)) * _MIX) & _MASK
        return self.key_at[(x ^ (x >> 29)) % self.n]


class ByteBPE:
    """Encoder and decoder for tokens given with their ranks, which are the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
        if [ranks[t] for t in self.tokens] != list(range(len(self.tokens))):
            raise ValueError("ranks must be 0 to n - 1")
        self.ranks = ranks
        self.hash = PerfectHash(self.tokens)
        self.pattern = regex.compile(pattern)
        if self.pattern.groups:
            raise ValueError("the pattern's groups must not capture")
        self.byte_ids = [ranks[bytes([i])] for i in range(256)]
        self.packed_ids = [i.to_bytes(4, "little") for i in range(len(self.tokens))]
        # Every way to make a token of two others.
        self.merges = {
            ranks[t[:k]] << 32 | ranks[t[k:]]: i
            for i, t in enumerate(self.tokens)
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        }
        # What two bytes make, by both in one number; -1 for nothing.
        first = [self.merges.get(a << 32 | b, -1) for a in self.byte_ids for b in self.byte_ids]
        self._byte_pairs = first
        self._pieces = _Cache(self._encode_piece)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        candidate = self.hash.candidate(piece)
        if self.tokens[candidate] == piece:
            return [candidate]
        merge = self.merges.get
        ids = [self.byte_ids[b] for b in piece]
        n = len(ids)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        pairs = self._byte_pairs
        # The id that each place makes with the next one, -1 for none.
        makes = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
        makes.append(-1)
        # A candidate is the id it makes and its place in one number: the
        # lowest id goes first, then the leftmost place.
        heap = [r << 32 | i for i, r in enumerate(makes) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            merged = top >> 32
            if makes[i] != merged:
                continue  # one of the two is part of another token by now
            j = after[i]
            ids[i] = merged
            ids[j] = makes[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                makes[i] = r = merge(merged << 32 | ids[k], -1)
                if r >= 0:
                    heappush(heap, r << 32 | i)
            else:
                makes[i] = -1
            h = before[i]
            if h >= 0:
                makes[h] = r = merge(ids[h] << 32 | merged, -1)
                if r >= 0:
                    heappush(heap, r << 32 | h)
        return [x for x in ids if x >= 0]

    def _encode_piece(self, piece: str) -> bytes:
        return b"".join([self.packed_ids[i] for i in self.encode_piece(piece.encode())])

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, unsigned 32-bit little-endian."""
        return np.frombuffer(b"".join(map(self._pieces.__getitem__, self.pattern.findall(text))), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class _Cache(dict):
    """What was packed lately, in two generations: when the younger is full it
    becomes the older, so what is in use stays."""

    def __init__(self, pack: Callable[[str], bytes]):
        super().__init__()
        self.pack = pack
        self.older: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        packed = self.older.get(text)
        if packed is None:
            packed = self.pack(text)
        if len(text) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[text] = packed
        return packed


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a base-64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def _bpe(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(load_ranks(path), pattern)


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, decoded: bool = True) -> DataFrame:
    """doc_id, ids (binary, unsigned 32-bit little-endian) and, if ``decoded``,
    decoded (binary) for every row.

    ``rank_file`` must be readable by the workers (an installed file).  Null
    text counts as empty and has no ids; repeated rows give equal rows; columns
    other than doc_id and text are ignored.  No shuffle.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(rank_file, pattern)
        before, encoded = None, np.zeros(0, "<u4")
        for batch in rows(source, 256):
            ids = []
            for text in batch.column(1).to_pylist():
                if text != before:  # copies often follow each other
                    before, encoded = text, bpe.encode(text)
                ids.append(encoded)
            columns = [batch.column(0), pa.array([x.tobytes() for x in ids], pa.binary())]
            if decoded:
                columns.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(
        batches, "doc_id long, ids binary" + ", decoded binary" * decoded
    )
