from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SMALL

from finloom.llm import bpe
from finloom.llm.queries import op6_bpe
from tests.llm.helpers import awkward, documents

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBPE(bpe.load_ranks(PATH), public_tokenizers.PATTERN)


TEXTS = st.lists(
    st.one_of(
        st.text(max_size=12),
        st.sampled_from([" ", "  ", "\n", "\r\n", "\t", " ", " ", "\u0085", "\x1c", "'s", "'LL", "don't", "123456", "<|endoftext|>", "naïve", "日本", "🙂", "a" * 90, "\n\n x"]),
    ),
    max_size=12,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_and_round_trip(reference, own, text):
    ids = own.encode(text)
    assert ids.tolist() == reference.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_perfect_hash_is_minimal(own):
    n = len(own.tokens)
    assert sorted(own.hash.candidate(t) for t in own.tokens) == list(range(n))
    assert all(own.hash.candidate(own.tokens[i]) == i for i in range(0, n, 7))


def test_caches_start_anew(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    small = bpe.ByteBPE(bpe.load_ranks(PATH), public_tokenizers.PATTERN)
    text = "the quick brown foxes jumped over the lazy dogs' backs again and again"
    assert small.encode(text).tolist() == reference.encode_ordinary(text)


def test_query(spark, reference):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = op6_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(reference.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_awkward_and_empty(spark, reference):
    docs = awkward(spark)
    found = sorted((r.doc_id is None, r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN).collect())
    expected = sorted((r.doc_id is None, r.doc_id, np.array(reference.encode_ordinary(r.text or ""), "<u4").tobytes(), (r.text or "").encode()) for r in docs.collect())
    assert found == expected
    assert bpe.encode_documents(documents(spark, []), PATH, public_tokenizers.PATTERN).count() == 0
