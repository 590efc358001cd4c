from __future__ import annotations

import hashlib
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import MEDIUM

from finloom.llm.queries import op10_secret_scan
from finloom.llm.secret_scan import BASE58, base58check, base62_crc32, find_secrets, scan_secrets
from tests.llm.helpers import awkward, documents

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text: str) -> list[tuple]:
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


PIECES = st.lists(
    st.sampled_from(
        ["password", "PassWd", "secret", "token", "api_key", "apikey", "API", "_", "=", ":", " ", '"', "'", "abc123", "AKIA", "A" * 16, "0123456789abcdef" * 2, "İ", "ſ", "K", "é", "\n", "ghp_", "x" * 36]
    ),
    max_size=14,
).map("".join)


@settings(max_examples=600, deadline=None)
@given(PIECES)
def test_base_spans(text):
    assert [x for x in find_secrets(text) if x[0] in ("assign", "access", "hex")] == base(text)


def test_checksums():
    body = "Ab3" * 10
    good = f"ghp_{body}{base62_crc32(body)}"
    assert ("github", 4, 4 + len(good)) in find_secrets(f"key {good} end")
    assert find_secrets(f"key ghp_{body}000000 end") == []
    assert ("npm", 0, 40) in find_secrets(f"npm_{body}{base62_crc32(body)}")
    assert base62_crc32("") == "000000" and zlib.crc32(b"") == 0
    raw = bytes.fromhex("0488ade4") + bytes(range(74))
    value = int.from_bytes(raw + hashlib.sha256(hashlib.sha256(raw).digest()).digest()[:4], "big")
    digits = ""
    while value:
        value, d = divmod(value, 58)
        digits = BASE58[d] + digits
    assert digits.startswith("xprv") and base58check(digits)
    assert [x[0] for x in find_secrets(digits)] == ["xprv"]
    wrong = digits[:-1] + ("a" if digits[-1] != "a" else "b")
    assert find_secrets(wrong) == []


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()}
    rows = op10_secret_scan(spark, MEDIUM).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex"))
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_awkward_and_empty(spark):
    assert scan_secrets(awkward(spark)).count() == 11
    assert scan_secrets(documents(spark, [])).count() == 0
