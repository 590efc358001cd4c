"""Article text of real pages against an extraction by patterns."""

from __future__ import annotations

import re
from html import unescape

from tests.conftest import MEDIUM

from finloom.plans.catalog import QUERIES

_HIDDEN = re.compile(r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<![^>]*>")
_TOKEN = re.compile(r"<[^>]*>|[^<]+")


def by_patterns(html: str) -> str:
    every, inside, depth = [], [], 0
    for token in _TOKEN.findall(_HIDDEN.sub("<x>", html)):
        if token.startswith("<"):
            if re.match(r"(?i)<article\b", token):
                depth += 1
            elif re.match(r"(?i)</article\b", token):
                depth -= depth > 0
        elif words := " ".join(unescape(token).split()):
            every.append(words)
            if depth:
                inside.append(words)
    return "\n".join(inside or every)


def test_article_text(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{MEDIUM}/pages.parquet").collect()}
    found = QUERIES["html_article_text"](spark, MEDIUM)
    text = next(c for c in found.columns if c != "page_id")
    rows = {r.page_id: r[text] for r in found.collect()}
    assert rows.keys() == pages.keys()
    wrong = [k for k, html in pages.items() if rows[k] != by_patterns(html or "")]
    assert wrong == []
