"""Literal rows that pin down the quirks of the column functions."""

from __future__ import annotations

import uuid
from urllib.parse import parse_qs, urlencode, urlparse, urlunparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finloom.functions import finance, ids, text, url


def values(spark, rows, schema, column):
    df = spark.createDataFrame([(i, *r) if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_normalize_url(spark):
    cases = {
        "https://www.CNBC.com/Article/": "https://cnbc.com/Article",
        "https://example.com/news?utm_source=x&page=1": "https://example.com/news?page=1",
        "https://example.com/article#comments": "https://example.com/article",
        "https://example.com/news/index.html": "https://example.com/news",
        "https://example.com/a?b=&c=1&d": "https://example.com/a?c=1",
        "https://example.com/a?x=1&y=2&x=3": "https://example.com/a?x=1&x=3&y=2",
        "https://example.com/a/?ref=z": "https://example.com/a/",
        "": "",
        None: "",
    }
    assert values(spark, list(cases), "u string", url.normalize_url(F.col("u"))) == list(cases.values())


def test_normalize_url_against_the_standard_library(spark):
    parts = st.sampled_from(["a", "B", "c1", "index.html"])
    queries = st.lists(st.tuples(st.sampled_from(["page", "x", "utm_m", "ref", "y"]), st.sampled_from(["", "1", "2"])), max_size=4)

    def expected(u: str) -> str:
        p = urlparse(u.rstrip("/"))
        host = p.netloc.lower().removeprefix("www.")
        kept = {k: v for k, v in parse_qs(p.query).items() if not k.startswith("utm_") and k != "ref"}
        return urlunparse(p._replace(netloc=host, fragment="", path=p.path.removesuffix("/index.html"), query=urlencode(kept, doseq=True)))

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.sampled_from(["http", "https"]), st.sampled_from(["WWW.x.org", "y.net", "a.B.com"]), st.lists(parts, max_size=3), queries, st.booleans()), min_size=20, max_size=40))
    def check(cases):
        urls = [
            f"{s}://{h}" + "".join(f"/{x}" for x in ps) + ("?" + "&".join(f"{k}={v}" for k, v in qs) if qs else "") + ("#top" if frag else "")
            for s, h, ps, qs, frag in cases
        ]
        assert values(spark, urls, "u string", url.normalize_url(F.col("u"))) == [expected(u) for u in urls]

    check()


def test_hosts(spark):
    rows = ["https://a.example.com/x", "https://example.com", "https://badexample.com", "nonsense", None]
    ports = [("https://me:pw@A.example.com:8443/x",), ("http://[::1]:80/",), ("https://example.com:443",), ("x",)]
    assert values(spark, ports, "u string", url.hostname(F.col("u"))) == ["a.example.com", "::1", "example.com", ""]
    assert values(spark, ports, "u string", url.host_in(F.col("u"), ["Example.com"], url.hostname)) == [True, False, True, False]
    assert values(spark, ports, "u string", url.host_in(F.col("u"), ["example.com"])) == [False, False, False, False]
    assert values(spark, rows, "u string", url.host_in(F.col("u"), ["example.com"])) == [True, True, False, False, False]
    assert values(spark, rows, "u string", url.is_web_url(F.col("u"))) == [True, True, True, False, False]
    assert values(spark, ["http://a/x.PDF?y=1", "http://a/x.pdfx", None], "u string", url.is_pdf(F.col("u"))) == [True, False, False]


def test_uuid5(spark):
    names = ["https://example.com/a", "", "日本", "entity:Apple:company"]
    assert values(spark, names, "n string", ids.uuid5(F.col("n"))) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def test_jaccard(spark):
    rows = [("Fed raises rates", "fed RAISES rates"), ("a b c d", "a b c e"), ("", "a"), ("  ", " "), (None, "a")]
    j = text.jaccard(text.word_set(F.col("a")), text.word_set(F.col("b")))
    assert values(spark, rows, "a string, b string", j) == [1.0, 0.6, 0.0, 0.0, 0.0]


def test_search_and_rules(spark):
    rows = [("Fed news", None), (None, "the FED"), (None, None), ("x", "y")]
    match = lambda q: text.matches_query(q, F.col("a"), F.col("b"))
    assert values(spark, rows, "a string, b string", match("fed")) == [True, True, False, False]
    assert values(spark, rows, "a string, b string", match("")) == [True, True, False, True]
    rules = (("index", ("nasdaq",)), ("macro", ("fed", "gdp")))
    texts = ["Nasdaq and GDP", "federal", "none", None]
    assert values(spark, texts, "t string", text.first_match(F.col("t"), rules, "other")) == ["index", "macro", "other", "other"]
    assert values(spark, texts, "t string", text.all_matches(F.col("t"), rules, "other")) == [["index", "macro"], ["macro"], ["other"], ["other"]]
    assert values(spark, texts, "t string", F.size(text.hits(F.col("t"), ()))) == [0, 0, 0, 0]


def test_text_rules(spark):
    rows = ["It, however, fell", "これは上がる", "Apple rose", "", None]
    assert values(spark, rows, "t string", text.refers_to_subject(F.col("t"))) == [True, True, False, False, False]
    names = ["one two three four five", "one two three four five six", "十文字ちょうどの名前です", "短い", None]
    assert values(spark, names, "t string", text.too_long_name(F.col("t"))) == [False, True, True, False, False]
    walls = ["x" * 199 + "", "paywall", "paywall members " + "x" * 500, "paywall " + "x" * 500, "paywall members " + "x" * 2000]
    status = text.paywall_status(F.col("t"), ("paywall", "members"))
    assert values(spark, walls, "t string", status) == ["insufficient", "paywalled", "paywalled", "accessible", "accessible"]
    assert values(spark, ["abcdef", "abc", None], "t string", text.truncated(F.col("t"), 5)) == ["ab...", "abc", None]
    assert values(spark, [(None, "body"), ("s", "body"), ("", None)], "a string, b string", text.summary_or_start(F.col("a"), F.col("b"))) == ["body", "s", ""]
    assert values(spark, [" a \n\n b ", ""], "t string", text.clean_lines(F.col("t"))) == ["a\nb", ""]


@pytest.mark.parametrize(
    ("label", "kind", "key"),
    [
        ("FY2025", "annual", (2025, 0)), ("FY25", "annual", (2025, 0)), ("3Q25", "quarterly", (2025, 3)), ("1H26", "half_year", (2026, 1)),
        ("2FQ25", "annual", (9999, 0)), ("March", "half_year", (9999, 0)), (" 4q2024 ", "quarterly", (2024, 4)), ("", "annual", (9999, 0)),
    ],
)
def test_periods(spark, label, kind, key):
    df = spark.createDataFrame([(label,)], "p string").select(finance.period_type(F.col("p")).alias("t"), finance.period_key(F.col("p")).alias("k"))
    row = df.first()
    assert (row.t, tuple(row.k)) == (kind, key)


def test_trend_and_score(spark):
    rows = [(100.0, 101.0), (100.0, 101.01), (-50.0, -100.0), (0.0, 5.0), (100.0, 99.0)]
    pct = finance.change_pct(F.col("a"), F.col("b"))
    assert values(spark, rows, "a double, b double", pct) == [1.0, 1.01, -100.0, 0.0, -1.0]
    assert values(spark, rows, "a double, b double", finance.direction(pct)) == ["flat", "up", "down", "flat", "flat"]
    scores = [(20, 3, True), (1, 3, False), (0, 1, True), (7, 2, True)]
    score = lambda cap: finance.reliability_score(F.col("n"), F.col("t"), F.col("p"), cap=cap)
    assert values(spark, scores, "n int, t int, p boolean", score(100)) == [100, 30, 0, 100]
    assert values(spark, scores, "n int, t int, p boolean", score(None)) == [int(3 * 1.0 * 1.5 * 100), 30, 0, int(2 * 0.7 * 1.5 * 100)]
    assert values(spark, [45, 40, 35, 30, 29], "n int", finance.magnitude(F.col("n"))) == ["strong", "strong", "moderate", "moderate", "slight"]
