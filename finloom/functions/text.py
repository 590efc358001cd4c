"""Text expressions and rules on one text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

JAPANESE = r"[぀-ヿ一-鿿ｦ-ﾟ]"
# Pronouns that refer to another sentence's subject.
PRONOUNS = ("it", "they", "this", "that", "these", "those", "he", "she", "we", "i")
PRONOUNS_JA = ("これ", "それ", "あれ", "同社", "当社", "彼", "彼女")


def _lits(values: Iterable[str]) -> Column:
    return F.array(*map(F.lit, values))


def word_set(text: Column) -> Column:
    """Distinct white-space words in lower case; null for null."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays of distinct words; 0 if one is empty."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / total).otherwise(F.lit(0.0))


def hits(text: Column, keywords: Sequence[str]) -> Column:
    """Keywords that occur in the text, case ignored, in the given order."""
    if not keywords:
        return F.array().cast("array<string>")
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(k.lower()).alias("low")) for k in keywords])
    return F.element_at(F.transform(_lowered(text), lambda t: F.transform(F.filter(pairs, lambda p: F.contains(t, p["low"])), lambda p: p["k"])), 1)


def _lowered(text: Column) -> Column:
    """The text in lower case in an array: a function of its element has it
    computed once, not once a keyword."""
    return F.array(F.lower(F.coalesce(text, F.lit(""))))


def has_any(text: Column, keywords: Sequence[str]) -> Column:
    if not keywords:
        return F.lit(False)
    return F.exists(_lowered(text), lambda t: reduce(Column.__or__, [F.contains(t, F.lit(k.lower())) for k in keywords]))


def matches_query(query: str, *fields: Column) -> Column:
    """Whether a field contains the query, case ignored; an empty query matches any field that is not null."""
    found = F.lit(False)
    for f in fields:
        found = found | F.coalesce(F.contains(F.lower(f), F.lit(query.lower())), F.lit(False))
    return found


def first_match(text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Name of the first rule one of whose keywords occurs."""
    out = F.lit(default)
    for name, words in reversed(rules):
        out = F.when(has_any(text, words), F.lit(name)).otherwise(out)
    return out


def all_matches(text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Names of all rules that match, or the default alone."""
    found = F.array_compact(F.array(*[F.when(has_any(text, words), F.lit(name)) for name, words in rules]))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default)))


def category_confidence(found: Column) -> Column:
    """A quarter for every keyword, 1 at most."""
    return F.least(F.size(found) * F.lit(0.25), F.lit(1.0))


def is_japanese(text: Column) -> Column:
    return F.coalesce(text.rlike(JAPANESE), F.lit(False))


def clean_lines(text: Column) -> Column:
    """Lines trimmed, empty ones dropped."""
    return F.array_join(F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != ""), "\n")


def truncated(text: Column, most: int, suffix: str = "...") -> Column:
    """At most ``most`` characters, the suffix included where cut."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - len(suffix))), F.lit(suffix))).otherwise(text)


def summary_or_start(summary: Column, content: Column, most: int = 200) -> Column:
    """The summary, else the content's first characters, else empty."""
    return F.coalesce(F.nullif(summary, F.lit("")), F.left(content, F.lit(most)), F.lit(""))


def is_noise(text: Column, least: int = 50, patterns: Sequence[str] = ()) -> Column:
    """Shorter than ``least`` characters, or a pattern is found."""
    found = F.length(F.coalesce(text, F.lit(""))) < least
    for p in patterns:
        found = found | F.coalesce(text.rlike(p), F.lit(False))
    return found


def paywall_status(text: Column, indicators: Sequence[str], short: int = 200, long: int = 1500) -> Column:
    """``insufficient`` for a text under ``short`` characters, ``paywalled`` for
    one with an indicator under ``short`` or two under ``long``, else ``accessible``."""
    n, size = F.size(hits(text, indicators)), F.length(F.coalesce(text, F.lit("")))
    walled = ((size < short) & (n >= 1)) | ((size < long) & (n >= 2))
    return F.when(walled, "paywalled").when(size < short, "insufficient").otherwise("accessible")


def refers_to_subject(text: Column) -> Column:
    """Starts with a pronoun; a blank text doesn't."""
    first = F.lower(F.regexp_replace(F.element_at(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+"), 1), r"[,.;:]+$", ""))
    ja = F.lit(False)
    for p in PRONOUNS_JA:
        ja = ja | F.coalesce(text.startswith(p), F.lit(False))
    return first.isin(*PRONOUNS) | ja


def too_long_name(name: Column, words: int = 5, characters: int = 10) -> Column:
    """Over ``characters`` if Japanese, else over ``words``."""
    n_words = F.size(F.filter(F.split(name, r"\s+"), lambda w: w != ""))
    return F.coalesce(F.when(is_japanese(name), F.length(name) > characters).otherwise(n_words > words), F.lit(False))


def slug(text: Column) -> Column:
    """Lower case, white space to hyphens."""
    return F.regexp_replace(F.lower(F.trim(text)), "[\\s　]+", "-")


def levenshtein_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(a, b) / longest).otherwise(F.lit(1.0))


def fenced_json(text: Column) -> Column:
    """What stands in the first fenced json block of an answer, or the trimmed answer."""
    inner = F.regexp_extract(text, r"(?s)```json\s*(.*?)\s*```", 1)
    return F.when(text.rlike(r"(?s)```json\s*.*?\s*```"), inner).otherwise(F.trim(text))


def before_marker(text: Column, marker: str) -> Column:
    """The text up to the first ``marker``; all of it without one."""
    return F.substring_index(text, marker, 1)


def should_fall_back(status: Column, content: Column, least: int = 200) -> Column:
    """Whether an extraction must be tried another way: it failed, or what it
    found is shorter than ``least``."""
    return (status == "failed") | ((status == "success") & (F.length(F.coalesce(content, F.lit(""))) < least))
