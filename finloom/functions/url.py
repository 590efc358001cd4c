"""URL expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track; the first two are prefixes.
TRACKING_PREFIXES = ("utm_", "guce_")
TRACKING_NAMES = (
    "ncid", "fbclid", "gclid", "ref", "source", "campaign", "si", "mc_cid", "mc_eid", "sref", "taid", "mod", "cmpid",
)


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$", group)


def host(url: Column) -> Column:
    """Host in lower case, with user and port as written; empty if the URL has none."""
    return F.lower(_part(url, 2))


def hostname(url: Column) -> Column:
    """Host without user and port; empty if the URL has none."""
    server = F.regexp_replace(host(url), "^.*@", "")
    return F.when(server.contains("["), F.regexp_extract(server, r"\[([^\]]*)", 1)).otherwise(F.substring_index(server, ":", 1))


def domain(url: Column) -> Column:
    """Host without a leading ``www.``."""
    return F.regexp_replace(host(url), r"^www\.", "")


def is_tracking(name: Column) -> Column:
    found = name.isin(*TRACKING_NAMES)
    for prefix in TRACKING_PREFIXES:
        found = found | name.startswith(prefix)
    return found


def normalize_url(url: Column) -> Column:
    """URL for duplicate comparison; null counts as empty.

    Trailing slashes go before the URL is taken apart; host in lower case and
    without ``www.``; no fragment, ``/index.html``, tracking parameter or blank
    value; values of a repeated name move to its first place.
    """
    plain = F.rtrim(F.coalesce(url, F.lit("")), F.lit("/"))
    scheme, path, query = _part(plain, 1), _part(plain, 3), _part(plain, 4)
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]*=.+"))
    names = F.array_distinct(F.transform(pairs, lambda p: F.substring_index(p, "=", 1)))
    kept = F.filter(names, lambda n: ~is_tracking(n))
    regrouped = F.flatten(F.transform(kept, lambda n: F.filter(pairs, lambda p: F.substring_index(p, "=", 1) == n)))
    has_host = F.length(_part(plain, 2)) > 0
    return F.concat(
        F.when(F.length(scheme) > 0, F.concat(F.lower(scheme), F.lit(":"))).otherwise(""),
        F.when(has_host, F.concat(F.lit("//"), domain(plain))).otherwise(""),
        F.regexp_replace(path, "/index\\.html$", ""),
        F.when(F.size(regrouped) > 0, F.concat(F.lit("?"), F.array_join(regrouped, "&"))).otherwise(""),
    )


def host_in(url: Column, domains: Iterable[str], of: Callable[[Column], Column] = host) -> Column:
    """Whether the host is one of ``domains`` or below one; never null.  ``of`` says
    what counts as the host: ``host``, with user and port, or ``hostname``."""
    of = of(url)
    found = F.lit(False)
    for d in domains:
        found = found | (of == d.lower()) | of.endswith("." + d.lower())
    return F.coalesce(found, F.lit(False))


def is_pdf(url: Column) -> Column:
    return F.coalesce(F.lower(_part(url, 3)).endswith(".pdf"), F.lit(False))


def is_web_url(url: Column) -> Column:
    """Scheme http or https, and a host."""
    return F.coalesce(_part(url, 1).isin("http", "https") & (F.length(_part(url, 2)) > 0), F.lit(False))


def same_site(url: Column, other: Column) -> Column:
    return is_web_url(url) & F.coalesce(host(url) == host(other), F.lit(False))


def has_segment(url: Column, segments: Iterable[str]) -> Column:
    found = F.lit(False)
    for s in segments:
        found = found | F.contains(url, F.lit(s))
    return F.coalesce(found, F.lit(False))
