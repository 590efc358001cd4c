"""Times as publishers write them.  ``now`` is always a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats that listings use, tried in this order.
FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "MMM d, yyyy", "yyyy-MM-dd", "MM/dd/yyyy")


def parse_formats(text: Column, now: Column | None = None, formats: Sequence[str] = FORMATS) -> Column:
    """The first format that fits, without ``Z`` and fractions; else ``now`` or null."""
    plain = F.regexp_replace(F.trim(text), r"(\.\d+)?Z?$", "")
    tried = [F.try_to_timestamp(plain, F.lit(f)) for f in formats]
    return F.coalesce(*tried, *([] if now is None else [now]))


def parse_japanese(text: Column, now: Column | None = None) -> Column:
    """RFC 2822, else year, month and day with their signs, else ``now`` or null."""
    mail = F.try_to_timestamp(F.regexp_replace(text, "^[A-Za-z]{3}, *", ""), F.lit("d MMM yyyy HH:mm:ss Z"))
    part = lambda i: F.nullif(F.regexp_extract(text, r"(\d{4})年(\d{1,2})月(\d{1,2})日", i), F.lit(""))
    day = F.try_to_timestamp(F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")), F.lit("yyyy-MM-dd"))
    return F.coalesce(mail, day, *([] if now is None else [now]))


def parse_local(text: Column, zone: str = "Asia/Tokyo") -> Column:
    """ISO 8601; a time without an offset is one of ``zone``."""
    offset = text.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    return F.when(offset, F.try_to_timestamp(text)).otherwise(F.to_utc_timestamp(F.try_to_timestamp(text), zone))


def in_zone(text: Column, zone: str = "Asia/Tokyo") -> Column:
    """ISO 8601 as ``yyyy-MM-dd HH:mm`` of ``zone``; other text as it is."""
    return F.coalesce(F.date_format(F.from_utc_timestamp(F.try_to_timestamp(text), zone), "yyyy-MM-dd HH:mm"), text)


def recent(at: Column, now: Column, days: int, keep_null: bool) -> Column:
    """At most ``days`` before ``now``; a null time counts as given."""
    return F.coalesce(at >= now - F.make_interval(days=F.lit(days)), F.lit(keep_null))


def duration_ms(start: Column, end: Column) -> Column:
    """Milliseconds between ISO times; null if one can't be read."""
    return F.unix_millis(F.try_to_timestamp(end)) - F.unix_millis(F.try_to_timestamp(start))


def date_range(start: Column, end: Column) -> Column:
    """A period as a struct of text; what is missing is empty."""
    return F.struct(F.coalesce(start, F.lit("")).alias("start"), F.coalesce(end, F.lit("")).alias("end"))
