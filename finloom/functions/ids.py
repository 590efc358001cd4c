"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL name space of RFC 4122.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Version-5 UUID of ``name``, from SHA-1 with version and variant set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def source_id(url: Column) -> Column:
    return uuid5(url)


def keyed_id(kind: str, *parts: Column) -> Column:
    """UUID of ``kind:part:part``: entities, topics, authors, stances, periods, chunks."""
    return uuid5(F.concat_ws(":", F.lit(kind), *parts))


def content_id(content: Column, kind: str | None = None, length: int = 32) -> Column:
    """First ``length`` hexadecimal digits of the SHA-256 of ``content`` or ``kind:content``."""
    text = content if kind is None else F.concat_ws(":", F.lit(kind), content)
    return F.substring(F.sha2(text, 256), 1, length)


def datapoint_id(source_hash: Column, metric: Column, period: Column) -> Column:
    return content_id(F.concat_ws(":", source_hash, metric, period))


def creator_topic_id(slug: Column, genre: Column) -> Column:
    return content_id(F.concat_ws(":", F.lit("topic"), slug, genre), length=8)
