"""URLs as Column to Column functions; invalid ones give null or '' instead of errors."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

HTTP = r"(?i)^https?://[^/?#\s]+"


def looks_like_url(text: Column) -> Column:
    return F.trim(text).rlike(r"(?i)^https?://")


def is_url_key(key: Column) -> Column:
    """Attribute names that end in url or uri, alone or behind an underscore."""
    return key.rlike(r"(?i)(?:^|_)(?:url|uri)$")


def canonical_url(text: Column) -> Column:
    """Without query, fragment, default port and closing slashes, in lower case; '' if it is no URL."""
    url = F.trim(text)
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"(?i)^(http://[^/]*?):80(?=/|$)|^(https://[^/]*?):443(?=/|$)", "$1$2")
    return F.when(url.rlike(r"(?i)^[a-z][a-z0-9+.-]*:\S+$") & F.try_parse_url(url, F.lit("PROTOCOL")).isNotNull(), F.lower(F.regexp_replace(bare, "/+$", ""))).otherwise("")


def without_www(text: Column) -> Column:
    """For legal pages: without fragment and ``www.``."""
    return F.regexp_replace(F.regexp_replace(text, "#.*$", ""), r"(?i)^(https?://)www\.", "$1")


@F.pandas_udf(StringType())
def resolve(urls: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """A link (second) against its page (first)."""
    for base, link in urls:
        yield pd.Series([None if b is None or u is None else urljoin(b, u) for b, u in zip(base, link, strict=True)], dtype=object)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def segments(url: Column) -> Column:
    return F.filter(F.split(path_of(url), "/"), lambda x: x != "")


def is_detail_url(url: Column, first: str) -> Column:
    """Two segments, the first of them given."""
    return (F.size(segments(url)) == 2) & (F.get(segments(url), 0) == first)


def detail_slug(url: Column) -> Column:
    return F.lower(F.get(segments(url), 1))


def names_local_file(url: Column, rounds: int = 3) -> Column:
    """A drive or file path, also behind some rounds of percent-encoding."""
    seen, found = url, F.lit(False)
    for _ in range(rounds + 1):
        found = found | F.coalesce(seen.rlike(r"(?i)(?:^|/)file:|(?:^|[/\\])[a-z]:[/\\]"), F.lit(False))
        seen = F.coalesce(F.try_url_decode(F.replace(seen, F.lit("+"), F.lit("%2B"))), seen)
    return found


def official_url(url: Column) -> Column:
    """HTTP(S) pages; null for anything else, documents included."""
    return F.when(url.rlike(HTTP) & ~path_of(url).rlike(r"(?i)\.(?:pdf|docx?|xlsx?|pptx?|zip)$") & ~names_local_file(url), url)
