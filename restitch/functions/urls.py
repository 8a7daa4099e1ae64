"""URL expressions, all native: page identity, query normalisation, parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SESSION_KEY = "phpsessid"


def url_path(url: Column) -> Column:
    """Path of a URL with or without scheme and host; '/' when it has none."""
    rest = F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*", "")
    path = F.regexp_extract(rest, r"^([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def url_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def _decode(s: Column) -> Column:
    return F.coalesce(F.try_url_decode(s), s)


def _encode(s: Column) -> Column:
    """Form encoding with '~' kept and '*' escaped."""
    return F.replace(F.replace(F.url_encode(s), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def query_pairs(query: Column) -> Column:
    """array<struct<k,v>>, sorted; session id, empty keys and repeated 'amp;' prefixes dropped."""
    parts = F.filter(F.split(query, "&"), lambda x: x != "")

    def pair(x: Column) -> Column:
        key = _decode(F.regexp_extract(x, r"^([^=]*)", 1))
        return F.struct(
            F.regexp_replace(key, r"^(amp;)+", "").alias("k"),
            _decode(F.regexp_extract(x, r"^[^=]*=(.*)$", 1)).alias("v"),
        )

    kept = F.filter(F.transform(parts, pair), lambda p: (p["k"] != "") & (F.lower(p["k"]) != SESSION_KEY))
    return F.array_sort(kept)


def page_identity(url: Column) -> Column:
    """Path plus sorted, re-encoded query; the host plays no part.  Null for null.

    Keys without a value ("?a") count as keys with an empty one ("?a=").
    """
    pairs = query_pairs(url_query(url))
    text = F.array_join(F.transform(pairs, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    query = F.when(~url.contains("?"), F.lit("")).otherwise(F.when(text == "", F.lit("")).otherwise(F.concat(F.lit("?"), text)))
    return F.when(url.isNotNull(), F.concat(url_path(url), query))


def extension(path: Column) -> Column:
    """Lower-case extension of the last path segment without the dot; '' when none ('.x' has none)."""
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*\.([^/.]*)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(path, r"(?<=[^/.])\.[^/.]*$", "")


def directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*/)", 1)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def is_own_host(url: Column, domain: str) -> Column:
    """Own host with or without www."""
    return F.regexp_replace(host(url), r"^www\.", "") == domain


def listing_sort(url: Column) -> Column:
    """Sort links of a directory listing: ?C=N;O=D"""
    return url_query(url).rlike(r"^[CO]=[A-Z](;|$)")
