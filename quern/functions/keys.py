"""Content hashes, stable keys and canonical addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import trimmed

# Query parameters that only track visits.
TRACKING = ["fbclid", "gclid", "ref", "source", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term"]
#: Scheme, authority, path, query of an address.
_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def content_hash(body: Column) -> Column:
    return F.sha2(body, 256)


def stable_key(namespace: Column, value: Column) -> Column:
    """Hash of the lower-cased namespace and the value, both trimmed."""
    return F.sha2(F.concat_ws(":", F.lower(trimmed(namespace)), trimmed(value)), 256)


def host(url: Column) -> Column:
    """Lower-case host without user and port; empty if there is none."""
    authority = F.regexp_extract(trimmed(url), _PARTS, 2)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r":\d*$", ""))


def is_web_url(url: Column) -> Column:
    """The scheme is http or https and there is a host."""
    scheme = F.lower(F.regexp_extract(url, _PARTS, 1))
    return F.coalesce(scheme.isin("http", "https") & (host(url) != ""), F.lit(False))


def canonical_url(url: Column) -> Column:
    """One spelling of an address: lower-case scheme and host, no user, fragment, default port,
    doubled or last slash; query parameters sorted, tracking ones dropped, blank ones kept."""
    u = trimmed(url)
    scheme = F.lower(F.regexp_extract(u, _PARTS, 1))
    port = F.regexp_extract(F.regexp_extract(u, _PARTS, 2), r":(\d+)$", 1)
    default = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    path = F.regexp_replace(F.regexp_extract(u, _PARTS, 3), "/{2,}", "/")
    path = F.when(path.isin("", "/"), F.lit("/")).otherwise(F.regexp_replace(path, "/+$", ""))
    pairs = F.transform(
        F.filter(F.split(F.regexp_extract(u, _PARTS, 4), "&"), lambda x: x != ""),
        lambda x: F.struct(F.regexp_extract(x, "^[^=]*", 0).alias("k"), F.regexp_extract(x, "=(.*)$", 1).alias("v")),
    )
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(TRACKING)))
    query = F.array_join(F.transform(kept, lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")
    return F.concat(scheme, F.lit("://"), host(u), F.when(default, "").otherwise(F.concat(F.lit(":"), port)), path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
