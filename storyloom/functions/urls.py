"""URL rules as native column expressions, and an exact Arrow form for unusual percent-encodings."""

from __future__ import annotations

from urllib.parse import parse_qsl, urlencode

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Query parameters that only track, by name and by prefix.
STRIP_PARAMS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "utm_referrer",
    "gclid", "gclsrc", "gbraid", "wbraid", "fbclid", "fb_action_ids", "fb_source", "fb_ref", "twclid", "msclkid",
    "hsa_acc", "hsa_cam", "hsa_grp", "hsa_ad", "hsa_src", "hsa_tgt", "hsa_kw", "hsa_mt", "hsa_net", "hsa_ver",
    "mc_cid", "mc_eid", "_ga", "igshid", "s_cid", "ncid", "cmpid", "mbid", "ref", "referrer", "session_id", "sharesource",
)
LEGACY_ONLY_PARAMS = ("source", "origin", "sid", "share")
STRIP_PREFIXES = ("utm_", "hsa_")

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def has_http_scheme(url: Column) -> Column:
    return F.coalesce(url.rlike(r"(?i)^https?://"), F.lit(False))


def _stripped(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"(?U)^\s+|\s+$", "")


def with_scheme(url: Column) -> Column:
    u = _stripped(url)
    own = u.rlike(_SCHEME + "//") | u.rlike(r"(?i)^https?:")
    return F.when(u == "", "").when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(own, u).otherwise(F.concat(F.lit("https://"), u))


def _params(query: Column, legacy: bool) -> Column:
    name = lambda p: F.lower(F.substring_index(p, "=", 1))
    gone = [*STRIP_PARAMS, *(LEGACY_ONLY_PARAMS if legacy else ())]
    prefixed = lambda p: F.lit(False) if legacy else name(p).startswith(STRIP_PREFIXES[0]) | name(p).startswith(STRIP_PREFIXES[1])
    kept = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]*=.") & ~name(p).isin(gone) & ~prefixed(p))
    pairs = F.array_sort(F.transform(kept, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), p.alias("p"))))
    return F.array_join(F.transform(pairs, lambda x: x["p"]), "&")


def normalise_url(url: Column, collapse_scheme: bool = True, legacy: bool = False) -> Column:
    """Canonical URL: scheme, host, path without doubled or trailing slashes, sorted parameters that mean something.

    Null gives ''.  Queries of plain characters stay in native code; those with an encoding are decoded, sorted and
    encoded anew in Arrow batches.  legacy: the rules before: any scheme but lower-case http(s):// is taken for a host,
    http stays, ports stay, and the parameters differ.
    """
    u = _stripped(url)
    u = F.when(u == "", "").when(u.rlike("^https?://"), u).otherwise(F.concat(F.lit("https://"), u)) if legacy else with_scheme(url)
    scheme = F.lower(F.regexp_extract(u, _SCHEME, 1))
    if collapse_scheme and not legacy:
        scheme = F.when(scheme == "http", "https").otherwise(scheme)
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^[^:/?#]+://([^/?#]*)", 1)), r"^www\.", "")
    if not legacy:
        host = F.regexp_replace(host, r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^:/?#]+:(?://[^/?#]*)?([^?#]*)", 1), r";[^/]*$", "")
    path = F.regexp_replace(path, "/{2,}", "/")
    path = F.when(F.length(path) > 1, F.regexp_replace(path, "/+$", "")).otherwise(path)
    raw = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    plain = raw.rlike("^[A-Za-z0-9_.~=&-]*$")
    query = F.when(plain, _params(raw, legacy)).otherwise((legacy_query if legacy else normalise_query)(F.when(~plain, raw)))
    return F.when(u == "", "").otherwise(F.concat(scheme, F.lit("://"), host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def _recoded(gone: frozenset, prefixes: tuple[str, ...]):
    def one(q: str | None) -> str | None:
        if q is None:
            return None
        return urlencode(sorted((k, v) for k, v in parse_qsl(q) if k.lower() not in gone and not k.lower().startswith(prefixes)))

    @F.pandas_udf(StringType())
    def run(query: pd.Series) -> pd.Series:
        return query.map(one)

    return run


#: A query string decoded, filtered, sorted and encoded anew; null stays null.
normalise_query = _recoded(frozenset(STRIP_PARAMS), STRIP_PREFIXES)
legacy_query = _recoded(frozenset(STRIP_PARAMS + LEGACY_ONLY_PARAMS), ())


def signed_sha64(text: Column) -> Column:
    """The first eight bytes of SHA-256, big-endian, as a signed 64-bit integer."""
    h = F.sha2(text.cast("binary"), 256)
    half = lambda at: F.conv(F.substring(h, at, 8), 16, 10).cast("bigint")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def url_hash(url: Column) -> Column:
    return signed_sha64(normalise_url(url))


def legacy_url_hash(url: Column) -> Column:
    return signed_sha64(normalise_url(url, legacy=True))


def hash_candidates(link: Column, guid: Column) -> Column:
    """Hashes under which an entry may be stored already: new and legacy ones of its link, or of its id where it has none."""
    url = F.coalesce(F.nullif(_stripped(link), F.lit("")), guid)
    return F.array_distinct(F.array(url_hash(url), legacy_url_hash(url)))


def domain(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(with_scheme(url), r"^[^:/?#]+://([^/?#]*)", 1)), r"^www\.", "")


def host_key(url: Column) -> Column:
    """Host without port and without www., m. and amp. in front, each once and in that order."""
    host = F.regexp_replace(F.lower(F.regexp_extract(with_scheme(url), r"^[^:/?#]+://([^/?#:]*)", 1)), r"^www\.", "")
    return F.regexp_replace(F.regexp_replace(host, r"^m\.", ""), r"^amp\.", "")


def is_paywalled(flag: Column, host: Column, domains: list[str]) -> Column:
    listed = F.lit(False)
    for d in domains:
        listed = listed | (host == d) | host.endswith("." + d)
    return F.coalesce(flag, F.lit(False)) | F.coalesce(listed, F.lit(False))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
