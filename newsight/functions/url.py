"""URL expressions, tolerant of anything found in feeds.

``parse_url`` answers null for non-ASCII paths and odd hosts, so URLs are taken
apart with plain string functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.binding import let

_LEADING_JUNK = "".join(chr(c) for c in range(0x21))
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"


def _tidy(url: Column) -> Column:
    return F.ltrim(F.translate(url, "\t\r\n", ""), F.lit(_LEADING_JUNK))


def netloc(url: Column) -> Column:
    """Authority part, user info, port and case kept; empty if there is none."""
    return F.regexp_extract(
        _tidy(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1
    )


def _decode(text: Column) -> Column:
    # a percent sign that starts no escape stands for itself
    safe = F.regexp_replace(text, r"%(?![0-9a-fA-F]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), text)


def _encode(text: Column) -> Column:
    encoded = F.url_encode(text)
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(
    url: Column, drop_params: list[str] | tuple[str, ...] = tuple(settings.TRACKING_PARAMS)
) -> Column:
    """URL without tracking parameters, blank parameters and fragment.

    Repeated keys are grouped at the key's first position and values re-encoded.
    A URL with a broken IPv6 host is returned as it is.
    """
    clean = _tidy(url)
    body = F.substring_index(clean, "#", 1)
    base = F.substring_index(body, "?", 1)
    query = F.substring(body, F.length(base) + 2, F.length(body))
    scheme = F.regexp_extract(base, _SCHEME, 1)
    base = F.concat(F.lower(scheme), F.substring(base, F.length(scheme) + 1, F.length(base)))

    def pair(item: Column) -> Column:
        name = F.substring_index(item, "=", 1)
        value = F.substring(item, F.length(name) + 2, F.length(item))
        return F.struct(_decode(name).alias("k"), _decode(value).alias("v"))

    pairs = F.filter(
        F.transform(F.split(query, "&"), pair),
        lambda p: (p["v"] != "") & ~p["k"].isin(list(drop_params)),
    )

    def grouped(pairs: Column) -> Column:
        keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
        ordered = F.flatten(F.transform(keys, lambda k: F.filter(pairs, lambda p: p["k"] == k)))
        return F.array_join(
            F.transform(
                ordered, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))
            ),
            "&",
        )

    kept = let(pairs, grouped)
    host = netloc(url)
    broken = F.contains(host, F.lit("[")) != F.contains(host, F.lit("]"))
    with_query = let(
        kept, lambda q: F.when(q == "", base).otherwise(F.concat(base, F.lit("?"), q))
    )
    return F.when(broken, url).when(query == "", base).otherwise(with_query)


def contains_any(text: Column, needles: list[str]) -> Column:
    """True if ``text`` contains one of a short literal list."""
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(text, F.lit(needle))
    return found


def is_redirect(url: Column, host: str = settings.REDIRECT_HOST) -> Column:
    return F.contains(url, F.lit(host))


def is_blocked(url: Column, domains: list[str] = settings.BLOCKED_DOMAINS) -> Column:
    return contains_any(F.lower(netloc(url)), domains)


def locale(url: Column, patterns: list[str] = settings.FRENCH_DOMAIN_PATTERNS) -> Column:
    french = contains_any(F.lower(netloc(url)), patterns)
    return F.when(french, F.lit(settings.FRENCH_LOCALE)).otherwise(
        F.lit(settings.OTHER_LOCALE)
    )
