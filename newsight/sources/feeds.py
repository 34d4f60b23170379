"""Feed payloads (RSS or sitemap) -> article rows.

Input: ``feed_url string, source_ord long, payload string``. Both kinds are parsed
in the same projection and exploded once, so the payload table is read once.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.binding import let
from newsight.functions.dates import parse_date
from newsight.functions.text import strip
from newsight.functions.url import is_redirect, netloc
from newsight.operators.filters import recent
from newsight.sources.order import packed_ord
from newsight.schemas import ARTICLE_COLUMNS, RSS_ITEMS, RSS_XML, SITEMAP_XML

# past the XML declaration, instructions, comments and a doctype with or without subset
_PROLOG = (
    r"(?s)^\s*\x{FEFF}?\s*"
    r"(?:(?:<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^\[>]*+(?:\[.*?\]\s*)?>)\s*)*"
)
_RSS_ROOT = _PROLOG + r"<(?:[\w.\-]+:)?rss\b"
_ENTRIES = "array<struct<url string, date string, title string>>"
_KEEP_TEXT = {"ignoreSurroundingSpaces": "false"}


def _first(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def _unless_broken(parsed: Column, items: Callable[[Column], Column]) -> Column:
    """Entries of a parsed document, null if it is malformed anywhere; parses once."""
    return let(parsed, lambda doc: F.when(
        doc.isNotNull() & doc["_corrupt_record"].isNull(), items(doc)
    ))


def _rss_items(payload: Column) -> Column:
    """Items of every channel, then those beside the channels; none is not an error."""

    def items(doc: Column) -> Column:
        inside = F.flatten(F.filter(
            F.transform(doc["channel"], lambda c: c["item"]), lambda i: i.isNotNull()
        ))
        found = F.concat(*[
            F.coalesce(part, F.array().cast(RSS_ITEMS)) for part in (inside, doc["item"])
        ])
        return F.transform(
            found,
            lambda i: F.struct(
                _first(i["link"]).alias("url"),
                _first(i["pubDate"]).alias("date"),
                _first(i["title"]).alias("title"),
            ),
        )

    return _unless_broken(F.from_xml(payload, F.lit(RSS_XML), _KEEP_TEXT), items)


def _declares_any(payload: Column, namespaces: list[str], start: str) -> Column:
    """A start tag after ``start`` binds one of the namespaces, in either quotes."""
    uris = "|".join(re.escape(n) for n in namespaces)
    binding = rf"""\sxmlns(?::[\w.\-]+)?\s*=\s*(?:"(?:{uris})"|'(?:{uris})')"""
    return payload.rlike(start + r"<[\w.\-:]+[^<>]*?" + binding)


def _sitemap_items(payload: Column) -> Column:
    has_news = _declares_any(payload, settings.NEWS_NAMESPACES, "")

    def item(entry: Column) -> Column:
        news = F.when(has_news, _first(entry["news"]))
        return F.struct(
            _first(entry["loc"]).alias("url"),
            F.coalesce(_first(news["publication_date"]), _first(entry["lastmod"])).alias("date"),
            _first(news["title"]).alias("title"),
        )

    # prefixes are free to choose in XML, so names are matched without them
    options = {**_KEEP_TEXT, "ignoreNamespace": "true"}
    is_sitemap = _declares_any(payload, settings.SITEMAP_NAMESPACES, _PROLOG)
    return _unless_broken(
        F.from_xml(F.when(is_sitemap, payload), F.lit(SITEMAP_XML), options),
        lambda doc: F.coalesce(F.transform(doc["url"], item), F.array().cast(_ENTRIES)),
    )


def _is_rss() -> Column:
    return F.col("payload").rlike(_RSS_ROOT)


def _entries(payload: Column, is_rss: Column) -> Column:
    """Entries of a payload; null if it cannot be read."""
    return F.coalesce(
        _rss_items(F.when(is_rss, payload)), _sitemap_items(F.when(~is_rss, payload))
    )


def scan_feeds(feeds: DataFrame) -> DataFrame:
    """Every entry of every readable feed, before the recency cut.

    A malformed feed gives no rows and never fails the job; see ``feed_errors``.
    ``ord`` orders all rows: feed order first, then position in the payload.
    """
    is_rss = _is_rss()
    items = _entries(F.col("payload"), is_rss)
    entries = feeds.select(
        "feed_url", "source_ord", is_rss.alias("is_rss"), F.posexplode(items).alias("item_ord", "item")
    ).filter(F.length("item.url") > 0)
    source_ord = F.col("source_ord").cast("long")
    return entries.select(
        strip(F.col("item.url")).alias("url"),
        F.col("item.date").alias("date"),
        F.coalesce("item.title", F.lit("")).alias("title"),
        netloc(F.col("feed_url")).alias("source"),
        (F.col("is_rss") & is_redirect(F.col("feed_url"))).alias("is_google_redirect"),
        source_ord.alias("source_ord"),
        F.col("item_ord"),
        packed_ord(source_ord, F.col("item_ord")).alias("ord"),
        parse_date(F.col("item.date")).alias("ts"),
    ).select(*ARTICLE_COLUMNS)


def feed_errors(feeds: DataFrame) -> DataFrame:
    """Feeds that ``scan_feeds`` cannot read: no known root, malformed, empty or null.

    A well-formed ``urlset`` outside the sitemap namespaces is read, and has no entries.
    """
    payload = F.col("payload")
    other = F.from_xml(
        F.when(payload.rlike(_PROLOG + r"<(?:[\w.\-]+:)?urlset\b"), payload), F.lit(SITEMAP_XML)
    )
    plain = other.isNotNull() & other["_corrupt_record"].isNull()
    unread = _entries(payload, _is_rss()).isNull() & ~plain
    return feeds.filter(unread).select("feed_url", "source_ord")


def parse_feeds(feeds: DataFrame, as_of, hours: int = settings.RECENCY_HOURS) -> DataFrame:
    """Feed entries of the last ``hours``; entries without a readable date are dropped."""
    return scan_feeds(feeds).transform(recent, as_of=as_of, hours=hours, keep_undated=False)
