"""Scans: feed payloads, search-result pages."""

from newsight.sources.feeds import feed_errors, parse_feeds, scan_feeds
from newsight.sources.search import parse_search_pages, scan_search_pages

__all__ = [
    "feed_errors", "parse_feeds", "scan_feeds", "parse_search_pages", "scan_search_pages",
]
