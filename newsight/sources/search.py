"""Saved search-result pages (JSON) -> article rows.

Input: ``search_ord long, page long, payload string``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.dates import parse_relative_date
from newsight.functions.url import is_redirect
from newsight.operators.filters import recent
from newsight.schemas import ARTICLE_COLUMNS, SEARCH_JSON
from newsight.sources.order import packed_ord, search_source_ord


def scan_results(pages: DataFrame, as_of) -> DataFrame:
    """Every result of every page, with ``search_ord`` and ``page``; ``url`` may be missing."""
    source_ord = search_source_ord(F.col("search_ord"), F.col("page"))
    results = pages.select(
        "search_ord", "page", source_ord.alias("source_ord"),
        F.posexplode(F.from_json("payload", SEARCH_JSON)["news_results"]).alias("item_ord", "item"),
    )
    source = F.col("item.source")
    # an object read as a string keeps its JSON text
    named = F.coalesce(F.get_json_object(source, "$.name"), F.lit(settings.DEFAULT_SEARCH_SOURCE))
    return results.select(
        F.col("item.link").alias("url"),
        F.coalesce("item.date", F.lit("")).alias("date"),
        F.coalesce("item.title", F.lit("")).alias("title"),
        F.when(source.isNull(), F.lit(settings.DEFAULT_SEARCH_SOURCE))
        .when(source.startswith("{"), named)
        .otherwise(source)
        .alias("source"),
        is_redirect(F.col("item.link")).alias("is_google_redirect"),
        "source_ord",
        "item_ord",
        packed_ord(F.col("source_ord"), F.col("item_ord")).alias("ord"),
        parse_relative_date(F.col("item.date"), as_of).alias("ts"),
        "search_ord",
        "page",
    )


def scan_search_pages(pages: DataFrame, as_of) -> DataFrame:
    """Every result with a link, before the recency cut."""
    return scan_results(pages, as_of).filter(F.length("url") > 0).select(*ARTICLE_COLUMNS)


def parse_search_pages(pages: DataFrame, as_of, hours: int = settings.RECENCY_HOURS) -> DataFrame:
    """Results not known to be older than ``hours``; undated ones are kept."""
    return scan_search_pages(pages, as_of).transform(
        recent, as_of=as_of, hours=hours, keep_undated=True
    )
