"""Collect: feeds and search pages -> recent, deduplicated articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from newsight import settings
from newsight.operators.dedup import dedup_articles
from newsight.operators.filters import is_recent
from newsight.schemas import ARTICLE_COLUMNS
from newsight.session import materialise
from newsight.sources import parse_feeds
from newsight.sources.search import scan_results


def union_sources(feed_rows: DataFrame, search_rows: DataFrame) -> DataFrame:
    """All rows; ``ord`` puts feeds in list order first, then search results."""
    return feed_rows.unionByName(search_rows)


def _parsed(feeds: DataFrame, search_pages: DataFrame, as_of) -> DataFrame:
    """Recent feed entries and all search results in one stored table.

    Payloads are read and parsed in this one pass; everything behind it reads narrow rows.
    ``kept`` marks the rows that go on; search results also carry their page.
    """
    results = scan_results(search_pages, as_of)
    kept = (F.length("url") > 0) & is_recent(as_of, keep_undated=True)
    results = results.withColumn("kept", F.coalesce(kept, F.lit(False)))
    return union_sources(
        parse_feeds(feeds, as_of).withColumns({
            "kept": F.lit(True), "search_ord": F.lit(None).cast("long"), "page": F.lit(None).cast("long"),
        }),
        results.withColumns({c: F.col(c).cast("long") for c in ("search_ord", "page")}),
    )


def collect(feeds: DataFrame, search_pages: DataFrame, as_of) -> DataFrame:
    """Recent articles, each once; payloads are parsed once (runs a job)."""
    parsed = materialise(_parsed(feeds, search_pages, as_of).filter("kept"), "parsed")
    return dedup_articles(parsed.select(*ARTICLE_COLUMNS))


def collect_counted(feeds: DataFrame, search_pages: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """The articles of ``collect``, stored, and what each step kept and skipped (runs jobs).

    Counts are ``scope, search_ord, page, kept, skipped``: one row per search page with results
    (skipped ones are old or have no link), and one row of scope ``dedup`` with the rows that
    were left and removed. The totals are observed in the passes that write the rows; page counts
    read two columns of the parsed rows, never a payload.
    """
    raw, unique = Observation(), Observation()
    recent = F.count_if("kept").alias("rows")
    parsed = materialise(_parsed(feeds, search_pages, as_of).observe(raw, recent), "parsed")
    articles = dedup_articles(parsed.filter("kept").select(*ARTICLE_COLUMNS))
    articles = materialise(articles.observe(unique, F.count(F.lit(1)).alias("rows")), "collected")
    pages = parsed.filter(F.col("source_ord") >= settings.SEARCH_SOURCE_BASE).groupBy("search_ord", "page").agg(
        F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("skipped")
    )
    # an empty plan may end without metrics
    before, after = (o.get.get("rows", 0) for o in (raw, unique))
    total = articles.sparkSession.range(1).select(
        F.lit("dedup").alias("scope"), F.lit(None).cast("long").alias("search_ord"),
        F.lit(None).cast("long").alias("page"), F.lit(after).cast("long").alias("kept"),
        F.lit(before - after).cast("long").alias("skipped"),
    )
    return articles, pages.withColumn("scope", F.lit("page")).unionByName(total)
