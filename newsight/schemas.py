"""Explicit schemas of the stage boundaries."""

from __future__ import annotations

from pyspark.sql import types as T

RELEVANCE_JSON = (
    "array<struct<article_id string, relevance_score string, category string, "
    "reasoning string, key_indicators array<string>>>"
)
ANALYSIS_JSON = "array<struct<summary string, quebec string, perception string, Flag string>>"

# elements are arrays so that "the first one" is defined; text is kept untrimmed
RSS_ITEMS = "array<struct<link array<string>, pubDate array<string>, title array<string>>>"
RSS_XML = f"channel array<struct<item {RSS_ITEMS}>>, item {RSS_ITEMS}, _corrupt_record string"
SITEMAP_XML = (
    "url array<struct<loc array<string>, lastmod array<string>, "
    "news array<struct<title array<string>, publication_date array<string>>>>>, "
    "_corrupt_record string"
)
SEARCH_JSON = (
    "struct<news_results array<struct<link string, date string, title string, source string>>>"
)

ARTICLE_COLUMNS = [
    "url", "date", "title", "source", "is_google_redirect",
    "source_ord", "item_ord", "ord", "ts",
]

# fixed values: names, order and types of the result table
EXPORT_SCHEMA = T.StructType([
    T.StructField("url", T.StringType(), nullable=False),
    T.StructField("title", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("relevance_score", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("reasoning", T.StringType()),
    T.StructField("key_indicators", T.StringType()),
    T.StructField("scraped_content", T.StringType()),
    T.StructField("scrape_status", T.StringType()),
    T.StructField("sentiment", T.DoubleType()),
    T.StructField("cluster_id", T.LongType()),
    T.StructField("iptc_topic", T.StringType()),
    T.StructField("iptc_topic_fr", T.StringType()),
    T.StructField("Attrait", T.DoubleType()),
    T.StructField("Hebergement", T.DoubleType()),
    T.StructField("Restaurant", T.DoubleType()),
    T.StructField("quebec", T.StringType()),
    T.StructField("perception", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("processed_timestamp", T.TimestampNTZType()),
])

# fixed values
REQUIRED_ENRICHMENTS = [
    "sentiment", "cluster_id", "iptc_topic", "iptc_topic_fr",
    "Attrait", "Hebergement", "Restaurant", "quebec", "perception", "summary",
]
