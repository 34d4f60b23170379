"""Boundary tables derived from the test tables, in Spark, over whole tables.

Odd cases (missing titles, cut payloads, redirects, broken replies) are set by row
number, and the oracle SQL sets them in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.url import canonical_url
from newsight.operators.batches import assign_batches
from newsight.operators.filters import has_content
from newsight.operators.scoring import lexicon_labels, lexicon_polarity
from newsight.plans.enrich import Scorers
from newsight.session import materialise

AS_OF = "2024-01-31 00:00:00"
EVENTS_AS_OF = "2024-01-30 12:00:00"
BLOCKED = ["blog.", "spam-farm", "cheap-pills", "casino-win"]
FRENCH = ["therti", "ththa", "m."]
SIMILARITY = 0.40
COPY_IDS = 1_000_000  # added to the ids of copied vectors
PER_PAYLOAD = 25
ARRIVALS = 3  # files of a stream of feeds
SHARED_VECTORS = 4  # neighbouring pages with one vector, so that a run has clusters

POSITIVE = ["the", "and", "les", "der", "que", "with", "un"]
NEGATIVE = ["of", "de", "is", "und", "la", "that", "en"]
WEIGHTS = {"the": 2, "les": 2, "und": 1, "que": 3, "of": -1, "de": -2, "la": -1, "ng": -4, "er": 1}
TOPICS = {
    "education": ["this", "are", "des", "und", "los"],
    "health": ["with", "from", "les", "der", "las"],
    "sport": ["and", "for", "une", "die", "del"],
    "weather": ["was", "by", "et", "das", "el"],
    "local notices": ["it", "be", "le", "den", "y"],
}
LABELS = {
    "tourism event/attraction": ["the", "la", "die"],
    "hotel/lodging": ["of", "de", "der", "en"],
    "restaurant": ["in", "que", "und", "a"],
}

SCORERS = Scorers(
    sentiment=lexicon_polarity(POSITIVE, NEGATIVE),
    topic=lexicon_labels(TOPICS),
    labels=lexicon_labels(LABELS),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _xml(text):
    escaped = text
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(entity))
    return escaped


# ---- feeds and search pages --------------------------------------------------


def page_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed entry per page: url, title and time, with gaps."""
    i = F.col("page_id")
    ts = F.lit(AS_OF).cast("timestamp_ntz") - F.make_dt_interval(mins=((i * 37) % 2880).cast("int"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(i % 17 == 16, F.lit("")).otherwise(F.col("url")).alias("url"),
        F.when(i % 10 != 9, F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"),
        F.when(i % 13 != 12, ts).alias("at"),
        F.floor(i / PER_PAYLOAD).cast("long").alias("source_ord"),
    )


def _payloads(entries: DataFrame, item, head: str, tail: str) -> DataFrame:
    """One document per 25 entries; every ninth is cut off, every fifth is a redirect feed."""
    n = F.col("source_ord")
    docs = entries.groupBy("source_ord").agg(
        F.array_sort(F.collect_list(F.struct("page_id", item.alias("xml")))).alias("items")
    )
    body = F.array_join(F.transform("items", lambda x: x["xml"]), "\n")
    end = F.when(n % 9 == 8, F.lit("")).otherwise(F.lit(tail))
    host = F.concat(F.lit("https://feed"), (n % 7).cast("string"), F.lit(".example.org/all.xml"))
    return docs.select(
        F.when(n % 5 == 4, F.lit("https://news.google.com/rss/search")).otherwise(host).alias("feed_url"),
        "source_ord",
        F.concat(F.lit(head), body, end).alias("payload"),
    )


def rss_feeds(entries: DataFrame) -> DataFrame:
    date = F.concat(F.date_format("at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    item = F.concat(
        F.lit("<item><link>"),
        F.when(F.col("url") == "", F.lit("")).otherwise(F.concat(F.lit(" "), _xml(F.col("url")), F.lit(" "))),
        F.lit("</link>"),
        F.coalesce(F.concat(F.lit("<title>"), _xml(F.col("title")), F.lit("</title>")), F.lit("")),
        F.coalesce(F.concat(F.lit("<pubDate>"), date, F.lit("</pubDate>")), F.lit("")),
        F.lit("</item>"),
    )
    return _payloads(
        entries, item, '<?xml version="1.0"?>\n<rss version="2.0"><channel>', "</channel></rss>"
    )


def sitemap_feeds(entries: DataFrame) -> DataFrame:
    """News entries carry a publication date, every third only a last-modified day."""
    iso = F.concat(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    day = F.date_format("at", "yyyy-MM-dd")
    news = F.concat(
        F.lit("<n:news>"),
        F.coalesce(
            F.concat(
                F.lit("<n:publication_date>"),
                F.when(F.col("page_id") % 3 != 2, iso),
                F.lit("</n:publication_date>"),
            ),
            F.lit(""),
        ),
        F.coalesce(F.concat(F.lit("<n:title>"), _xml(F.col("title")), F.lit("</n:title>")), F.lit("")),
        F.lit("</n:news>"),
    )
    item = F.concat(
        F.lit("<url><loc>"), _xml(F.col("url")), F.lit("</loc>"),
        F.coalesce(F.concat(F.lit("<lastmod>"), day, F.lit("</lastmod>")), F.lit("")),
        news, F.lit("</url>"),
    )
    head = (
        '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" '
        'xmlns:n="http://www.google.com/schemas/sitemap-news/0.9">'
    )
    return _payloads(entries, item, head, "</urlset>")


def search_pages(entries: DataFrame) -> DataFrame:
    """JSON result pages of 25: objects or strings as source, relative dates, redirects."""
    i = F.col("page_id")
    link = F.when(
        i % 6 == 5, F.concat(F.lit("https://news.google.com/articles/"), i.cast("string"))
    ).otherwise(F.col("url"))
    n = (i % 50).cast("string")
    date = (
        F.when(i % 4 == 0, F.concat(n, F.lit(" hours ago")))
        .when(i % 4 == 1, F.concat(n, F.lit(" minutes ago")))
        .when(i % 4 == 2, F.date_format("at", "MMM d, yyyy, h:mm a"))
        .otherwise(F.lit("some time ago"))
    )
    name = F.concat(F.lit("paper"), (i % 8).cast("string"))
    source = (
        F.when(i % 15 == 0, F.lit('{"icon":"x"}'))
        .when(i % 5 == 0, F.concat(F.lit('"'), name, F.lit('"')))
        .otherwise(F.concat(F.lit('{"name":"'), name, F.lit('"}')))
    )
    fields = F.to_json(F.struct(link.alias("link"), date.alias("date"), F.col("title").alias("title")))
    item = F.concat(F.left(fields, F.length(fields) - 1), F.lit(',"source":'), source, F.lit("}"))
    return (
        entries.groupBy("source_ord")
        .agg(F.array_sort(F.collect_list(F.struct("page_id", item.alias("json")))).alias("items"))
        .select(
            F.col("source_ord").alias("search_ord"),
            F.lit(1).cast("long").alias("page"),
            F.concat(
                F.lit('{"news_results":['),
                F.array_join(F.transform("items", lambda x: x["json"]), ","),
                F.lit("]}"),
            ).alias("payload"),
        )
    )


def conflict_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with coarse URL keys and partly blank titles, so that both keys collide."""
    i = F.col("page_id")
    canonical = canonical_url(F.col("url"))
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract(canonical, "^https?://([^/]*/[a-z]+)", 1).alias("url_key"),
        F.when(i % 9 != 0, title).alias("title_key"),
    )


# ---- relevance replies -------------------------------------------------------


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.col("quality") * 60 + F.col("doc_id") % 40
    return table(spark, sf_dir, "labels").select(
        "doc_id", "quality", "toxic", score.cast("int").alias("score")
    )


def category_of(score):
    return (
        F.when(score >= 90, F.lit("HIGHLY_RELEVANT"))
        .when(score >= 80, F.lit("MODERATELY_RELEVANT"))
        .when(score >= 10, F.lit("LOW_RELEVANCE"))
        .otherwise(F.lit("NOT_RELEVANT"))
    )


def label_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents in consecutive batches."""
    return materialise(assign_batches(scored_labels(spark, sf_dir), "doc_id"), "label-batches")


def _reply_item(score, extra: str = ""):
    i = F.col("doc_id")
    number = score.cast("string")
    quoted = F.when(i % 5 == 0, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    cut = F.when(i % 3 == 0, F.lit(r"\u12 ")).otherwise(F.lit(""))
    return F.concat(
        F.lit('{"article_id":"'), F.col("batch_index").cast("string"),
        F.lit('","relevance_score":'), quoted,
        F.lit(',"category":"'), category_of(score),
        F.lit('","reasoning":"'), F.lit(extra), F.lit("thème "), cut, i.cast("string"),
        F.lit('","key_indicators":["q'), F.col("quality").cast("string"),
        F.lit('","t'), F.col("toxic").cast("string"), F.lit('"]}'),
    )


def batch_replies(batched: DataFrame) -> DataFrame:
    """Replies as a model might send them.

    Every 13th object is missing, every 17th comes again at the end with a higher
    score; even batches are fenced; every fourth batch answers with prose first;
    every seventh never answers with JSON.
    """
    i, b = F.col("doc_id"), F.col("batch_id")
    once = F.when(i % 13 != 0, F.struct(F.lit(0).alias("dup"), "batch_index", _reply_item(F.col("score")).alias("json")))
    again = F.when(
        i % 17 == 0,
        F.struct(F.lit(1).alias("dup"), "batch_index", _reply_item(F.col("score") + 1, "again ").alias("json")),
    )
    items = batched.select("batch_id", F.explode(F.array_compact(F.array(once, again))).alias("item"))
    clean = items.groupBy("batch_id").agg(F.array_sort(F.collect_list("item")).alias("items")).select(
        "batch_id",
        F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["json"]), ","), F.lit("]")).alias("json"),
    )
    fenced = F.when(
        b % 2 == 0, F.concat(F.lit("```json\n"), F.col("json"), F.lit("\n```"))
    ).otherwise(F.concat(F.lit(" "), F.col("json"), F.lit("\n")))
    good = F.struct(F.when(b % 4 == 3, 2).otherwise(1).alias("attempt"), fenced.alias("raw"))
    prose = F.struct(F.lit(1).alias("attempt"), F.lit("Here is the list: [").alias("raw"))
    never = F.transform(
        F.sequence(F.lit(1), F.lit(5)), lambda a: F.struct(a.alias("attempt"), F.lit("{").alias("raw"))
    )
    sent = (
        F.when(b % 7 == 6, never)
        .when(b % 4 == 3, F.array(prose, good))
        .otherwise(F.array(good))
    )
    return clean.select("batch_id", F.inline(sent))


def batch_failures(batched: DataFrame) -> DataFrame:
    """Errors of some batches; those of every fourth were mended by a later attempt."""
    b = F.col("batch_id")
    text = F.concat(F.lit("429 RESOURCE_EXHAUSTED: the quota for batch "), b.cast("string"), F.lit(" is used up, try again later"))
    return batched.select("batch_id").distinct().filter((b % 14 == 6) | (b % 4 == 3)).filter(b % 14 != 13).select(
        "batch_id", text.alias("error")
    )


def article_labels(batched: DataFrame) -> DataFrame:
    """Scores for the articles of a run, in the shape ``batch_replies`` expects."""
    return batched.select(
        "batch_id",
        "batch_index",
        F.col("ord").alias("doc_id"),
        F.lit(1).alias("quality"),
        F.lit(0).alias("toxic"),
        (F.col("ord") % 40 + 60).cast("int").alias("score"),
    )


# ---- pages as fetch results --------------------------------------------------


def redirected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages keyed by the URL in the feed; every sixth is a redirect URL."""
    i = F.col("page_id")
    wrapped = F.concat(F.lit("https://news.google.com/rss/articles/"), i.cast("string"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(i % 6 == 5, wrapped).otherwise(F.col("url")).alias("url"),
        F.col("url").alias("true_url"),
    )


def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known targets: some redirects are missing, empty, or lead to a redirect again."""
    i = F.col("page_id")
    target = (
        F.when(i % 30 == 5, F.lit(""))
        .when(i % 30 == 11, F.lit("https://news.google.com/home"))
        .otherwise(F.col("true_url"))
    )
    return (
        redirected_pages(spark, sf_dir)
        .filter((i % 6 == 5) & (i % 24 != 23))
        .select("url", target.alias("target"))
    )


def article_redirects(spark: SparkSession, sf_dir: str, articles: DataFrame) -> DataFrame:
    """Targets of the redirect URLs among ``articles``; every fourth is unknown."""
    page = F.regexp_extract("url", r"articles/(\d+)$", 1).try_cast("long")
    known = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("target"))
    return (
        articles.select("url", page.alias("page_id"))
        .filter("page_id % 24 <> 23")
        .distinct()
        .join(known, "page_id")
        .select("url", "target")
    )


def article_vectors(spark: SparkSession, sf_dir: str, articles: DataFrame) -> DataFrame:
    """Embedding of the page behind each article that has content; neighbours share one."""
    search = F.col("source_ord") - settings.SEARCH_SOURCE_BASE
    payload = F.when(search < 0, F.col("source_ord")).otherwise(
        F.shiftright(search, settings.SEARCH_PAGE_BITS)
    )
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("page_id"), "embedding")
    return (
        articles.filter(has_content(title=None))
        .select("ord", (payload * PER_PAYLOAD + F.col("item_ord")).alias("number"))
        .select("ord", (F.col("number") - F.col("number") % SHARED_VECTORS).alias("page_id"))
        .join(vectors, "page_id")
        .select("ord", "embedding")
    )


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page table as a fetcher would leave it: ten kinds of outcome by page number."""
    i = F.col("page_id")
    long_error = F.lit("net::ERR_CONNECTION_RESET while reading the response of the server")
    return (
        table(spark, sf_dir, "pages")
        .select(
            "page_id",
            "url",
            F.when(i % 10 == 7, F.lit("<html><p>short</p></html>"))
            .when(i % 10 != 8, F.col("html"))
            .alias("html"),
            F.when(i % 10 == 3, 403).when(i % 10 == 4, 429).otherwise(200).alias("http_status"),
            F.when(i % 10 == 5, F.lit("timeout")).when(i % 10 == 6, long_error).alias("error"),
            F.when(i % 10 == 1, F.concat("url", F.lit("&seen=1"))).otherwise(F.col("url")).alias("final_url"),
        )
    )


def unique_pages(pages: DataFrame) -> DataFrame:
    """One row per URL, the key of a page table."""
    from newsight.operators.dedup import keep_first

    return keep_first(pages, ["url"], ["page_id"]).drop("page_id")


# ---- analyses ----------------------------------------------------------------


def _pick(index, values: list[str]):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int") + 1)


PERCEPTIONS = ["Négatif", "neutralle", "POSITIF", "mixed", " neutre ", "negative"]
PLACES = ["oui", "NON", " Oui ", "maybe", "non"]
FLAGS = ["0", "1", " 0", "2", "0", "0", "1"]


def raw_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysis fields from conversation turns, many of them out of range."""
    n = F.col("conv_id") + F.col("turn")
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.col("text").alias("summary"),
        _pick(n, PLACES).alias("quebec"),
        _pick(n, PERCEPTIONS).alias("perception"),
        _pick(n, FLAGS).alias("Flag"),
    )


def flagged_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an analysis flag; every fifth has none."""
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("summary"),
        F.when(i % 5 != 4, (i % 3 == 1).cast("int").cast("string")).alias("Flag"),
    )


def article_replies(keys: DataFrame, key: str) -> DataFrame:
    """Analysis replies per article: fenced, listed, rejected first, or never usable."""
    i = F.col(key)
    good = F.to_json(F.struct(
        F.concat(F.lit("Résumé "), i.cast("string")).alias("summary"),
        _pick(i, ["oui", "NON"]).alias("quebec"),
        _pick(i, ["Positif", "neutre", "négative"]).alias("perception"),
        (i % 4 == 1).cast("int").alias("Flag"),
    ))
    bad = F.replace(good, F.lit('"perception":"'), F.lit('"perception":"not '))
    shaped = (
        F.when(i % 3 == 0, F.concat(F.lit("```json\n"), good, F.lit("\n```")))
        .when(i % 3 == 1, F.concat(F.lit("["), good, F.lit("]")))
        .otherwise(good)
    )
    first, second = F.lit(1).alias("attempt"), F.lit(2).alias("attempt")
    sent = (
        F.when(i % 11 == 10, F.array(F.struct(first, bad.alias("raw"))))
        .when(i % 5 == 2, F.array(F.struct(first, bad.alias("raw")), F.struct(second, shaped.alias("raw"))))
        .otherwise(F.array(F.struct(first, shaped.alias("raw"))))
    )
    return keys.select(key, F.inline(sent))


# ---- documents as scraped articles -------------------------------------------


def document_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles with content; some partial, some without content or title."""
    i = F.col("doc_id")
    score = (i % 60 + 40).cast("int")
    return table(spark, sf_dir, "documents").select(
        i.alias("ord"),
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), (i % 900).cast("string")).alias("url"),
        F.date_format(
            F.lit(AS_OF).cast("timestamp_ntz") - F.make_dt_interval(mins=(i % 1440).cast("int")),
            "yyyy-MM-dd HH:mm:ss",
        ).alias("date"),
        F.when(i % 19 != 18, F.split_part("text", F.lit("\n"), F.lit(1))).alias("title"),
        "source",
        score.alias("relevance_score"),
        category_of(score).alias("category"),
        F.concat(F.lit("doc "), i.cast("string")).alias("reasoning"),
        F.lit("a, b").alias("key_indicators"),
        F.when(i % 23 == 22, F.lit(" \n")).when(i % 29 != 28, F.col("text")).alias("scraped_content"),
        F.when(i % 4 == 3, F.lit("partial")).otherwise(F.lit("success")).alias("scrape_status"),
    )


def document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ord"), "embedding")
