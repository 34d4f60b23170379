"""From scored articles to page text: redirects, fetch list, outcome, join back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.html import page_text
from newsight.functions.url import is_blocked, is_redirect, locale, netloc
from newsight.operators.bloom import bloom_words, maybe_in
from newsight.operators.filters import above_threshold
from newsight.operators.numbering import with_row_number
from newsight.session import materialise


def resolve_redirects(urls: DataFrame, redirects: DataFrame) -> DataFrame:
    """Add ``fetch_url``: the publisher URL of a redirect, null if unresolved.

    ``redirects`` is ``(url, target)`` with unique ``url``; empty targets and
    targets that are redirects again do not count.
    """
    usable = redirects.filter(
        (F.length("target") > 0) & ~is_redirect(F.col("target"))
    ).select("url", "target")
    return (
        urls.join(usable, "url", "left")
        .withColumn(
            "fetch_url", F.when(is_redirect(F.col("url")), F.col("target")).otherwise(F.col("url"))
        )
        .drop("target")
    )


def fetch_list(
    scored: DataFrame,
    threshold: float = settings.RELEVANCE_THRESHOLD,
    batch_size: int = settings.FETCH_BATCH_SIZE,
    blocked: list[str] = settings.BLOCKED_DOMAINS,
) -> DataFrame:
    """Distinct unblocked URLs over the threshold, for an external fetcher.

    ``fetch_batch`` counts from 1 in first-seen order, ``domain_seq`` per netloc.
    A netloc with a large share of the URLs is numbered over many tasks.
    """
    urls = (
        above_threshold(scored, threshold=threshold)
        .filter(~is_blocked(F.col("url"), blocked))
        .groupBy("url")
        .agg(F.min("ord").alias("ord"))
        .withColumn("domain", netloc(F.col("url")))
    )
    batched = with_row_number(urls, ["ord"], name="_n").withColumn(
        "fetch_batch", (F.floor((F.col("_n") - 1) / batch_size) + 1).cast("long")
    )
    numbered = with_row_number(batched.drop("_n"), ["ord"], ["domain"], name="domain_seq")
    return numbered.select(
        "url", "domain", "fetch_batch", "domain_seq", locale(F.col("url")).alias("locale")
    )


def scrape_outcome(
    fetched: DataFrame,
    blocked: list[str] = settings.BLOCKED_DOMAINS,
    min_chars: int = settings.MIN_CONTENT_CHARS,
) -> DataFrame:
    """Content, status and resolved URL of each fetched URL.

    Input: ``url, fetch_url`` (see ``resolve_redirects``), ``html, http_status,
    error, final_url``. ``error`` is ``'timeout'`` or an exception text. Text is
    extracted only for rows that got a page.
    """
    url, fetch_url = F.col("url"), F.col("fetch_url")
    skipped = is_blocked(url, blocked)
    unresolved = fetch_url.isNull()
    target_blocked = (fetch_url != url) & is_blocked(fetch_url, blocked)
    refused = F.col("http_status").isin(settings.FETCH_REFUSED)
    timed_out = F.col("error") == "timeout"
    failed = F.col("error").isNotNull()
    no_page = skipped | unresolved | target_blocked | F.coalesce(refused, F.lit(False)) | failed
    text = F.when(~no_page, page_text(F.col("html")))
    with_text = fetched.withColumn("content", text)
    status = (
        F.when(skipped, F.lit("skipped"))
        .when(unresolved, F.lit("redirect_failed"))
        .when(target_blocked, F.lit("skipped"))
        .when(refused, F.concat(F.lit("error: "), F.col("http_status").cast("string")))
        .when(timed_out, F.lit("timeout"))
        .when(
            failed,
            F.concat(F.lit("error: "), F.substring("error", 1, settings.ERROR_TEXT_CHARS)),
        )
        .when(F.length("content") > min_chars, F.lit("success"))
        .otherwise(F.lit("partial"))
    )
    resolved = (
        F.when(skipped | unresolved, url)
        .when(target_blocked | F.coalesce(refused, F.lit(False)) | failed, fetch_url)
        .otherwise(F.coalesce("final_url", fetch_url))
    )
    return with_text.select(
        "url", "content", status.alias("status"), resolved.alias("resolved_url")
    )


def scrape(urls: DataFrame, redirects: DataFrame, pages: DataFrame, **options) -> DataFrame:
    """Distinct ``url`` rows -> content table, via redirects and the page table.

    ``pages`` is ``(url, html, http_status, error, final_url)`` keyed by the fetched
    URL. URLs that need no page still get their status; others without a page
    are absent, as if they had not been fetched yet. The wanted URLs are stored first (runs a job);
    a Bloom filter of them thins the page table out where it is read, so HTML of other pages
    never moves. Text extraction comes after the join.
    """
    resolved = resolve_redirects(urls.select("url"), redirects)
    # unresolved rows join on their own URL: null keys would all meet in one task
    wanted = materialise(resolved.withColumn("_page", F.coalesce("fetch_url", "url")), "wanted")
    thinned = maybe_in(pages, "url", bloom_words(wanted, "_page"))
    found = thinned.withColumnRenamed("url", "_page").withColumn("_found", F.lit(True))
    fetched = wanted.join(found, "_page", "left")
    blocked = options.get("blocked", settings.BLOCKED_DOMAINS)
    needs_none = (
        is_blocked(F.col("url"), blocked)
        | F.col("fetch_url").isNull()
        | is_blocked(F.col("fetch_url"), blocked)
    )
    return scrape_outcome(fetched.filter(F.col("_found") | needs_none), **options)


def join_content(articles: DataFrame, content: DataFrame) -> DataFrame:
    """Add content and status by URL and swap in the resolved URL.

    Articles whose URL was not fetched keep it and get nulls.
    """
    keep = [c for c in articles.columns if c != "url"]
    joined = articles.join(content, "url", "left")
    return joined.select(
        F.coalesce("resolved_url", "url").alias("url"),
        *keep,
        F.col("content").alias("scraped_content"),
        F.col("status").alias("scrape_status"),
    )
