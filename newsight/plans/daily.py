"""The full daily run over boundary tables.

Hosted models and crawlers are outside: their inputs leave as tables (prompts,
fetch list) and their outputs enter as tables (replies, redirects, pages).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from newsight import settings
from newsight.operators.batches import (
    article_prompts,
    assign_batches,
    attach_analysis,
    batch_prompts,
    first_valid,
    parse_batch_replies,
    reconcile,
)
from newsight.operators.clusters import with_cluster_id
from newsight.operators.content import join_content, scrape
from newsight.operators.dedup import drop_repeats
from newsight.operators.export import export_columns
from newsight.operators.filters import above_threshold, has_content, unflagged
from newsight.plans.collect import collect
from newsight.plans.enrich import Scorers, article_clusters, score_texts
from newsight.session import materialise


@dataclass(frozen=True)
class Inputs:
    """Boundary tables of one run; columns as described by the operators that read them."""

    feeds: DataFrame
    search_pages: DataFrame
    batch_replies: DataFrame
    redirects: DataFrame
    pages: DataFrame
    article_replies: DataFrame
    vectors: DataFrame | None = None
    failures: DataFrame | None = None


def batched_articles(feeds: DataFrame, search_pages: DataFrame, as_of) -> DataFrame:
    """Collected articles with their batch; stored, as replies refer to these ids."""
    return materialise(assign_batches(collect(feeds, search_pages, as_of)), "batched")


def prompts(batched: DataFrame) -> DataFrame:
    """What leaves for the relevance model."""
    return batch_prompts(batched)


def score_relevance(
    batched: DataFrame, batch_replies: DataFrame, failures: DataFrame | None = None
) -> DataFrame:
    """Relevance of each article; ``failures(batch_id, error)`` explains batches without a reply."""
    results = first_valid(parse_batch_replies(batch_replies), "batch_id", "results")
    return reconcile(batched, results, failures)


def fetch_content(scored: DataFrame, redirects: DataFrame, pages: DataFrame, **options) -> DataFrame:
    """Articles over the threshold with text and status; stored, as text work is costly."""
    relevant = above_threshold(scored)
    content = scrape(relevant.select("url").distinct(), redirects, pages, **options)
    return materialise(join_content(relevant, content), "content")


def analysis_prompts(articles: DataFrame) -> DataFrame:
    """What leaves for the summary model, one prompt per article with title and content."""
    return article_prompts(articles, "ord")


def finish(
    articles: DataFrame,
    article_replies: DataFrame,
    scorers: Scorers,
    as_of,
    vectors: DataFrame | None = None,
    similarity: float = settings.SIMILARITY_THRESHOLD,
) -> DataFrame:
    """Clusters, analysis, flag filter, URL dedup, text scores, export typing.

    Replies are keyed by ``ord``. Clusters need every article, text scores only their
    own: so rows are first chosen on narrow columns, the wide rows are then joined
    once, and only rows that stay are scored. ``articles`` should be stored.
    """
    clusters = article_clusters(articles, vectors, "ord", similarity)
    keys = articles.select("ord", "url").filter("url is not null")
    # articles without title or content are never sent, so they have no analysis
    asked = articles.filter(has_content()).select("ord")
    analysed = attach_analysis(keys, article_replies, "ord", asked)
    chosen = materialise(unflagged(analysed), "chosen")
    chosen = with_cluster_id(drop_repeats(chosen, "url", "ord"), clusters, "ord")
    kept = articles.join(chosen.drop("url"), "ord")
    return export_columns(score_texts(kept, scorers), as_of)


def daily_run(inputs: Inputs, scorers: Scorers, as_of, **fetch_options) -> DataFrame:
    """All stages over tables that already hold every reply.

    Append the result with ``append_to_path`` or ``append_to_table``. When replies are
    made during the run, call the stage functions one by one.
    """
    batched = batched_articles(inputs.feeds, inputs.search_pages, as_of)
    scored = score_relevance(batched, inputs.batch_replies, inputs.failures)
    articles = fetch_content(scored, inputs.redirects, inputs.pages, **fetch_options)
    return finish(articles, inputs.article_replies, scorers, as_of, inputs.vectors)
