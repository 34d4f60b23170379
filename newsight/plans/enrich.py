"""Enrich: sentiment, cluster, topic and label scores of articles with content."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from newsight import settings
from newsight.operators.clusters import cluster_articles, cluster_texts, with_cluster_id
from newsight.operators.filters import has_content
from newsight.operators.models import doc_vectors
from newsight.operators.scoring import ArrayScorer, with_label_scores, with_sentiment, with_topic


@dataclass(frozen=True)
class Scorers:
    """The pluggable models of one run."""

    sentiment: ArrayScorer
    topic: ArrayScorer
    labels: ArrayScorer


def article_clusters(
    articles: DataFrame,
    vectors: DataFrame | None = None,
    id_col: str = "ord",
    threshold: float = settings.SIMILARITY_THRESHOLD,
) -> DataFrame:
    """``(id, cluster_id)`` of the clustered articles.

    ``vectors`` is ``(id_col, embedding)``; without it sparse TF-IDF vectors of the
    articles with content are used.
    """
    if vectors is None:
        eligible = articles.filter(has_content(title=None)).select(id_col, "scraped_content")
        return cluster_texts(doc_vectors(eligible, id_col, "scraped_content"), id_col, threshold)
    return cluster_articles(vectors, id_col, "embedding", threshold)


def score_texts(articles: DataFrame, scorers: Scorers) -> DataFrame:
    """Sentiment, topic and label scores, all computed in the row."""
    return (
        articles.transform(with_sentiment, scorers.sentiment)
        .transform(with_topic, scorers.topic)
        .transform(with_label_scores, scorers.labels)
    )


def enrich(
    articles: DataFrame,
    scorers: Scorers,
    vectors: DataFrame | None = None,
    id_col: str = "ord",
    threshold: float = settings.SIMILARITY_THRESHOLD,
) -> DataFrame:
    """Add ``sentiment, cluster_id, iptc_topic, iptc_topic_fr`` and the label scores.

    Only the narrow cluster table is joined.
    """
    clusters = article_clusters(articles, vectors, id_col, threshold)
    return score_texts(with_cluster_id(articles, clusters, id_col), scorers)
