"""Clusters of similar articles, numbered by their first member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight import settings
from newsight.operators.components import connected_components
from newsight.operators.numbering import with_row_number
from newsight.operators.similarity import similarity_links
from newsight.operators.sparse import sparse_links


def number_clusters(edges: DataFrame) -> DataFrame:
    """``(node, cluster_id)`` for nodes with an edge; ids 1.. by smallest node."""
    members = connected_components(edges)
    firsts = with_row_number(
        members.select("component").distinct(), ["component"], name="cluster_id"
    )
    return members.join(firsts, "component").select("node", "cluster_id")


def cluster_articles(
    vectors: DataFrame,
    id_col: str = "article_id",
    vec_col: str = "embedding",
    threshold: float = settings.SIMILARITY_THRESHOLD,
    **sizing,
) -> DataFrame:
    """``(id, cluster_id)`` of the clustered rows. The id is also the article order."""
    links = similarity_links(vectors, id_col, vec_col, threshold, **sizing)
    return number_clusters(links).withColumnRenamed("node", id_col)


def cluster_texts(
    vectors: DataFrame, id_col: str = "article_id", threshold: float = settings.SIMILARITY_THRESHOLD
) -> DataFrame:
    """``cluster_articles`` for sparse vectors (``terms``, ``weights``)."""
    return number_clusters(sparse_links(vectors, id_col, threshold)).withColumnRenamed("node", id_col)


def with_cluster_id(articles: DataFrame, clusters: DataFrame, id_col: str) -> DataFrame:
    """Add ``cluster_id``, 0 for articles similar to no other."""
    joined = articles.join(clusters, id_col, "left")
    return joined.withColumn("cluster_id", F.coalesce("cluster_id", F.lit(0)).cast("long"))
