"""Prompt batches out, replies in: assembly, attempt choice, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions import replies as R
from newsight.functions.text import article_prompt, ascii_squeeze, fill, retry_article_prompt
from newsight.operators.filters import has_content
from newsight.operators.numbering import with_row_number


def assign_batches(
    articles: DataFrame, order_by: str = "ord", size: int = settings.RELEVANCE_BATCH_SIZE
) -> DataFrame:
    """Consecutive batches of ``size`` rows: adds ``batch_id`` and ``batch_index``, from 0."""
    at = F.col("_n") - 1
    return (
        with_row_number(articles, [order_by], name="_n")
        .withColumn("batch_id", F.floor(at / size).cast("long"))
        .withColumn("batch_index", (at % size).cast("int"))
        .drop("_n")
    )


def batch_prompts(batched: DataFrame, ascii_titles: bool = False) -> DataFrame:
    """One prompt per batch; ``ascii_titles`` gives the variant for later retries.

    Groups hold one batch, so the collected list never exceeds the batch size.
    """
    title = ascii_squeeze(F.col("title")) if ascii_titles else F.col("title")
    index = F.col("batch_index")
    line = fill(
        settings.BATCH_PROMPT_ITEM,
        number=(index + 1).cast("string"),
        id=index.cast("string"),
        title=title,
        url=F.col("url"),
    )
    lines = F.array_sort(F.collect_list(F.struct(index.alias("at"), line.alias("line"))))
    grouped = batched.groupBy("batch_id").agg(
        F.count("*").cast("int").alias("n_articles"), lines.alias("lines")
    )
    head = fill(settings.BATCH_PROMPT_HEAD, n=F.col("n_articles").cast("string"))
    listed = F.array_join(F.transform("lines", lambda x: x["line"]), "\n\n")
    return grouped.select(
        "batch_id",
        "n_articles",
        F.concat_ws("\n\n", head, listed, F.lit(settings.BATCH_PROMPT_TAIL)).alias("prompt"),
    )


def parse_batch_replies(replies: DataFrame) -> DataFrame:
    """``(batch_id, attempt, raw)`` -> repaired text and parsed objects (null if unreadable)."""
    return replies.select(
        "batch_id", "attempt", R.parse_batch_reply(R.repair_batch_reply(F.col("raw"))).alias("results")
    )


def first_valid(parsed: DataFrame, key: str, value: str, attempts: int = settings.MAX_ATTEMPTS) -> DataFrame:
    """Value of the earliest usable attempt of each key; keys without one are absent."""
    return (
        parsed.filter(F.col(value).isNotNull() & (F.col("attempt") <= attempts))
        .groupBy(key)
        .agg(F.min_by(value, "attempt").alias(value), F.min("attempt").alias("attempt"))
    )


def reply_counts(batched: DataFrame, results: DataFrame) -> DataFrame:
    """Articles sent and objects received per batch; ``is_complete`` if they agree."""
    sent = batched.groupBy("batch_id").agg(F.count("*").alias("n_articles"))
    received = F.coalesce(F.size("results"), F.lit(0)).cast("long")
    return sent.join(results.select("batch_id", "results"), "batch_id", "left").select(
        "batch_id",
        "n_articles",
        received.alias("n_results"),
        (received == F.col("n_articles")).alias("is_complete"),
    )


def _reply_for(index: Column, results: Column) -> Column:
    """Last object of the reply that carries this row's id."""
    return F.try_element_at(
        F.filter(results, lambda r: r["article_id"] == index.cast("string")), F.lit(-1)
    )


def reconcile(
    batched: DataFrame, results: DataFrame, failures: DataFrame | None = None
) -> DataFrame:
    """Attach each batch's reply objects to its rows by id.

    Rows without an object, or whose object lacks a usable score, get the error
    defaults. ``failures(batch_id, error)`` holds the last error text of batches that never
    got a usable reply: their rows carry its first characters as reasoning. A batch meets
    its reply in one equi-join on ``batch_id``; the search by id stays inside the row, as a
    reply is no larger than one batch.
    """
    joined = batched.join(results.select("batch_id", "results"), "batch_id", "left").withColumn(
        "_r", _reply_for(F.col("batch_index"), F.col("results"))
    )
    missing = F.lit(settings.UNMATCHED_REASONING)
    if failures is not None:
        last = failures.groupBy("batch_id").agg(F.max("error").alias("_error"))
        joined = joined.join(last, "batch_id", "left")
        failed = F.left("_error", F.lit(settings.ERROR_TEXT_CHARS))
        missing = F.when(F.col("results").isNull(), failed)
        missing = F.coalesce(missing, F.lit(settings.UNMATCHED_REASONING))
    r = F.col("_r")
    score = R.score_value(r["relevance_score"])
    usable = score.isNotNull() & r["category"].isNotNull() & r["reasoning"].isNotNull()
    return joined.select(
        *batched.columns,
        F.when(usable, score).otherwise(F.lit(0)).alias("relevance_score"),
        F.when(usable, r["category"]).otherwise(F.lit(settings.ERROR_CATEGORY)).alias("category"),
        F.when(usable, r["reasoning"])
        .otherwise(missing)
        .alias("reasoning"),
        F.when(usable, F.coalesce(F.array_join(r["key_indicators"], ", "), F.lit("")))
        .otherwise(F.lit(""))
        .alias("key_indicators"),
    )


def article_prompts(articles: DataFrame, key: str = "ord") -> DataFrame:
    """Prompts for articles with title and content, and the shorter form for a retry."""
    title, content = F.col("title"), F.col("scraped_content")
    return articles.filter(has_content()).select(
        key,
        article_prompt(title, content).alias("prompt"),
        retry_article_prompt(title, content).alias("retry_prompt"),
    )


def parse_article_replies(replies: DataFrame, key: str = "article_id") -> DataFrame:
    """``(article_id, attempt, raw)`` -> normalised analysis (null if rejected) and the reasons."""
    parsed = replies.select(
        key, "attempt", R.parse_article_reply(R.repair_article_reply(F.col("raw"))).alias("_p")
    )
    p = F.col("_p")
    checked = parsed.withColumn(
        "_c", R.normalise_analysis(p["summary"], p["quebec"], p["perception"], p["Flag"])
    )
    problems = F.when(p.isNull(), F.array(F.lit("json"))).otherwise(F.col("_c.problems"))
    fields = F.struct("_c.summary", "_c.quebec", "_c.perception", "_c.Flag")
    return checked.select(
        key,
        "attempt",
        F.when(F.size(problems) == 0, fields).alias("analysis"),
        problems.alias("problems"),
    )


def attach_analysis(
    articles: DataFrame,
    replies: DataFrame,
    key: str = "article_id",
    asked: DataFrame | None = None,
) -> DataFrame:
    """Add summary, quebec, perception and Flag; null where no attempt was usable.

    ``asked`` holds the keys of the articles that were sent to the model: replies to any
    other article are not used. Without it every article counts as sent.
    """
    if asked is not None:
        replies = replies.join(asked.select(key).distinct(), key, "left_semi")
    best = first_valid(parse_article_replies(replies, key), key, "analysis")
    return articles.join(best.select(key, "analysis.*"), key, "left")
