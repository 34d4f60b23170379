"""One entry per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as X
from newsight import settings
from newsight.functions import dates, replies, text, url
from newsight.functions.html import page_text
from newsight.operators import batches, content, dedup, export, filters, models, scoring
from newsight.operators.clusters import cluster_articles, cluster_texts, with_cluster_id
from newsight.operators.similarity import cosine_pairs, first_similar
from newsight.plans import daily as plan
from newsight.plans.collect import collect, collect_counted, union_sources
from newsight.plans.enrich import enrich
from newsight.session import materialise, scratch_root
from newsight.sources import feed_errors, parse_feeds, parse_search_pages, scan_feeds, scan_search_pages
from newsight.streaming import stream_collect

QUERIES = {}


def query(fn):
    # a trailing underscore only keeps a function from hiding an import
    QUERIES[f"q_{fn.__name__.rstrip('_')}"] = fn
    return fn


# ---- URL, filters on URL -----------------------------------------------------


@query
def url_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return X.table(spark, sf, "pages").select(
        "page_id", url.canonical_url(F.col("url")).alias("canonical_url")
    )


@query
def url_domain(spark, sf):
    return X.table(spark, sf, "pages").select("page_id", url.netloc(F.col("url")).alias("domain"))


@query
def blocked(spark, sf):
    return X.table(spark, sf, "pages").select(
        "page_id", url.is_blocked(F.col("url"), X.BLOCKED).alias("blocked")
    )


@query
def locale(spark, sf):
    return X.table(spark, sf, "pages").select(
        "page_id", url.locale(F.col("url"), X.FRENCH).alias("locale")
    )


# ---- sources -----------------------------------------------------------------


@query
def feed_rss(spark, sf):
    return scan_feeds(X.rss_feeds(X.page_entries(spark, sf)))


@query
def feed_sitemap(spark, sf):
    return scan_feeds(X.sitemap_feeds(X.page_entries(spark, sf)))


@query
def feed_errors_(spark, sf):
    return feed_errors(X.rss_feeds(X.page_entries(spark, sf)))


@query
def search_results(spark, sf):
    return scan_search_pages(X.search_pages(X.page_entries(spark, sf)), X.AS_OF)


def _mixed_feeds(spark, sf):
    """Even payloads as RSS, odd ones as sitemaps: both kinds in one scan."""
    entries = X.page_entries(spark, sf)
    odd = F.col("source_ord") % 2 == 1
    return X.rss_feeds(entries.filter(~odd)).unionByName(X.sitemap_feeds(entries.filter(odd)))


@query
def union_sources_(spark, sf):
    entries = X.page_entries(spark, sf)
    return union_sources(
        parse_feeds(_mixed_feeds(spark, sf), X.AS_OF),
        parse_search_pages(X.search_pages(entries), X.AS_OF),
    )


@query
def source_counts(spark, sf):
    entries = X.page_entries(spark, sf)
    rows = union_sources(
        scan_feeds(_mixed_feeds(spark, sf)), scan_search_pages(X.search_pages(entries), X.AS_OF)
    )
    return export.source_counts(rows, X.AS_OF)


@query
def collect_(spark, sf):
    entries = X.page_entries(spark, sf)
    return collect(_mixed_feeds(spark, sf), X.search_pages(entries), X.AS_OF)


@query
def collect_counts(spark, sf):
    """Kept and skipped results per search page, rows left and removed by the dedup."""
    entries = X.page_entries(spark, sf)
    return collect_counted(_mixed_feeds(spark, sf), X.search_pages(entries), X.AS_OF)[1]


@query
def stream_collect_(spark, sf):
    """Feeds arrive in three files, one per trigger; rows behind the watermark are late."""
    root = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"
    feeds = materialise(_mixed_feeds(spark, sf), "stream-feeds")
    for arrival in range(X.ARRIVALS):
        part = feeds.filter(F.col("source_ord") % X.ARRIVALS == arrival)
        part.coalesce(1).write.mode("append").parquet(f"{root}/feeds")
    stream = (
        spark.readStream.schema(feeds.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/feeds")
    )
    stream_collect(stream, f"{root}/articles", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/articles").select("canonical_url", "title", "ord")


# ---- dates -------------------------------------------------------------------


@query
def parse_date(spark, sf):
    ts, k = F.col("ts"), F.col("event_id")
    local = ts - F.make_dt_interval(hours=F.lit(5))
    printed = (
        F.when(k % 11 == 0, F.lit("not a date"))
        .when(k % 5 == 0, F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(k % 5 == 1, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(k % 5 == 2, F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")))
        .when(k % 5 == 3, F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )
    return X.table(spark, sf, "events").select("event_id", dates.parse_date(printed).alias("parsed"))


@query
def parse_relative_date(spark, sf):
    ts, i = F.col("ts"), F.col("event_id")
    k, n = i % 19, (i % 40).cast("string")
    printed = F.when(k == 0, F.concat(n, F.lit(" minutes ago")))
    for at, unit in ((1, " hours ago"), (2, " days ago"), (3, " week ago")):
        printed = printed.when(k == at, F.concat(n, F.lit(unit)))
    printed = printed.when(k == 4, F.lit("Yesterday")).when(k == 5, F.lit("just now"))
    for at, shape in enumerate(settings.SEARCH_DATE_SHAPES, start=6):
        printed = printed.when(k == at, F.date_format(ts, shape))
    printed = printed.otherwise(F.lit("about 2 hours ago"))
    return X.table(spark, sf, "events").select(
        "event_id", dates.parse_relative_date(printed, X.AS_OF).alias("parsed")
    )


def _gappy_events(spark, sf):
    return X.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts")
    )


@query
def recency_strict(spark, sf):
    return _gappy_events(spark, sf).transform(filters.recent, as_of=X.EVENTS_AS_OF)


@query
def recency_lenient(spark, sf):
    return _gappy_events(spark, sf).transform(
        filters.recent, as_of=X.EVENTS_AS_OF, keep_undated=True
    )


# ---- dedup -------------------------------------------------------------------


@query
def keep_first(spark, sf):
    """By a 256-bit hash of the text, so that no text is shuffled."""
    key = F.coalesce(F.sha2("text", 256), F.lit(""))
    docs = X.table(spark, sf, "documents").select(key.alias("key"), "doc_id", "lang", "source")
    return dedup.keep_first(docs, ["key"], ["doc_id"]).drop("key")


@query
def greedy_dedup(spark, sf):
    return dedup.greedy_two_key(X.conflict_rows(spark, sf), "url_key", "title_key", "page_id")


# ---- prompts and replies -----------------------------------------------------


def _titled(spark, sf):
    return X.table(spark, sf, "documents").select(
        "doc_id",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("url"),
    )


@query
def prompt_batches(spark, sf):
    return batches.batch_prompts(batches.assign_batches(_titled(spark, sf), "doc_id"))


@query
def prompt_batches_ascii(spark, sf):
    return batches.batch_prompts(
        batches.assign_batches(_titled(spark, sf), "doc_id"), ascii_titles=True
    )


@query
def ascii_titles(spark, sf):
    return _titled(spark, sf).select("doc_id", text.ascii_squeeze(F.col("title")).alias("title"))


@query
def reply_repair(spark, sf):
    raw = X.batch_replies(X.label_batches(spark, sf))
    return raw.select("batch_id", "attempt", replies.repair_batch_reply(F.col("raw")).alias("repaired"))


@query
def reply_parse(spark, sf):
    parsed = batches.parse_batch_replies(X.batch_replies(X.label_batches(spark, sf)))
    item = F.col("item")
    return parsed.select("batch_id", "attempt", F.posexplode("results").alias("pos", "item")).select(
        "batch_id",
        "attempt",
        "pos",
        item["article_id"].alias("article_id"),
        replies.score_value(item["relevance_score"]).alias("relevance_score"),
        item["category"].alias("category"),
        item["reasoning"].alias("reasoning"),
        F.array_join(item["key_indicators"], ", ").alias("key_indicators"),
        F.size(replies.batch_item_problems(item)).alias("n_problems"),
    )


@query
def reply_attempts(spark, sf):
    parsed = batches.parse_batch_replies(X.batch_replies(X.label_batches(spark, sf)))
    return batches.first_valid(parsed, "batch_id", "results").select(
        "batch_id", "attempt", F.size("results").alias("n_results")
    )


@query
def reply_counts(spark, sf):
    batched = X.label_batches(spark, sf)
    parsed = batches.parse_batch_replies(X.batch_replies(batched))
    return batches.reply_counts(batched, batches.first_valid(parsed, "batch_id", "results"))


def _reconciled(spark, sf):
    batched = X.label_batches(spark, sf)
    parsed = batches.parse_batch_replies(X.batch_replies(batched))
    results = batches.first_valid(parsed, "batch_id", "results")
    return batches.reconcile(batched, results, X.batch_failures(batched))


@query
def reply_reconcile(spark, sf):
    return _reconciled(spark, sf).select(
        "doc_id", "batch_id", "batch_index", "relevance_score", "category", "reasoning",
        "key_indicators",
    )


@query
def threshold(spark, sf):
    return filters.above_threshold(X.scored_labels(spark, sf), "score").select("doc_id", "score")


# ---- content -----------------------------------------------------------------


@query
def redirects(spark, sf):
    return content.resolve_redirects(
        X.redirected_pages(spark, sf).select("page_id", "url"), X.redirects(spark, sf)
    )


@query
def fetch_list(spark, sf):
    i = F.col("page_id")
    scored = X.redirected_pages(spark, sf).select(
        "url", i.alias("ord"), (i % 30 + 70).cast("int").alias("relevance_score")
    )
    return content.fetch_list(scored, blocked=X.BLOCKED)


@query
def page_text_(spark, sf):
    return X.table(spark, sf, "pages").select("page_id", page_text(F.col("html")).alias("text"))


def _outcome(spark, sf):
    pages = X.redirected_pages(spark, sf).select("page_id", "url")
    urls = content.resolve_redirects(pages, X.redirects(spark, sf))
    fetched = X.fetched_pages(spark, sf).withColumnRenamed("page_id", "of")
    return urls.join(fetched.drop("url"), F.col("page_id") == F.col("of"))


@query
def scrape_status(spark, sf):
    return content.scrape_outcome(_outcome(spark, sf), blocked=X.BLOCKED).select(
        "url", "status", "resolved_url", F.length("content").alias("n_chars")
    )


def _page_articles(spark, sf):
    return X.redirected_pages(spark, sf).select("page_id", "url")


@query
def content_join(spark, sf):
    articles = _page_articles(spark, sf)
    table = content.scrape(
        articles.select("url").distinct(),
        X.redirects(spark, sf),
        X.unique_pages(X.fetched_pages(spark, sf)),
        blocked=X.BLOCKED,
    )
    return content.join_content(articles, table).select(
        "page_id", "url", F.length("scraped_content").alias("n_chars"), "scrape_status"
    )


# ---- text and scores ---------------------------------------------------------


@query
def phrases(spark, sf):
    return X.table(spark, sf, "documents").select(
        "doc_id", F.posexplode(text.phrases(F.col("text"))).alias("pos", "phrase")
    )


@query
def topic_text(spark, sf):
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return X.table(spark, sf, "documents").select(
        "doc_id", text.topic_text(title, F.col("text")).alias("topic_text")
    )


@query
def token_windows(spark, sf):
    windows = text.token_windows(text.tokens(F.col("text")))
    return X.table(spark, sf, "documents").select(
        "doc_id", F.posexplode(windows).alias("chunk", "window")
    ).select("doc_id", "chunk", F.size("window").alias("n_tokens"), F.array_join("window", " ").alias("window_text"))


@query
def truncate(spark, sf):
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return X.table(spark, sf, "documents").select(
        "doc_id",
        text.article_prompt(title, F.col("text")).alias("prompt"),
        text.retry_article_prompt(title, F.col("text")).alias("retry_prompt"),
    )


@query
def article_prompts(spark, sf):
    return batches.article_prompts(X.document_articles(spark, sf))


@query
def sentiment(spark, sf):
    docs = X.table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        scoring.sentiment_ratio(X.SCORERS.sentiment(text.phrases(F.col("text")))).alias("sentiment"),
    )


@query
def batch_scorer(spark, sf):
    """Sentiment by a Python model, in Arrow batches."""
    scorer = scoring.batch_scorer(scoring.weighted_polarity(X.WEIGHTS), "string")
    docs = scoring.with_pieces(X.table(spark, sf, "documents"), text.phrases(F.col("text")), "pieces")
    scored = materialise(docs.select("doc_id", scorer(F.col("pieces")).alias("labels")), "labels")
    return scored.select(
        "doc_id", F.size("labels").alias("n_phrases"), scoring.sentiment_ratio(F.col("labels")).alias("sentiment")
    )


@query
def topic_top1(spark, sf):
    articles = X.document_articles(spark, sf)
    return scoring.with_topic(articles, X.SCORERS.topic).select("ord", "iptc_topic")


@query
def topic_map(spark, sf):
    articles = X.document_articles(spark, sf)
    return scoring.with_topic(articles, X.SCORERS.topic).select("ord", "iptc_topic", "iptc_topic_fr")


@query
def label_scores(spark, sf):
    articles = X.document_articles(spark, sf)
    return scoring.with_label_scores(articles, X.SCORERS.labels).select(
        "ord", *settings.LABEL_COLUMNS.values()
    )


@query
def label_ranked(spark, sf):
    docs = X.table(spark, sf, "documents")
    windows = scoring.window_texts(F.col("text"))
    pooled = scoring.max_pool(X.SCORERS.labels(windows), list(X.LABELS))
    ranked = scoring.ranked_labels(pooled, threshold=0.05)
    return docs.select("doc_id", F.posexplode(ranked).alias("rank", "entry")).select(
        "doc_id", "rank", "entry.label", "entry.score"
    )


@query
def train_labels(spark, sf):
    """Fitted on the labelled documents, applied to all."""
    docs = X.table(spark, sf, "documents").select("doc_id", "text")
    rows = docs.join(X.table(spark, sf, "labels"), "doc_id").select("doc_id", "text", "quality")
    model = models.train_label_model(rows, "doc_id", "text", "quality")
    scored = models.score_label(model, docs, "doc_id", "text", "score")
    return scored.select("doc_id", F.round("score", 6).alias("score"))


# ---- similarity --------------------------------------------------------------


@query
def doc_vectors(spark, sf):
    vectors = models.doc_vectors(X.table(spark, sf, "documents"), "doc_id", "text")
    best = F.array_max("weights")
    return vectors.select(
        "doc_id",
        F.size("terms").cast("long").alias("n_terms"),
        F.round(F.aggregate("weights", F.lit(0.0), lambda a, w: a + w), 6).alias("weight_sum"),
        F.round(best, 6).alias("top_weight"),
        F.element_at("terms", F.array_position("weights", best).cast("int")).cast("long").alias("top_term"),
    )


@query
def doc_clusters(spark, sf):
    docs = X.table(spark, sf, "documents")
    vectors = models.doc_vectors(docs, "doc_id", "text")
    clusters = cluster_texts(vectors, "doc_id")
    return with_cluster_id(docs.select("doc_id"), clusters, "doc_id")


@query
def cosine_pairs_(spark, sf):
    return cosine_pairs(X.table(spark, sf, "embeddings"), "vec_id", "embedding", X.SIMILARITY)


@query
def first_similar_(spark, sf):
    """With copies: every third vector stands a second time, under a higher id."""
    vectors = X.table(spark, sf, "embeddings").select("vec_id", "embedding")
    copies = vectors.filter(F.col("vec_id") % 3 == 0).withColumn("vec_id", F.col("vec_id") + X.COPY_IDS)
    found = first_similar(vectors.unionByName(copies), "vec_id", "embedding", X.SIMILARITY)
    return found.select(F.col("id").alias("vec_id"), "first")


@query
def append_(spark, sf):
    """Two appends to one stored table, the second of new URLs only, read back."""
    articles = X.document_articles(spark, sf).select("ord", "url", "relevance_score")
    firsts = dedup.keep_first(articles, ["url"], ["ord"]).withColumn(
        "processed_timestamp", F.lit(X.AS_OF).cast("timestamp_ntz")
    )
    target = f"{scratch_root(spark)}/append-{uuid.uuid4().hex}"
    export.append_to_path(firsts.filter(F.col("ord") % 2 == 0), target)
    export.append_to_path(export.only_new(firsts, spark.read.parquet(target)), target)
    return spark.read.parquet(target).select("url", "ord", "relevance_score", "run_date")


@query
def publish(spark, sf):
    """Two runs into new catalog tables, the second one twice: appended, and one partition per run."""
    articles = X.document_articles(spark, sf).select("ord", "url", "relevance_score")
    at = F.lit(X.AS_OF).cast("timestamp_ntz")
    runs = [
        articles.filter(F.col("ord") % 2 == k).withColumn("processed_timestamp", at + F.make_dt_interval(hours=F.lit(k)))
        for k in (0, 1)
    ]
    database = f"news_{uuid.uuid4().hex}"
    location = f"{scratch_root(spark)}/{database}"
    for run in (*runs, runs[1]):
        export.append_to_table(run, database, "log", location)
        export.publish_run(run, database, "runs", location)
    rows = [
        spark.table(f"{database}.{name}").select(F.lit(name).alias("name"), "ord", "url", "processed_timestamp")
        for name in ("log", "runs")
    ]
    return rows[0].unionByName(rows[1])


@query
def clusters(spark, sf):
    vectors = X.table(spark, sf, "embeddings")
    found = cluster_articles(vectors, "vec_id", "embedding", X.SIMILARITY)
    return with_cluster_id(vectors.select("vec_id"), found, "vec_id")


# ---- analyses ----------------------------------------------------------------


@query
def analysis_normalize(spark, sf):
    raw = X.raw_analyses(spark, sf)
    fields = replies.normalise_analysis(
        F.col("summary"), F.col("quebec"), F.col("perception"), F.col("Flag")
    )
    return raw.select("conv_id", "turn", fields.alias("n")).select(
        "conv_id", "turn", "n.summary", "n.quebec", "n.perception", "n.Flag",
        F.array_join("n.problems", ",").alias("problems"),
    )


@query
def analysis_attempts(spark, sf):
    keys = X.table(spark, sf, "documents").select("doc_id")
    return batches.attach_analysis(keys, X.article_replies(keys, "doc_id"), "doc_id")


@query
def flag_filter(spark, sf):
    return filters.unflagged(X.flagged_articles(spark, sf)).select("doc_id", "Flag")


@query
def flag_audit(spark, sf):
    return filters.flag_audit(X.flagged_articles(spark, sf))


# ---- export and whole plans --------------------------------------------------


def _enriched(spark, sf):
    return enrich(
        X.document_articles(spark, sf), X.SCORERS, X.document_vectors(spark, sf),
        threshold=X.SIMILARITY,
    )


def _analysed(spark, sf):
    articles = _enriched(spark, sf)
    asked = articles.filter(filters.has_content()).select("ord")
    return batches.attach_analysis(
        articles, X.article_replies(articles.select("ord"), "ord"), "ord", asked
    )


@query
def enrich_(spark, sf):
    return _enriched(spark, sf).select(
        "ord", "sentiment", "cluster_id", "iptc_topic", "iptc_topic_fr",
        *settings.LABEL_COLUMNS.values(),
    )


@query
def run_metrics(spark, sf):
    return export.run_metrics(_analysed(spark, sf))


@query
def export_(spark, sf):
    articles = X.document_articles(spark, sf)
    return plan.finish(
        articles, X.article_replies(articles.select("ord"), "ord"), X.SCORERS, X.AS_OF,
        X.document_vectors(spark, sf), X.SIMILARITY,
    )


@query
def append_new(spark, sf):
    articles = X.document_articles(spark, sf).select("ord", "url", "relevance_score")
    first = dedup.keep_first(articles, ["url"], ["ord"])
    target = first.filter(F.col("ord") % 2 == 0)
    return export.only_new(first, target)


@query
def daily(spark, sf):
    """All stages in order; each outside step answers from the tables the stage before left."""
    feeds = _mixed_feeds(spark, sf)
    results = X.search_pages(X.page_entries(spark, sf))
    batched = plan.batched_articles(feeds, results, X.AS_OF)
    scored = plan.score_relevance(
        batched, X.batch_replies(X.article_labels(batched)), X.batch_failures(batched)
    )
    articles = plan.fetch_content(
        scored,
        X.article_redirects(spark, sf, batched),
        X.unique_pages(X.fetched_pages(spark, sf)),
        blocked=X.BLOCKED,
    )
    return plan.finish(
        articles, X.article_replies(articles.select("ord"), "ord"), X.SCORERS, X.AS_OF,
        X.article_vectors(spark, sf, articles), X.SIMILARITY,
    )
