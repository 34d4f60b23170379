import json
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsight import session, settings
from newsight.operators.scoring import lexicon_labels, lexicon_polarity
from newsight.plans import daily
from newsight.plans.collect import collect, collect_counted
from newsight.plans.enrich import Scorers
from newsight.session import clear_scratch, materialise, scratch_root

AS_OF = "2025-01-31 12:00:00"
SCORERS = Scorers(
    lexicon_polarity(["great"], ["bad"]),
    lexicon_labels({"sport": ["match"], "weather": ["snow"]}),
    lexicon_labels({"restaurant": ["menu"]}),
)


def test_daily_run_keeps_failures_and_drops_flags(spark):
    body = "<p>" + "Great snow fell on the old town today. " * 5 + "</p>"
    items = "".join(
        f"<item><link>http://site/{i}</link><title>Story {i}</title><pubDate>Fri, 31 Jan 2025 10:00:00 GMT</pubDate></item>"
        for i in range(6)
    )
    feeds = spark.createDataFrame([("http://feed/", 0, f"<rss><channel>{items}</channel></rss>")], "feed_url string, source_ord long, payload string")
    search = spark.createDataFrame([(0, 1, json.dumps({"news_results": [{"link": "https://news.google.com/a", "title": "Found"}]}))], "search_ord long, page long, payload string")
    scores = [90, 80, 79, 95, 85, 85, 99]
    reply = json.dumps([
        {"article_id": str(i), "relevance_score": s, "category": "HIGHLY_RELEVANT", "reasoning": "r", "key_indicators": []}
        for i, s in enumerate(scores)
    ])
    ok = (200, None, None)
    page_rows = [(f"http://site/{i}", body, *ok) for i in (0, 1, 3)] + [("http://site/4", None, 403, None, None)]
    page_rows[2] = ("http://site/3", body, 200, None, "http://site/0")  # ends on another article's page
    say = lambda flag: json.dumps({"summary": "s", "quebec": "oui", "perception": "Positif", "Flag": flag})
    inputs = daily.Inputs(
        feeds=feeds,
        search_pages=search,
        batch_replies=spark.createDataFrame([(0, 1, reply)], "batch_id long, attempt int, raw string"),
        redirects=spark.createDataFrame([], "url string, target string"),
        pages=spark.createDataFrame(page_rows, "url string, html string, http_status int, error string, final_url string"),
        # 0 and 1 tell the same story; 1 is flagged later but still makes a cluster
        vectors=spark.createDataFrame([(0, [1.0, 0.1]), (1, [1.0, 0.2]), (3, [0.0, 1.0])], "ord long, embedding array<float>"),
        article_replies=spark.createDataFrame([(0, 1, say(0)), (1, 1, say("1")), (3, 1, say("0"))], "ord long, attempt int, raw string"),
    )
    out = {r.url: r for r in daily.daily_run(inputs, SCORERS, AS_OF).collect()}
    # 1 is flagged, 2 is below the threshold, 3 repeats the URL of 0
    assert sorted(out) == ["http://site/0", "http://site/4", "http://site/5", "https://news.google.com/a"]
    best = out["http://site/0"]
    assert (best.title, best.scrape_status, best.sentiment, best.iptc_topic, best.iptc_topic_fr) == ("Story 0", "success", 1.0, "weather", "Météo")
    assert (best.cluster_id, best.perception, best.relevance_score) == (1, "positive", 90)
    assert best.processed_timestamp == datetime(2025, 1, 31, 12)
    for name, status in (("http://site/4", "error: 403"), ("http://site/5", None), ("https://news.google.com/a", "redirect_failed")):
        r = out[name]
        assert (r.scrape_status, r.scraped_content, r.summary, r.iptc_topic) == (status, None, None, None)
        assert (r.sentiment, r.cluster_id, r.Restaurant) == (0.0, 0, 0.0)


def test_daily_run_explains_failed_batches(spark):
    items = "".join(
        f"<item><link>http://site/{i}</link><title>Story {i}</title><pubDate>Fri, 31 Jan 2025 10:00:00 GMT</pubDate></item>"
        for i in range(27)
    )
    feeds = spark.createDataFrame([("http://feed/", 0, f"<rss><channel>{items}</channel></rss>")], "feed_url string, source_ord long, payload string")
    search = spark.createDataFrame([], "search_ord long, page long, payload string")
    batched = daily.batched_articles(feeds, search, AS_OF)
    one = json.dumps([{"article_id": "0", "relevance_score": 90, "category": "HIGHLY_RELEVANT", "reasoning": "r", "key_indicators": []}])
    replies = spark.createDataFrame([(0, 1, one)], "batch_id long, attempt int, raw string")
    failures = spark.createDataFrame([(0, "x" * 80), (1, "429 " + "y" * 80)], "batch_id long, error string")
    rows = {(r.batch_id, r.batch_index): r for r in daily.score_relevance(batched, replies, failures).collect()}
    assert rows[0, 0].reasoning == "r" and rows[0, 1].reasoning == settings.UNMATCHED_REASONING
    assert rows[1, 0].reasoning == ("429 " + "y" * 80)[: settings.ERROR_TEXT_CHARS] and rows[1, 0].category == "ERROR"


def test_collect_reads_each_payload_once_and_counts(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(payload):
        read.add(1)
        return payload

    items = "".join(
        f"<item><link>http://site/{i}</link><title>Story {i // 2}</title><pubDate>Fri, 31 Jan 2025 10:00:00 GMT</pubDate></item>"
        for i in range(6)
    )
    feeds = spark.createDataFrame([("http://feed/", k, f"<rss><channel>{items}</channel></rss>") for k in range(4)], "feed_url string, source_ord long, payload string")
    news = [{"link": "http://found/1", "title": "New"}, {"title": "no link"}, {"link": "http://old/1", "date": "3 days ago"}]
    pages = [(0, 1, json.dumps({"news_results": news})), (1, 1, json.dumps({"news_results": news[1:]})), (1, 2, "{}")]
    search = spark.createDataFrame(pages, "search_ord long, page long, payload string")
    watch = F.udf(seen, "string").asNondeterministic()
    watched = [df.withColumn("payload", watch("payload")) for df in (feeds, search)]
    articles, counts = collect_counted(*watched, AS_OF)
    assert read.value == 7
    assert sorted(r.url for r in articles.collect()) == ["http://found/1", "http://site/0", "http://site/2", "http://site/4"]
    assert sorted(tuple(r[c] for c in ("scope", "search_ord", "page", "kept", "skipped")) for r in counts.collect()) == [
        ("dedup", None, None, 4, 21), ("page", 0, 1, 1, 2), ("page", 1, 1, 0, 2),
    ]
    assert collect(*watched, AS_OF).count() == 4 and read.value == 14
    none = collect_counted(feeds.limit(0), search.limit(0), AS_OF)
    assert none[0].count() == 0 and [r.kept for r in none[1].collect()] == [0]


def test_empty_day(spark):
    feeds = spark.createDataFrame([], "feed_url string, source_ord long, payload string")
    search = spark.createDataFrame([], "search_ord long, page long, payload string")
    assert daily.batched_articles(feeds, search, AS_OF).count() == 0


@pytest.mark.parametrize("setting", ["spark.checkpoint.dir", "spark.newsight.unset"])
def test_scratch_lives_under_the_checkpoint_folder(spark, monkeypatch, setting):
    monkeypatch.setattr(session, "_SETTING", setting)
    stored = materialise(spark.range(3), "t")
    assert stored.count() == 3
    root = scratch_root(spark)
    assert root.startswith(spark.conf.get(setting, None) or tempfile.gettempdir())
    assert root == scratch_root(spark)
    assert all(root.split(":")[-1] in f for f in stored.inputFiles())
    clear_scratch(spark)
    assert spark.range(2).transform(lambda d: materialise(d, "again")).count() == 2
