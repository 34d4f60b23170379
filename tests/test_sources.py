import json

import pytest

from newsight.operators.content import resolve_redirects
from newsight.plans.collect import collect
from newsight.sources import feed_errors, parse_feeds, parse_search_pages, scan_feeds
from newsight.streaming import stream_collect

RSS = (
    '<?xml version="1.0"?><!-- c --><rss xmlns:atom="http://www.w3.org/2005/Atom"><channel><link>http://site</link>'
    '<item><atom:link href="z"/><link> http://a/1?x=1&amp;y=2 </link><link>http://second</link>'
    '<title type="html"><![CDATA[A & B]]></title><pubDate>Fri, 31 Jan 2025 10:00:00 GMT</pubDate></item>'
    "<item><link>http://a/2</link></item><item><title>no link</title></item>"
    "<item><link>http://a/3</link><title/><pubDate>Mon, 27 Jan 2025 10:00:00 GMT</pubDate></item></channel></rss>"
)
SITEMAP = (
    '<urlset xmlns="https://www.sitemaps.org/schemas/sitemap/0.9" xmlns:n="http://www.google.com/schemas/sitemap-news/0.9">'
    "<url><loc>\n http://s/1 </loc><lastmod>2025-01-31</lastmod><n:news><n:publication_date>2025-01-31T09:00:00Z"
    "</n:publication_date><n:title>News</n:title></n:news></url><url><loc>http://s/2</loc><lastmod>2025-01-30</lastmod></url>"
    "<url><lastmod>2025-01-31</lastmod></url></urlset>"
)
AS_OF = "2025-01-31 12:00:00"


def feeds(spark, *payloads):
    rows = [(url, i, text) for i, (url, text) in enumerate(payloads)]
    return spark.createDataFrame(rows, "feed_url string, source_ord long, payload string")


def test_feed_kinds_and_fields(spark):
    df = feeds(spark, ("https://news.google.com/rss", RSS), ("https://S.ca/map.xml", SITEMAP))
    rows = scan_feeds(df).orderBy("ord").collect()
    assert [r.url for r in rows] == ["http://a/1?x=1&y=2", "http://a/2", "http://a/3", "http://s/1", "http://s/2"]
    assert [r.title for r in rows] == ["A & B", "", "", "News", ""]
    assert [r.date for r in rows][3:] == ["2025-01-31T09:00:00Z", "2025-01-30"]
    assert [r.is_google_redirect for r in rows] == [True] * 3 + [False] * 2
    assert {r.source for r in rows} == {"news.google.com", "S.ca"}


def test_recency_drops_undated_feed_rows(spark):
    df = feeds(spark, ("https://f/rss", RSS), ("https://s/map", SITEMAP))
    assert sorted(r.url for r in parse_feeds(df, AS_OF).collect()) == ["http://a/1?x=1&y=2", "http://s/1"]


def test_bad_feeds_give_no_rows_and_are_listed(spark):
    cut = "<rss><channel><item><link>http://a</link></item><item><link>b</channel></rss>"
    plain = "<urlset><url><loc>http://n</loc></url></urlset>"
    df = feeds(spark, ("https://f1/", cut), ("https://f2/", "nope"), ("https://f3/", None), ("https://f4/", plain))
    assert scan_feeds(df).count() == 0
    assert sorted(r.feed_url for r in feed_errors(df).collect()) == ["https://f1/", "https://f2/", "https://f3/"]


def search(spark, *pages):
    rows = [(i, 1, json.dumps(p) if not isinstance(p, str) else p) for i, p in enumerate(pages)]
    return spark.createDataFrame(rows, "search_ord long, page long, payload string")


def test_search_pages(spark):
    page = {"news_results": [
        {"link": "http://a", "date": "2 hours ago", "title": "T", "source": {"name": "Paper", "icon": "i"}},
        {"link": "https://news.google.com/x", "date": "who knows", "source": "Plain"},
        {"link": "http://b", "source": {"icon": "i"}},
        {"link": "http://old", "date": "3 days ago"},
        {"link": "", "title": "skip"}, {"title": "skip"},
    ]}
    rows = parse_search_pages(search(spark, page, "{broken", {"other": 1}), AS_OF).orderBy("ord").collect()
    assert [(r.url, r.source, r.is_google_redirect) for r in rows] == [
        ("http://a", "Paper", False), ("https://news.google.com/x", "Plain", True), ("http://b", "serpapi", False),
    ]
    assert rows[2].date == "" and rows[1].ts is None


def test_collect_prefers_feeds_over_search(spark):
    page = {"news_results": [{"link": "http://s/1?ref=q", "title": "Other"}, {"link": "http://new", "title": "News"}, {"link": "http://z", "title": ""}]}
    got = collect(feeds(spark, ("https://s/map", SITEMAP)), search(spark, page), AS_OF)
    assert [r.url for r in got.orderBy("ord").collect()] == ["http://s/1", "http://z"]


def test_redirects(spark):
    g = "https://news.google.com/"
    urls = spark.createDataFrame([(g + c,) for c in "abcd"] + [("http://p",)], "url string")
    table = spark.createDataFrame([(g + "a", "http://t"), (g + "b", ""), (g + "c", g + "q"), ("http://p", "http://no")], "url string, target string")
    got = {r.url: r.fetch_url for r in resolve_redirects(urls, table).collect()}
    assert got == {g + "a": "http://t", g + "b": None, g + "c": None, g + "d": None, "http://p": "http://p"}


def test_stream_collect_resumes_without_repeats(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = spark.readStream.schema("feed_url string, source_ord long, payload string").parquet(source)
        stream_collect(stream, target, state).awaitTermination()
        return sorted(r.canonical_url for r in spark.read.parquet(target).collect())

    feeds(spark, ("https://s/map", SITEMAP)).write.parquet(source)
    assert run() == ["http://s/1", "http://s/2"]
    again = SITEMAP.replace("http://s/2", "http://s/1?utm_source=x")
    feeds(spark, ("https://s/map", again), ("https://f/rss", RSS)).write.mode("append").parquet(source)
    assert run() == ["http://a/1?x=1&y=2", "http://s/1", "http://s/2"]
    assert run() == ["http://a/1?x=1&y=2", "http://s/1", "http://s/2"]


def test_stream_collect_over_micro_batches(spark, tmp_path):
    """Titles across batches, a key that its timer forgets, a late row."""
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    ns = "http://www.sitemaps.org/schemas/sitemap/0.9"
    news = "http://www.google.com/schemas/sitemap-news/0.9"

    def arrive(*entries):
        body = "".join(
            f"<url><loc>http://{u}</loc><n:news><n:publication_date>2025-01-{at}:00:00Z</n:publication_date>"
            f"<n:title>{title}</n:title></n:news></url>" for u, title, at in entries
        )
        xml = f'<urlset xmlns="{ns}" xmlns:n="{news}">{body}</urlset>'
        feeds(spark, ("https://s/map", xml)).coalesce(1).write.mode("append").parquet(source)

    arrive(("a/1", "T", "10T10"), ("a/2", " ", "10T10"), ("a/1#x", "other", "10T11"))
    arrive(("b/1", " T ", "10T12"), ("b/2", "", "10T12"), ("b/3", "new", "10T12"))
    arrive(("c/1", "far", "14T00"))
    arrive(("d/1", "last", "14T01"))
    arrive(("a/1", "T", "14T02"), ("e/1", "late", "12T00"), ("c/1", "again", "14T02"))
    stream = spark.readStream.schema("feed_url string, source_ord long, payload string").option("maxFilesPerTrigger", 1)
    query = stream_collect(stream.parquet(source), target, state)
    query.awaitTermination()
    rows = sorted((r.canonical_url, r.title.strip()) for r in spark.read.parquet(target).collect())
    assert rows == [
        ("http://a/1", "T"), ("http://a/1", "T"), ("http://a/2", ""), ("http://b/2", ""), ("http://b/3", "new"),
        ("http://c/1", "far"), ("http://d/1", "last"),
    ]


def test_feed_shapes_of_real_publishers(spark):
    rss = "<rss><channel><item><link>http://a/1</link></item></channel>{}</rss>"
    ns = "http://www.sitemaps.org/schemas/sitemap/0.9"
    payloads = [
        f"<urlset xmlns='{ns}'><url><loc>http://s/1</loc></url></urlset>",
        "<!-- a > b --><?x y?>" + rss.format(""),
        '<!DOCTYPE rss [<!ENTITY a "b">]>' + rss.format(""),
        rss.format("<item><link>http://a/2</link></item>"),
        rss.format("<channel><item><link>http://a/3</link></item></channel>"),
        f'<s:urlset xmlns:s="{ns}"><s:url><s:loc>http://s/2</s:loc></s:url></s:urlset>',
        "<rss><channel></channel></rss>",
        # read but empty: no namespace on the root; unread: cut off, null, empty, other roots
        f'<urlset><url><loc>http://s/"{ns}"</loc></url></urlset>', rss[:-10], None, "", "<html/>",
        '<feed xmlns="http://www.w3.org/2005/Atom"/>',
    ]
    df = feeds(spark, *[(f"http://f{i}", p) for i, p in enumerate(payloads)])
    got = [(r.source_ord, r.url) for r in scan_feeds(df).orderBy("ord").collect()]
    assert got == [
        (0, "http://s/1"), (1, "http://a/1"), (2, "http://a/1"), (3, "http://a/1"), (3, "http://a/2"),
        (4, "http://a/1"), (4, "http://a/3"), (5, "http://s/2"),
    ]
    assert sorted(r.source_ord for r in feed_errors(df).collect()) == list(range(8, 13))


def test_order_numbers_never_overflow_unseen(spark):
    page = json.dumps({"news_results": [{"link": "http://x/1", "date": "1 hour ago"}]})
    last = spark.createDataFrame([((1 << 26) - 1, (1 << 14) - 1, page)], "search_ord long, page long, payload string")
    assert parse_search_pages(last, AS_OF).first().ord > 0
    for search_ord, number in [(1 << 26, 1), (0, 1 << 14), (-1, 0)]:
        rows = spark.createDataFrame([(search_ord, number, page)], "search_ord long, page long, payload string")
        with pytest.raises(Exception, match="needs more than"):
            parse_search_pages(rows, AS_OF).collect()
