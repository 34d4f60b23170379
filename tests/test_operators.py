import random
import time
from datetime import datetime

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings as hyp
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsight.operators import content, dedup, export, filters, scoring
from newsight.operators.numbering import with_row_number
from newsight.schemas import EXPORT_SCHEMA, REQUIRED_ENRICHMENTS


def assert_greedy(rows, kept):
    """The property that defines the result: keys of kept rows never meet, and each other row
    shares a key with a kept row before it. Null second keys meet nothing."""
    chosen = [r for r in rows if r[0] in set(kept)]
    assert len(chosen) == len(kept)
    for column in (1, 2):
        keys = [r[column] for r in chosen if column == 1 or r[column] is not None]
        assert len(keys) == len(set(keys))
    for at, u, t in rows:
        if at not in set(kept):
            assert any(k[0] < at and (k[1] == u or t is not None and k[2] == t) for k in chosen)


def greedy(spark, rows):
    df = spark.createDataFrame(rows, "ord long, u string, t string")
    return sorted(r.ord for r in dedup.greedy_two_key(df, "u", "t", "ord").collect())


def test_greedy_dedup_is_not_two_passes(spark):
    assert greedy(spark, [(1, "u1", "t1"), (2, "u2", "t1"), (3, "u2", "t2")]) == [1, 3]
    assert greedy(spark, [(1, "u1", None), (2, "u2", None), (3, None, "t"), (4, None, None)]) == [1, 2, 3]


@hyp(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcdef"), st.sampled_from(["1", "2", "3", "4", None])), min_size=1, max_size=40))
def test_greedy_dedup_equals_scan(spark, pairs):
    rows = [(i, u, t) for i, (u, t) in enumerate(pairs)]
    assert_greedy(rows, greedy(spark, rows))


def test_greedy_dedup_with_hot_keys_and_a_chain(spark):
    rng = random.Random(4)
    hot = [(i, "hot" if i % 3 == 0 else f"u{rng.randint(0, 200)}", "same" if i % 3 == 1 else f"t{rng.randint(0, 200)}") for i in range(900)]
    chain = [(1000 + i, f"c{(i + 1) // 2}", f"d{i // 2}") for i in range(12)]
    assert_greedy(hot + chain, greedy(spark, hot + chain))


@pytest.mark.parametrize("group_rows", [100_000, 12])
def test_long_chains_are_closed_at_once(spark, group_rows):
    rng = random.Random(9)
    chain = [(i, f"c{(i + 1) // 2}", f"d{i // 2}") for i in range(18)]
    short = [(100 + i, f"s{(i + 1) // 2}", f"t{i // 2}" if i % 5 else None) for i in range(11)]
    noise = [(200 + i, f"u{rng.randint(0, 40)}", f"w{rng.randint(0, 40)}") for i in range(80)]
    rows = chain + short + noise
    df = spark.createDataFrame(rows, "ord long, u string, t string")
    kept = dedup.greedy_two_key(df, "u", "t", "ord", rounds=2, group_rows=group_rows)
    assert_greedy(rows, [r.ord for r in kept.collect()])


def test_a_chain_of_a_million_rows_takes_few_rounds(spark, monkeypatch):
    rounds, steps, store, follow = [], [], dedup.materialise_counted, dedup._follow

    def counted(df, name):
        rounds.append(name)
        return store(df, name)

    def followed(links):
        found = follow(links)
        steps.append(found[1])
        return found

    monkeypatch.setattr(dedup, "materialise_counted", counted)
    monkeypatch.setattr(dedup, "_follow", followed)
    n = 1_000_000
    df = spark.range(n).selectExpr(
        "id AS ord", "concat('c', (id + 1) div 2) AS u", "concat('d', id div 2) AS t"
    )
    kept = dedup.greedy_two_key(df, "u", "t", "ord", group_rows=1)
    assert kept.agg(F.count("*"), F.sum("ord")).first() == (n // 2, (n // 2) * (n // 2 - 1))
    assert kept.filter("ord % 2 = 1").count() == 0
    # the rows at the start, one round for all rounds of links, at most one more
    assert rounds.count("dedup-pending") <= 4 and max(steps) <= 21


def test_chains_behind_rows_with_several_conflicts(spark):
    """Branches, ladders and chains that start at a rejected row."""
    rng = random.Random(2)
    for seed in range(3):
        rows, at = [], 0
        for c in range(6):
            for i in range(rng.randint(2, 14)):
                rows.append((at, f"{c}u{(i + 1) // 2}", f"{c}t{i // 2}" if rng.random() > 0.1 else None))
                at += 1
                if rng.random() < 0.3:  # a second row at a link, with a chain of its own
                    rows.append((at, f"{c}u{i // 2}", f"{c}{seed}x{i}"))
                    rows.append((at + 1, f"{c}{seed}y{i}", f"{c}{seed}x{i}"))
                    at += 2
        df = spark.createDataFrame(rows, "ord long, u string, t string")
        kept = dedup.greedy_two_key(df, "u", "t", "ord", rounds=50)
        assert_greedy(rows, [r.ord for r in kept.collect()])


def test_a_conflict_group_is_scanned_in_linear_time():
    def seconds(n):
        rows = pa.table({
            "at": range(n), "a": [f"c{(i + 1) // 2}" for i in range(n)],
            "b": [f"d{i // 2}" if i % 100 else None for i in range(n)],
        })
        start = time.perf_counter()
        kept = dedup._scan_group(rows).column("at").to_pylist()
        return time.perf_counter() - start, kept

    (once, few), (four, many) = seconds(20_000), seconds(80_000)
    assert many[: len(few) - 2] == few[:-2] and four < 10 * once + 0.5


def test_dedup_articles_uses_canonical_url_and_stripped_title(spark):
    rows = [(1, "http://a/x?ref=1", " T "), (2, "http://a/x#top", "other"), (3, "http://b/", "T"), (4, "http://c/", " ")]
    df = spark.createDataFrame(rows, "ord long, url string, title string")
    kept = dedup.dedup_articles(df)
    assert kept.columns == df.columns
    assert sorted(r.ord for r in kept.collect()) == [1, 4]


def test_keep_first_limits_each_task_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50))
    out = dedup.keep_first(df, ["k"], ["id"])
    want = {}
    for i in range(1000):
        want.setdefault(0 if i % 3 == 0 else i % 50, i)
    assert {r.k: r.id for r in out.collect()} == want
    planned = dedup.keep_first(df, ["k"], ["id"])
    plan = planned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_drop_repeats_equals_keep_first(spark):
    df = spark.range(300).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 70))
    rows = lambda d: sorted((r.k, r.id) for r in d.collect())
    assert rows(dedup.drop_repeats(df, "k", "id")) == rows(dedup.keep_first(df, ["k"], ["id"]))


def test_row_numbers_are_consecutive(spark):
    df = spark.range(0, 500, numPartitions=7).select((F.col("id") * 7919 % 500).alias("k"), (F.col("id") % 3 == 0).alias("g"))
    got = sorted((r.k, r.n) for r in with_row_number(df, ["k"], name="n").collect())
    assert got == [(k, k + 1) for k in range(500)]
    by_group = {}
    for r in with_row_number(df, ["k"], ["g"], name="n").collect():
        by_group.setdefault(r.g, []).append((r.k, r.n))
    for rows in by_group.values():
        assert [n for _, n in sorted(rows)] == list(range(1, len(rows) + 1))


def test_recency_policies(spark):
    df = spark.createDataFrame([(1, "2025-01-01 12:00:00"), (2, "2024-12-31 11:59:59"), (3, None)], "i int, s string").withColumn("ts", F.col("s").cast("timestamp_ntz"))
    as_of = datetime(2025, 1, 2, 12)
    ids = lambda d: sorted(r.i for r in d.collect())
    assert ids(filters.recent(df, as_of)) == [1]
    assert ids(filters.recent(df, as_of, keep_undated=True)) == [1, 3]


def test_flag_filter_keeps_nulls(spark):
    df = spark.createDataFrame([("0",), ("1",), (None,)], "Flag string")
    assert sorted(str(r.Flag) for r in filters.unflagged(df).collect()) == ["0", "None"]


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(79,), (80,)], "relevance_score int")
    assert [r.relevance_score for r in filters.above_threshold(df).collect()] == [80]


def _fetched(spark, rows):
    return spark.createDataFrame(rows, "url string, fetch_url string, html string, http_status int, error string, final_url string")


def test_scrape_outcomes(spark):
    body = lambda n: "<p>" + "x" * n + "</p>"
    rows = [
        ("http://a/1", "http://a/1", body(101), 200, None, "http://a/1?f"),
        ("http://a/2", "http://a/2", body(100), 200, None, None),
        ("http://a/3", "http://a/3", None, 200, None, None),
        ("http://a/4", "http://a/4", body(200), 403, None, "http://a/4"),
        ("http://a/5", "http://a/5", None, None, "timeout", None),
        ("http://a/6", "http://a/6", None, None, "e" * 60, None),
        ("http://msn.com/7", "http://msn.com/7", body(200), 200, None, None),
        ("https://news.google.com/8", None, None, None, None, None),
        ("https://news.google.com/9", "http://www.msn.com/9", body(200), 200, None, None),
    ]
    got = {r.url[-1]: (r.status, r.resolved_url, r.content) for r in content.scrape_outcome(_fetched(spark, rows)).collect()}
    assert [got[str(i)][0] for i in range(1, 10)] == [
        "success", "partial", "partial", "error: 403", "timeout", "error: " + "e" * 50, "skipped", "redirect_failed", "skipped",
    ]
    assert got["1"][1] == "http://a/1?f" and got["9"][1] == "http://www.msn.com/9" and got["8"][1].endswith("/8")
    assert got["2"][2] == "x" * 100 and got["4"][2] is None


def test_unfetched_articles_keep_their_url(spark):
    articles = spark.createDataFrame([("u1", 1), ("u2", 2)], "url string, i int")
    pages = spark.createDataFrame([("u1", "<p>hi</p>", 200, None, "u1x")], "url string, html string, http_status int, error string, final_url string")
    none = spark.createDataFrame([], "url string, target string")
    got = {r.i: r for r in content.join_content(articles, content.scrape(articles.select("url"), none, pages)).collect()}
    assert (got[1].url, got[1].scraped_content, got[1].scrape_status) == ("u1x", "hi", "partial")
    assert (got[2].url, got[2].scraped_content, got[2].scrape_status) == ("u2", None, None)


def test_fetch_list_numbers_a_hot_domain(spark):
    df = spark.range(200).select(
        F.concat(F.when(F.col("id") % 3 == 0, F.lit("http://hot/")).otherwise(F.concat(F.lit("http://d"), F.col("id"), F.lit("/"))), F.col("id")).alias("url"),
        F.col("id").alias("ord"), F.lit(80).alias("relevance_score"))
    rows = content.fetch_list(df).collect()
    hot = sorted((int(r.url.split("/")[-1]), r.domain_seq) for r in rows if r.domain == "hot")
    assert [n for _, n in hot] == list(range(1, 68))
    assert sorted(r.fetch_batch for r in rows) == sorted([1 + i // 10 for i in range(200)])


def test_sentiment_ratio(spark):
    df = spark.createDataFrame(
        [(["Positive"],), (["positive"] * 9 + ["NEGATIVE"] * 7,), (["neutral"],), ([],), (None,)], "l array<string>")
    got = [r.s for r in df.select(scoring.sentiment_ratio(F.col("l")).alias("s")).collect()]
    assert got == [1.0, 0.12, 0.0, 0.0, 0.0]


def test_batch_scorer_scores_each_distinct_piece_once(spark):
    def load():
        seen = set()

        def model(texts):
            assert len(texts) <= 2 and not seen.intersection(texts)
            seen.update(texts)
            return ["positive" if "good" in t else "negative" for t in texts]

        return model

    scorer = scoring.batch_scorer(load, "string", batch_size=2)
    df = spark.createDataFrame([(["good a", "bad", "good a"],), (["bad", "x"],), (None,)], "p array<string>").coalesce(1)
    got = [r.l for r in df.select(scorer(F.col("p")).alias("l")).collect()]
    assert got == [["positive", "negative", "positive"], ["negative", "negative"], None]


def test_python_models_score_stored_articles(spark, tmp_path):
    """The same labels from a Python model and from an expression, over files."""
    body = "The best day of all. Of a bad day, it was said. Neither here nor there, they went home. " * 3
    rows = [(i, f"the title {i}", body[i:] if i % 3 else None, "success" if i % 4 else "partial") for i in range(12)]
    spark.createDataFrame(rows, "ord int, title string, scraped_content string, scrape_status string").write.parquet(str(tmp_path / "a"))
    articles = spark.read.parquet(str(tmp_path / "a"))
    model = scoring.batch_scorer(scoring.weighted_polarity({"best": 1, "bad": -1}), "string")
    plain = scoring.lexicon_polarity(["best"], ["bad"])
    by = lambda scorer: sorted((r.ord, r.sentiment) for r in scoring.with_sentiment(articles, scorer).collect())
    assert by(model) == by(plain) and len({s for _, s in by(plain)}) > 1

    def shares():
        return lambda texts: [{"health": t.lower().count("the") / 100} for t in texts]

    scored = scoring.batch_scorer(shares, "map<string,double>")
    assert {r.iptc_topic for r in scoring.with_topic(articles, scored).collect()} == {"health", None}
    pooled = scoring.with_label_scores(articles, scored, {"health": "H"}).collect()
    assert all((r.H > 0) == (r.scraped_content is not None) for r in pooled)


def test_scores_of_ineligible_articles(spark):
    rows = [("t", "the the cat", "partial"), ("t", " ", "success"), (None, "the", "success"), ("t", None, None)]
    df = spark.createDataFrame(rows, "title string, scraped_content string, scrape_status string")
    labels = scoring.lexicon_labels({"health": ["the"], "odd": ["zzz"]})
    topics = scoring.with_topic(df, labels).collect()
    assert [(r.iptc_topic, r.iptc_topic_fr) for r in topics] == [("health", "Santé")] + [(None, None)] * 3
    scored = scoring.with_label_scores(df, labels, {"health": "H", "odd": "O"}).collect()
    assert [(r.H, r.O) for r in scored] == [(0.5, 0.0)] + [(0.0, 0.0)] * 3
    assert scoring.topic_name(F.lit("x")) is not None
    feel = scoring.with_sentiment(df, scoring.lexicon_polarity(["the"], ["zzz"]))
    assert [r.sentiment for r in feel.collect()] == [0.0] * 4


def test_text_is_scored_once_for_several_columns(spark):
    df = spark.createDataFrame([("t", "the cat")], "title string, scraped_content string")
    plan = scoring.with_label_scores(df, scoring.lexicon_labels({"restaurant": ["cat"]}), {"restaurant": "R", "hotel/lodging": "H"})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract_all") == 1


def _complete(spark, rows):
    df = spark.createDataFrame(rows, "ord long, url string, title string")
    for field in EXPORT_SCHEMA.fields:
        if field.name not in df.columns and field.name != "processed_timestamp":
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    return df


def test_export_schema_dedup_and_append(spark, tmp_path):
    df = _complete(spark, [(2, "u1", "late"), (1, "u1", "first"), (3, "u2", "x"), (4, None, "lost")])
    out = export.to_export(df, "2025-01-01 00:00:00")
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in EXPORT_SCHEMA]
    assert not out.schema["url"].nullable
    path = str(tmp_path / "table")
    export.append_to_path(out, path)
    stored = spark.read.parquet(path)
    assert sorted((r.url, r.title) for r in stored.collect()) == [("u1", "first"), ("u2", "x")]
    assert export.only_new(out, stored).count() == 0
    assert [r.title for r in export.export_rejects(df).collect()] == ["lost"]


def test_append_to_catalog_table_twice(spark):
    out = export.to_export(_complete(spark, [(1, "u1", "a")]), "2025-01-01 00:00:00")
    try:
        export.append_to_table(out, "newsight_test", "articles")
        export.append_to_table(out, "newsight_test", "articles")
        assert spark.table("newsight_test.articles").count() == 2
    finally:
        spark.sql("DROP DATABASE IF EXISTS newsight_test CASCADE")


def test_missing_enrichment_fails_before_any_job(spark):
    with pytest.raises(KeyError, match="sentiment"):
        export.to_export(_complete(spark, [(1, "u", "t")]).drop(REQUIRED_ENRICHMENTS[0]), "2025-01-01")
