import json

from pyspark.sql import functions as F

from newsight import settings
from newsight.functions import replies as R
from newsight.operators import batches


def test_batch_reply_repair(each):
    cases = {
        '```json\n[{"a":1}]\n```': '[{"a":1}]',
        "```\n[1]\n``` tail": "[1]",
        '  [{"t":"a\\u12 b\\u00e9"}] ': '[{"t":"a b\\u00e9"}]',
    }
    assert each(list(cases), R.repair_batch_reply) == list(cases.values())


def test_article_reply_repair(each):
    cases = {
        '```json\n{"a":"```"}\n```': '{"a":"```"}', '```\n{"a":1}': '{"a":1}',
        '```{"a":1}```': None, '{"a":"\\u12"}': '{"a":""}',
    }
    assert each(list(cases), R.repair_article_reply) == list(cases.values())


def test_reply_json_is_strict(each):
    bad = ["[{'article_id':1}]", '[{"article_id":"0"}] done', "[1,", "", "null", None]
    assert each(bad, R.parse_batch_reply) == [None] * len(bad)
    good = each(['[{"article_id":0,"relevance_score":91.0}]'], R.parse_batch_reply)[0]
    assert good[0].article_id == "0" and good[0].relevance_score == "91.0"


def test_item_problems(each):
    item = {"article_id": "1", "relevance_score": "85", "category": "LOW_RELEVANCE", "reasoning": "", "key_indicators": []}
    broken = {"article_id": "1", "relevance_score": 85.5, "category": "ERROR"}
    got = each(
        [json.dumps([item]), json.dumps([broken])],
        lambda c: R.batch_item_problems(R.parse_batch_reply(c)[0]),
    )
    assert got == [[], ["relevance_score", "category", "reasoning", "key_indicators"]]


def _normalised(spark, rows):
    df = spark.createDataFrame(rows, "summary string, quebec string, perception string, Flag string")
    out = df.select(R.normalise_analysis(*[F.col(c) for c in df.columns]).alias("n"))
    return [r.n for r in out.collect()]


def test_analysis_normalisation(spark):
    moods = [("Négatif", "negative"), ("neutralle", "neutre"), ("POSITIF", "positive"), ("mixed", None)]
    got = _normalised(spark, [("s", "OUI ", m, "1") for m, _ in moods])
    assert [n.perception for n in got] == [want for _, want in moods]
    assert [n.problems for n in got] == [[], [], [], ["perception"]]
    flags = _normalised(spark, [("s", "non", "neutre", f) for f in ("1", " 0", "2", None)])
    assert [n.problems for n in flags] == [[], [], ["Flag"], ["Flag"]]
    # the length is that of the text as sent, blanks included
    lengths = _normalised(spark, [(s, "non", "neutre", "0") for s in ("x" * 500, "x" * 499 + "  ", " ", "")])
    assert [n.problems for n in lengths] == [[], ["summary"], ["summary"], ["summary"]]


def test_lone_object_and_list_are_alike(each):
    texts = ['{"summary":"s","Flag":1}', '[{"summary":"s","Flag":"1"},{"summary":"t"}]', "[]", "{"]
    got = each(texts, R.parse_article_reply)
    assert [g and (g.summary, g.Flag) for g in got] == [("s", "1"), ("s", "1"), None, None]


def test_reconcile_last_duplicate_wins_and_unmatched_is_error(spark):
    articles = spark.createDataFrame([(i, f"t{i}", f"u{i}") for i in range(3)], "ord long, title string, url string")
    raw = json.dumps([
        {"article_id": "0", "relevance_score": 10, "category": "LOW_RELEVANCE", "reasoning": "a", "key_indicators": ["x"]},
        {"article_id": 0, "relevance_score": "90", "category": "HIGHLY_RELEVANT", "reasoning": "b", "key_indicators": ["y", "z"]},
        {"article_id": "2", "category": "LOW_RELEVANCE", "reasoning": "no score"},
    ])
    batched = batches.assign_batches(articles)
    sent = spark.createDataFrame([(0, 2, raw), (0, 1, "oops"), (0, 3, "[]")], "batch_id long, attempt int, raw string")
    best = batches.first_valid(batches.parse_batch_replies(sent), "batch_id", "results")
    got = {r.ord: r for r in batches.reconcile(batched, best).collect()}
    assert (got[0].relevance_score, got[0].reasoning, got[0].key_indicators) == (90, "b", "y, z")
    for i in (1, 2):
        assert (got[i].relevance_score, got[i].category, got[i].key_indicators) == (0, "ERROR", "")
        assert got[i].reasoning == settings.UNMATCHED_REASONING


def test_attempts_beyond_the_limit_do_not_count(spark):
    good = json.dumps([{"article_id": "0"}])
    sent = spark.createDataFrame([(0, 6, good), (1, 5, good)], "batch_id long, attempt int, raw string")
    best = batches.first_valid(batches.parse_batch_replies(sent), "batch_id", "results")
    assert [(r.batch_id, r.attempt) for r in best.collect()] == [(1, 5)]


def test_prompt_text(spark):
    articles = spark.createDataFrame([(i, f"é{i}", f"u{i}") for i in range(26)], "ord long, title string, url string")
    prompts = {r.batch_id: r for r in batches.batch_prompts(batches.assign_batches(articles)).collect()}
    assert (prompts[0].n_articles, prompts[1].n_articles) == (25, 1)
    assert prompts[1].prompt == (
        "Analyze the relevance of these 1 articles to Quebec City and the Capitale-Nationale region.\n\n"
        '**Article 1 (ID: "0"):**\nTitle: é25\nURL: u25\n\n'
        "Return a JSON array with analysis for each article, maintaining the article_id order."
    )


def test_replies_reach_only_articles_that_were_sent(spark):
    from newsight.operators.batches import attach_analysis

    good = '{"summary": "s", "quebec": "oui", "perception": "neutre", "Flag": 0}'
    articles = spark.createDataFrame([(1,), (2,), (3,)], "article_id long")
    replies = spark.createDataFrame([(i, 1, good) for i in (1, 2, 9)], "article_id long, attempt int, raw string")
    asked = spark.createDataFrame([(1,), (3,), (3,)], "article_id long")
    rows = {r.article_id: r.summary for r in attach_analysis(articles, replies, asked=asked).collect()}
    assert rows == {1: "s", 2: None, 3: None}


def test_failed_batches_carry_their_error(spark):
    from newsight.operators.batches import first_valid, parse_batch_replies, reconcile

    batched = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (2, 0)], "batch_id long, batch_index int")
    good = '[{"article_id": "0", "relevance_score": 7, "category": "C", "reasoning": "r", "key_indicators": []}]'
    replies = spark.createDataFrame([(0, 1, good), (1, 1, "nope")], "batch_id long, attempt int, raw string")
    failures = spark.createDataFrame([(1, "503 " + "x" * 90), (0, "earlier attempt")], "batch_id long, error string")
    results = first_valid(parse_batch_replies(replies), "batch_id", "results")
    rows = {(r.batch_id, r.batch_index): r.reasoning for r in reconcile(batched, results, failures).collect()}
    unmatched = "No matching result from Gemini"
    assert rows == {(0, 0): "r", (0, 1): unmatched, (1, 0): ("503 " + "x" * 90)[:50], (2, 0): unmatched}
