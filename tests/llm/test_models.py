"""Classifiers by held-out accuracy, their parts by brute force."""

import math
import time
from itertools import combinations

import numpy as np
import pytest

from newsight.llm import quality, queries, toxicity, url_filter

SF = "/root/testdata/sf0.01"


def held_out_pairs(spark, query, column):
    labels = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = query(spark, SF).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    return rows, [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]


def test_toxicity_held_out(spark):
    rows, pairs = held_out_pairs(spark, queries.op4_toxicity, "toxic")
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert sum(p == y for p, y in pairs) / len(pairs) > 0.9


def test_quality_held_out(spark):
    _, pairs = held_out_pairs(spark, queries.op8_quality, "quality")
    assert sum(p == y for p, y in pairs) / len(pairs) > 0.9


def test_maximal_segments_by_definition():
    """The best segment first, then the best on either side of it, recursively."""
    def plain(scores, offset=0):
        best = max(
            ((sum(scores[a:b]), -(b - a), a, b) for a, b in combinations(range(len(scores) + 1), 2)),
            default=(0, 0, 0, 0),
        )
        if best[0] <= 0:
            return []
        a, b = best[2:]
        return [*plain(scores[:a], offset), (a + offset, b + offset - 1), *plain(scores[b:], offset + b)]

    rng = np.random.default_rng(4)
    for _ in range(200):
        scores = rng.choice([-3.5, -2.25, -1.125, 1.0625, 2.5, 4.03125], rng.integers(1, 14))
        scores = scores + rng.random(len(scores)) / 100
        got = toxicity.maximal_segments(scores)
        assert [(a, b) for a, b, _ in got] == plain(list(scores))
        assert all(math.isclose(s, scores[a : b + 1].sum()) for a, b, s in got)
    assert toxicity.maximal_segments(np.array([-1.0, -2.0])) == []


def test_segments_take_linear_time():
    """Falling sums: every candidate begins lower than all before it, or higher than all."""
    def seconds(n, drift):
        scores = np.tile([1.0, -1.0 - drift], n) + np.linspace(0, 0.1, 2 * n)
        start = time.perf_counter()
        found = toxicity.maximal_segments(scores)
        assert found
        return time.perf_counter() - start

    for drift in (0.5, -0.02):
        assert seconds(80_000, drift) < 10 * seconds(20_000, drift) + 0.5


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    kept = toxicity.without_toxic(odd, model, threshold=2.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    neutral = toxicity.fit(odd, labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd, neutral).collect()} == {0.5}
    assert toxicity.score(empty, model).count() == 0


def test_attention_gradients():
    rng = np.random.default_rng(0)
    p = quality.init_weights(rng)
    x, starts, y = rng.normal(size=(9, quality.N_FEATURES)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])

    def loss(p):
        s, _ = quality.forward(p, x, starts)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grad = quality.gradients(p, x, starts, y)
    for name, value in p.items():
        at = tuple(rng.integers(n) for n in value.shape)
        up, down = {**p, name: value.copy()}, {**p, name: value.copy()}
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert grad[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-6)


def test_quality_reads_whole_texts_and_odd_rows(spark, odd, empty):
    assert quality.encode(b"").shape == (1, quality.N_FEATURES)
    long = quality.encode(b"good words here " * 40_000 + b"### " * 40_000)
    assert len(long) <= quality.MAX_PASSAGES and long[-1][5] > 0.5
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (None, 1), (4, None)], "doc_id long, quality int")
    model = quality.fit(odd, labels)
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(empty, quality.fit(odd, labels.limit(0))).count() == 0


def plain_rule(url):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    cut = lambda s, marks: s[: min((s.find(m) for m in marks if m in s), default=len(s))]
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = cut(rest, "/?#")
    path = cut(rest[len(host):], "?#")
    host = low(host)
    fits = []
    for text, verdict in [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
                          ("com/fr/", "allow"), ("com/de/", "block")]:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(text), text, verdict))
    return host, path, max(fits)[1:] if fits else None


def test_url_rules(spark, sf_dir):
    urls = [r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("url").collect()]
    urls += [None, "", "no scheme", "HTTP://A.B.Example.ORG/es/x?y#z", "x://org", "x://ORG/", "a://b://c.com/fr/",
             "x://com/de/1", "x://ecom/de/1", "x://example.org/en/12", "x://y.example.org?/es/", "x://é.com/fr/\n1#q", "://com/fr/"]
    frame = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    labelled = spark.createDataFrame([("http://a.com/1", True), ("http://b.com/22", False), (None, True), ("x", None)], "url string, block boolean")
    rows = url_filter.judge(frame, queries.URL_RULES, url_filter.fit(labelled)).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule = plain_rule(urls[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (rule[0] if rule else None)
        assert r["verdict"] == rule[1] if rule else r["verdict"] in ("allow", "block")
        assert (r["block_score"] is None) == bool(rule)
    none = url_filter.fit(labelled.limit(0))
    assert url_filter.judge(frame.limit(0), queries.URL_RULES, none).count() == 0


def test_url_trees_learn_lexical_differences(spark):
    rows = [(f"http://site{i}.net/page/{i}", False) for i in range(150)]
    rows += [(f"http://x{i * 7919}q{i}-win-{i}9987.net/a/b/c?x={i}&y=2&z={i}", True) for i in range(150)]
    model = url_filter.fit(spark.createDataFrame(rows, "url string, block boolean"))
    fresh = spark.createDataFrame([("http://site900.net/page/77",), ("http://x1234q9-win-19987.net/a/b/c?x=5&y=2&z=8",)], "url string")
    got = {r["url"]: r["verdict"] for r in url_filter.judge(fresh, [], model).collect()}
    assert list(got.values()) == ["allow", "block"]


def test_native_plan_has_no_python(spark, sf_dir):
    for query in (queries.op9_url_filter, queries.op3_pii):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_clean_words_keep_their_negative_scores(spark):
    rows = [(i, "calm calm gentle river" if i % 2 else "vile nasty") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    vile, nasty, calm, river, unknown = model.weights[toxicity.token_slots([b"vile", b"nasty", b"calm", b"river", b"zzz"])]
    assert vile == nasty > 0 > unknown == -toxicity.DRIFT > -1.0 > calm == river
    assert len(model.weights) == 1 << toxicity.SLOT_BITS


def test_fit_sees_large_numbers_of_segments(spark):
    seen = spark.createDataFrame([(n,) for n in (0, 1, 64, 65, 1000, 200_000)], "n int")
    rows = seen.select("n", toxicity.binned(seen["n"]).alias("b")).collect()
    assert all(abs(r["b"] - r["n"]) <= 0.05 * r["n"] and (r["n"] > 64 or r["b"] == r["n"]) for r in rows)
