"""Sparse vectors, their similarity join and the closed-form label model against plain versions."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from newsight.operators import models, sparse
from newsight.operators.clusters import cluster_texts
from test_similarity import brute_components


def workload(n, seed, hot=0.3):
    """Sparse unit rows: a third near copies of one row, some exact copies, a term in a third of all."""
    rng = np.random.default_rng(seed)
    rows = np.zeros((n, 200))
    for i in range(n):
        terms = rng.choice(199, rng.integers(1, 12), replace=False)
        rows[i, terms] = rng.random(len(terms)) + 0.1
    rows[rng.random(n) < hot, 199] = 2.0
    base = rows[0] + 0.0
    rows[n // 2 : n // 2 + n // 3] = base * (1 + 0.2 * rng.random((n // 3, 200)))
    rows[-5:] = rows[3]
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def as_frame(spark, rows):
    data = [(i, [int(t) for t in np.flatnonzero(r)], [float(x) for x in r[r > 0]]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "article_id long, terms array<int>, weights array<double>").repartition(4)


@pytest.mark.parametrize("threshold", [0.4, 0.85, 0.99])
@pytest.mark.parametrize("block_rows", [16, 1_000])
def test_pairs_and_links_equal_brute_force(spark, threshold, block_rows):
    rows = workload(150, 7)
    close = np.triu(rows @ rows.T >= threshold, 1)
    first = {}
    for i, r in enumerate(rows):
        first.setdefault(r.tobytes(), i)
    firsts = set(first.values())
    want = {(i, j) for i, j in zip(*np.nonzero(close)) if i in firsts and j in firsts}
    want |= {(first[r.tobytes()], i) for i, r in enumerate(rows) if first[r.tobytes()] != i}
    df = as_frame(spark, rows)
    got = Counter((r.src, r.dst) for r in sparse.sparse_pairs(df, "article_id", threshold, block_rows).collect())
    assert got == Counter({p: 1 for p in want})
    links = [(r.src, r.dst) for r in sparse.sparse_links(df, "article_id", threshold, block_rows).collect()]
    assert brute_components(len(rows), links) == brute_components(len(rows), list(zip(*np.nonzero(close))))


def test_links_of_near_copies_are_linear(spark):
    rng = np.random.default_rng(1)
    rows = np.abs(np.ones((300, 20)) + 0.05 * rng.random((300, 20)))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    links = sparse.sparse_links(as_frame(spark, rows), "article_id", 0.9).count()
    assert 299 <= links <= 4 * 300


def test_a_long_list_is_dealt_to_units(spark):
    data = [(7, i, 1.0, 0.0) for i in range(1_000)] + [(8, 5, 0.5, 0.5)]
    posted = spark.createDataFrame(data, "term int, id long, w double, rest double")
    left, right = sparse.units(posted, block_rows=100)
    for side in (left, right):
        sizes = {tuple(r)[:3]: r["count"] for r in side.groupBy("term", "x", "y").count().collect()}
        assert max(sizes.values()) < 200 and sizes[(8, 0, 0)] == 1
    # every pair of the list meets in one unit
    units = left.select("term", "x", "y", "id").join(
        right.select("term", "x", "y", right["id"].alias("other")), ["term", "x", "y"]
    ).filter("term = 7 AND (x < y OR id < other)")
    assert units.count() == 1_000 * 999 // 2


def test_postings_stop_at_the_threshold(spark):
    df = spark.createDataFrame([(1, [0, 1], [0.6, 0.8]), (2, [1], [1.0])], "id long, terms array<int>, weights array<double>")
    got = {(r.term, r.id) for r in sparse.postings(df, 0.9).collect()}
    assert got == {(0, 1), (1, 2)}


def plain_vectors(texts, features):
    counts = [Counter(models.term_of(w, features) for w in re.findall(r"[^\W\d_]+", (t or "").lower())) for t in texts]
    df = Counter(t for c in counts for t in c)
    out = []
    for c in counts:
        w = {t: n * math.log((len(texts) + 1) / (df[t] + 1)) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.append({t: x / norm for t, x in w.items() if x > 0})
    return out


TEXTS = ["One two two three.", None, "", "123 !?", "two", "two", "élan ÉLAN vital two", "word " * 5_000 + "end", "a b c d e f g"]


@pytest.mark.parametrize("features", [1 << 18, 7])
def test_vectors(spark, features):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "'x' AS terms", "'y' AS id")
    got = {r.doc_id: dict(zip(r.terms, r.weights)) for r in models.doc_vectors(docs, "doc_id", "text", features).collect()}
    for i, want in enumerate(plain_vectors(TEXTS, features)):
        assert got[i].keys() == want.keys()
        assert all(abs(got[i][t] - w) < 1e-12 for t, w in want.items())
    assert models.term_of("two") == int(hashlib.md5(b"two").hexdigest()[:8], 16) % (1 << 18)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    vectors = models.doc_vectors(none, "doc_id", "text")
    assert vectors.collect() == []
    assert cluster_texts(vectors, "doc_id").collect() == []


def test_label_model(spark):
    rows = [(i, f"common {'red apple' if i % 2 else 'blue sky'} w{i % 5}", i % 2) for i in range(40)]
    rows += [(90, "red red", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = models.train_label_model(df, "doc_id", "text", "label", features=1 << 12)
    assert model.classes == [0, 1] and np.allclose(np.exp(model.priors), 0.5)
    new = spark.createDataFrame([(1, "a red thing"), (2, "blue"), (3, ""), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.p for r in models.score_label(model, new, "doc_id", "text", "p").collect()}
    assert got[1] > 0.8 and got[2] < 0.2 and got[3] == got[4] == pytest.approx(0.5)
    # by hand: one term, seen in no row of class 1 and all 20 of class 0
    assert got[2] == pytest.approx((1 / 22) / (1 / 22 + 21 / 22))


def test_label_model_of_three_classes(spark):
    rows = [(i, ["cat", "dog", "owl"][i % 3], ["x", "y", "z"][i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    model = models.train_label_model(df, "doc_id", "text", "label")
    p = {k: models.score_label(model, df, "doc_id", "text", "p", k).filter("doc_id = 1").first().p for k in model.classes}
    assert sum(p.values()) == pytest.approx(1.0) and max(p, key=p.get) == "y"
    with pytest.raises(ValueError):
        models.train_label_model(df.filter("label IS NULL"), "doc_id", "text", "label")


def test_blocks_find_all_candidates_in_small_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(sparse, "_PRODUCTS", 50)
    monkeypatch.setattr(sparse, "_CELLS", 200)
    monkeypatch.setattr(sparse, "_BOUNDED", 3)
    rng = np.random.default_rng(3)
    full = rng.random((60, 30)) * (rng.random((60, 30)) < 0.3)
    full[:, 0] += 0.01
    full[30:] = full[:30] + 0.1 * rng.random((30, 30)) * (full[:30] > 0)
    full /= np.linalg.norm(full, axis=1, keepdims=True)
    rests = np.sqrt(np.cumsum(full[:, ::-1] ** 2, axis=1))[:, ::-1]
    kept = [[t for t in np.flatnonzero(r) if s[t] >= 0.8] for r, s in zip(full, rests)]
    tail = [math.sqrt(max(0.0, 1 - sum(r[k] ** 2))) for r, k in zip(full, kept)]
    table = pa.table({
        "id": list(range(60)), "group": list(range(60)),
        "terms": pa.array([[int(t) for t in k] for k in kept], pa.list_(pa.int32())),
        "weights": pa.array([r[k] for r, k in zip(full, kept)], pa.list_(pa.float32())),
        "tail": pa.array(tail, pa.float32()),
    })
    want = set(zip(*np.nonzero(np.triu(full @ full.T >= 0.8, 1))))
    whole = sparse._Side(table)
    halves = [sparse._Side(table.slice(0, 25)), sparse._Side(table.slice(25))]
    pairs = lambda a, b: [(r["src"], r["dst"]) for x in sparse._candidates(a, b, a is b, 0.8) for r in x.to_pylist()]
    one, three = pairs(whole, whole), [p for a, b in ((0, 0), (0, 1), (1, 1)) for p in pairs(halves[a], halves[b])]
    assert len(one) == len(set(one)) and set(one) == set(three) and len(three) == len(one)
    assert want <= set(one) and len(want) >= 25 and len(one) < 60 * 59 // 4


def test_pairs_that_only_meet_are_not_shuffled(spark):
    from newsight.session import materialise

    prefix = materialise(sparse.prefixes(as_frame(spark, workload(50, 2)).withColumnRenamed("article_id", "id"), 0.9), "t")
    met = sparse._met(prefix.selectExpr("*", "id AS group"), 0.9, 16)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(x" in plan and "hashpartitioning(src" not in plan


def test_batches_of_texts_are_bounded(spark):
    """In records alone 3,000 long texts were one batch of a worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1g")
    try:
        docs = spark.range(3_000, numPartitions=1).selectExpr("id AS doc_id", "repeat(concat('w', char(97 + id % 26), ' '), 3000) AS text")

        def rows(batches):
            import pyarrow as pa

            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

        counted = models.term_counts(docs, "doc_id", "text")
        words = docs.selectExpr("split(text, ' ') AS words").mapInArrow(rows, "n long")
        assert counted.count() == 3_000 and max(r.n for r in words.collect()) < 1_000
    finally:
        spark.conf.set(name, before)


def test_passes_hold_each_pair_of_blocks_once():
    for blocks in range(1, 60):
        parts = sparse.passes(blocks)
        assert sorted(d for part in parts for d in part) == list(range(blocks))
        # each row moves as the left and as the right block of a pair
        for part in parts:
            assert max(sum((x + d < blocks) + (d > 0 and x >= d) for d in part) for x in range(blocks)) <= sparse.COPIES


def test_full_blocks_are_compared_in_passes(spark, monkeypatch):
    """Rows were moved once for every block at once, and all vectors were stored."""
    stored = []

    def kept(df, name, real=sparse.materialise):
        stored.append((name, dict(df.dtypes).get("weights")))
        return real(df, name)

    def counted(df, name):
        table = kept(df, name)
        return table, table.count()

    monkeypatch.setattr(sparse, "materialise", kept)
    monkeypatch.setattr(sparse, "materialise_counted", counted)
    monkeypatch.setattr(sparse, "FULL_POSTINGS", 45)
    monkeypatch.setattr(sparse, "MOVED_TERMS", 150)
    monkeypatch.setattr(sparse, "MOVED_SHARE", 0.0)
    monkeypatch.setattr(sparse, "_GATHERED", 0)
    rows = workload(60, 5)
    close = np.triu(rows @ rows.T >= 0.4, 1)
    links = [(r.src, r.dst) for r in sparse.sparse_links(as_frame(spark, rows), "article_id", 0.4, 4).collect()]
    assert brute_components(len(rows), links) == brute_components(len(rows), list(zip(*np.nonzero(close))))
    assert all(close[i, j] for i, j in links)
    names = [n for n, _ in stored]
    assert names.count("sparse-reached") > 1 and names.count("sparse-candidates") > 2 and names.count("sparse-wanted") > 2
    assert {n for n, weights in stored if weights == "array<double>"} == {"sparse-wanted"}


def test_candidates_inside_a_group_are_not_all_computed(spark, monkeypatch):
    """All candidates' vectors were moved: 1,770 pairs of a group of 60."""
    from newsight.session import materialise

    monkeypatch.setattr(sparse, "MOVED_TERMS", 500)
    monkeypatch.setattr(sparse, "MOVED_SHARE", 0.0)
    rng = np.random.default_rng(4)
    rows = np.ones((62, 10)) + 0.05 * rng.random((62, 10))
    rows[60:, 5:] = 0.0  # candidates that do not reach the threshold
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    vectors = as_frame(spark, rows).withColumnRenamed("article_id", "id")
    every = [(i, j, 0.5) for i in range(62) for j in range(i + 1, 62)]
    pairs = materialise(spark.createDataFrame(every, "src long, dst long, score double"), "t")
    lens = materialise(vectors.selectExpr("id", "size(terms) AS n"), "t")
    links = [(r.src, r.dst) for part in sparse._joined(pairs, [], vectors, lens, 0.9) for r in part.collect()]
    want = list(zip(*np.nonzero(np.triu(rows @ rows.T >= 0.9, 1))))
    assert brute_components(62, links) == brute_components(62, want)
    assert 60 <= len(links) <= 3 * 62
