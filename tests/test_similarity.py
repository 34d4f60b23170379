import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsight.operators import components
from newsight.operators.clusters import cluster_articles, number_clusters, with_cluster_id
from newsight.operators.similarity import cosine_pairs, similarity_links


def brute_components(n, edges):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def as_frame(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "article_id long, embedding array<float>").repartition(5)


def workload(dims, n, seed):
    """Random vectors, a third of them near copies of one, some exact copies, one zero."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims)).astype(np.float32)
    v[n // 2 : n // 2 + n // 3] = v[0] + 0.05 * rng.normal(size=(n // 3, dims)).astype(np.float32)
    v[-6:-1] = v[3]
    v[-1] = 0
    return v


def similar(v, threshold):
    norm = np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    unit = np.divide(v, norm, out=np.zeros_like(v, dtype=np.float64), where=norm > 0)
    close = unit @ unit.T >= threshold
    np.fill_diagonal(close, False)
    return close


@pytest.mark.parametrize("dims,n,threshold", [(8, 420, 0.85), (32, 300, 0.3), (3, 260, 0.99)])
def test_pairs_and_clusters_equal_brute_force(spark, dims, n, threshold):
    v = workload(dims, n, dims)
    close = similar(v, threshold)
    first = {}
    for i in range(n):
        first.setdefault(v[i].tobytes(), i)
    pairs = set()
    for i, j in zip(*np.nonzero(np.triu(close, 1)), strict=True):
        fi, fj = first[v[i].tobytes()], first[v[j].tobytes()]
        if fi == fj:
            pairs.add((fi, int(j)))
        elif (fi, fj) == (i, j):
            pairs.add((int(i), int(j)))
    df = as_frame(spark, v)
    sizing = dict(rows_per_cell=60, block_rows=25)
    got = [tuple(sorted(r)) for r in cosine_pairs(df, threshold=threshold, **sizing).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs

    links = similarity_links(df, threshold=threshold, **sizing).collect()
    labels = brute_components(n, list(zip(*np.nonzero(close), strict=True)))
    assert brute_components(n, [tuple(r) for r in links]) == labels

    members, number, want = Counter(labels), {}, []
    for i in range(n):
        want.append(number.setdefault(labels[i], len(number) + 1) if members[labels[i]] > 1 else 0)
    clusters = cluster_articles(df, threshold=threshold, **sizing)
    out = with_cluster_id(df.select("article_id"), clusters, "article_id").orderBy("article_id")
    assert [r.cluster_id for r in out.collect()] == want


def test_a_dense_group_gets_few_pivots_and_stays_in_its_cell(spark):
    from pyspark.sql import Row

    from newsight.operators.similarity import _assigner, _spread

    v = workload(16, 300, 2)[:-1]
    sample = [Row(id=i, vec=[float(x) for x in row]) for i, row in enumerate(v)]
    chosen, pivots = _spread(sample, 300, 0.85)
    dense = {0} | set(range(150, 250))
    assert sum(row.id in dense for row in chosen) == 1 and len(chosen) > 150
    batch = pa.RecordBatch.from_pylist([{"id": r.id, "vec": r.vec} for r in sample if r.id in dense])
    batch = batch.set_column(1, "vec", batch.column("vec").cast(pa.list_(pa.float32())))
    out = next(_assigner(pivots, 0.85, True)(iter([batch])))
    homes = {c for c, role in zip(out["cell"].to_pylist(), out["role"].to_pylist(), strict=True) if role < 2}
    assert len(homes) == 1


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "article_id long, embedding array<float>")
    assert cluster_articles(empty).count() == 0


def test_cluster_numbers_follow_first_member(spark):
    edges = spark.createDataFrame([(3, 1), (3, 5), (2, 4)], "src long, dst long")
    assert {r.node: r.cluster_id for r in number_clusters(edges).collect()} == {1: 1, 3: 1, 5: 1, 2: 2, 4: 2}


@pytest.mark.parametrize("chunk", [3, 1_000_000])
def test_components(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "_CHUNK_EDGES", chunk)
    rng = random.Random(7)
    hub = [(0, i) for i in range(1, 120)]
    chain = [(i, i + 1) for i in range(200, 330)]
    loose = [(rng.randint(400, 700), rng.randint(400, 700)) for _ in range(150)]
    edges = hub + chain + loose + [(5, 5)]
    want = brute_components(701, edges)
    touched = {x for a, b in edges if a != b for x in (a, b)}
    df = spark.createDataFrame(edges, "src long, dst long").repartition(6)
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == {i: want[i] for i in touched}


def test_no_edges(spark):
    none = spark.range(3).select(F.col("id").alias("src"), F.col("id").alias("dst"))
    assert components.connected_components(none).count() == 0


def test_cells_that_do_not_prune_are_left_out():
    from pyspark.sql import Row

    from newsight.operators.similarity import _assigner, _spread, _useful

    rng = np.random.default_rng(4)
    loose = rng.normal(size=(400, 64)).astype(np.float32)
    centres = rng.normal(size=(20, 64))
    tight = (centres[np.arange(400) % 20] + 0.02 * rng.normal(size=(400, 64))).astype(np.float32)
    for v, threshold, few in ((loose, 0.4, True), (tight, 0.95, False)):
        sample = [Row(id=i, vec=[float(x) for x in row]) for i, row in enumerate(v)]
        pivots = _spread(sample, 64, threshold)[1]
        used = _useful(sample, pivots, threshold)
        assert (used <= 8) if few else (used == len(pivots) == 20)
        batch = pa.RecordBatch.from_pylist([{"id": r.id, "vec": r.vec} for r in sample])
        batch = batch.set_column(1, "vec", batch.column("vec").cast(pa.list_(pa.float32())))
        placed = sum(x.num_rows for x in _assigner(pivots[:used], threshold, True)(iter([batch])))
        assert placed <= 8 * len(v)


def test_copies_of_a_row_do_not_grow_with_its_cell(spark):
    from newsight.operators.similarity import _blocked

    for n in (100, 1_000):
        rows = spark.range(n).selectExpr("id", "array(1f) AS vec", "0 AS cell", "0 AS role")
        blocked = _blocked(rows, 10, 1_000)
        assert blocked.count() == 8 * n
        assert blocked.filter("side = 0 AND block_a = block_b").count() == n


def test_rough_products_decide_nothing():
    from newsight.operators.similarity import _close

    rng = np.random.default_rng(5)
    v = rng.normal(size=(200, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for threshold in (0.2, 0.3, float((v @ v.T)[3, 9])):
        assert (_close(v, v, threshold) == (v @ v.T >= threshold - 1e-15)).all()
