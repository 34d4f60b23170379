"""Conversation trie against a plain one, in one block and in many."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from newsight.llm import prefix_trie, queries

COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is None:
            continue
        role, text = role or "", text or ""
        key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
        own[conv].append(((turn is not None, turn or 0, key), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[c] for c in children[p])
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(built[c]) == len(p))
        out.append((
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: r[:2])


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: r[:2])


@pytest.fixture
def many_blocks(spark):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op12_prefix_trie(spark, sf_dir)) == brute(rows)


def crowded(seed=5, n=400):
    """Few different turns, so prefixes are shared widely; one conversation is a third of all."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        if c % 3 == 0:
            rows += [(c, t, "user", f"same {t} words") for t in range(5)]
            continue
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t, ["user", "system"][rng.integers(2)], "w " * int(rng.integers(3))))
    return rows + [(401, t, "user", f"long {t % 7}") for t in range(600)]


def test_many_blocks(spark, many_blocks):
    rows = crowded()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert rows_of(prefix_trie.conversation_trie(df)) == brute(rows)


@pytest.mark.parametrize("blocks", [1, 13])
def test_odd_rows(spark, request, blocks):
    if blocks > 1:
        request.getfixturevalue("many_blocks")
    rows = [
        (None, 1, "user", "nobody"), (3, None, "user", "first"), (3, 0, None, None), (3, 0, "user", ""),
        (3, 0, "user", ""), (4, 1, "b", "tie"), (4, 1, "a", "tie"), (5, 7, "user", "x" * 100_000),
        (20, 1, "user", "open"), (20, 2, "user", "go"), (21, 1, "user", "own"), (22, 1, "user", "own"),
        (23, 1, "user", "own"), (24, 1, "user", "own"), (25, 5, "user", "own"), (25, 6, "user", "own"),
        (10**15, 1, "user", "far"), (10**15 + 7, 1, "user", "far"), (47, 0, "u", "alone"), (48, 0, "u", "alone"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("block", "seq", "n", "depth", "words", "keys"):
        df = df.selectExpr("*", f"'x' AS {name}")
    assert rows_of(prefix_trie.conversation_trie(df)) == brute(rows)


def test_only_turnless(spark):
    # the first turn comes from an absent conversation, so nothing is left
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    df = spark.createDataFrame([(c, 1, "user", "a"), (c, 2, "user", "b")], "conv_id long, turn long, role string, text string")
    ends = hashlib.sha256(str(c).encode()).hexdigest()
    assert rows_of(prefix_trie.conversation_trie(df)) == [(c, 0, None, 1, 0, 1, 0, ends)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.conversation_trie(df).collect() == []


def test_extents_by_plain_search():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 6, 300)
    table = prefix_trie.SparseTable(values)
    start, least = rng.integers(0, 300, 500), rng.integers(0, 7, 500)
    right, left = table.right_extent(start, least), table.left_extent(start, least)
    for s, d, r, l in zip(start, least, right, left):
        want = s
        while want + 1 < 300 and values[want + 1] >= d:
            want += 1
        assert r == want
        want = s
        while want > 0 and values[want] >= d:
            want -= 1
        assert l == want
    low = rng.integers(0, 300, 200)
    high = np.minimum(low + rng.integers(0, 100, 200), 299)
    assert table.minimum(low, high).tolist() == [values[a : b + 1].min() for a, b in zip(low, high)]
