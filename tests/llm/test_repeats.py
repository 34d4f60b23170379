"""Substring removal by words and by bytes against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from newsight.llm import queries, repeats, substring, suffix
from newsight.llm.anchors import Hasher, segments


def brute_words(docs):
    least = {}
    split = [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in split:
        for i in range(len(w) - 12):
            g = tuple(w[i : i + 13])
            least[g] = min(least.get(g, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if least[tuple(w[i : i + 13])] < d:
                gone[i : i + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def brute_bytes(docs, n=400):
    data = [(d, (t or "").encode()) for d, t in docs]
    count = Counter(t[i : i + n] for _, t in data for i in range(len(t) - n + 1))
    out = []
    for d, t in data:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if count[t[i : i + n]] > 1:
                gone[i : i + n] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_words_whole_table(spark, sf_dir, documents):
    got = queries.op2_substring(spark, sf_dir).collect()
    rows = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got)
    assert rows == brute_words(list(documents.items()))


def test_bytes_whole_table(spark, sf_dir, documents):
    got = queries.op10_suffix(spark, sf_dir).collect()
    rows = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got)
    assert rows == brute_bytes(list(documents.items()))


@pytest.mark.parametrize("hot", [0, repeats.HOT])
def test_hot_anchors_give_the_same(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = np.random.default_rng(3)
    common = " ".join(f"c{i}" for i in range(120))
    docs = []
    for i in range(40):
        around = [" ".join(f"r{x}" for x in rng.integers(0, 900, 30)) for _ in range(2)]
        words = common.split()
        words[i % 60] = f"edit{i % 7}"
        docs.append((i, f"{around[0]} {' '.join(words)} {around[1]}"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = substring.remove_repeats(frame).collect()
    assert sorted(
        (r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in got
    ) == brute_words(docs)
    got = suffix.remove_repeats(frame).collect()
    assert sorted(
        (r["doc_id"], r["n_bytes"], sum(s["last"] - s["first"] + 1 for s in r["removed"]), len(r["removed"]),
         hashlib.sha256(r["kept"]).hexdigest()) for r in got
    ) == brute_bytes(docs)


def test_odd_rows(odd):
    got = substring.remove_repeats(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["n_removed"] for r in by[1]] == [0, 0]  # equal ids do not remove from each other
    assert by[2][0]["n_removed"] == 160 and by[11][0]["kept_text"] == "before after"
    assert by[3][0]["n_words"] == by[4][0]["n_words"] == by[5][0]["n_words"] == 0
    assert sorted(r["n_removed"] for r in by[None]) == [0, 160]  # rows without an id come last
    assert by[9][0]["n_removed"] == 0  # repeats inside one document stay

    got = suffix.remove_repeats(odd).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(got) == odd.count()
    assert by[1][0]["kept"] == b"" and by[3][0]["n_bytes"] == 0
    assert by[11][0]["removed"] == [] or by[11][0]["kept"].startswith(b"before")
    assert by[9][0]["kept"] == b""  # the text repeats itself


def test_empty_tables(empty):
    assert substring.remove_repeats(empty).count() == 0
    assert suffix.remove_repeats(empty).count() == 0


def test_segments_cover_every_window_once():
    rng = np.random.default_rng(1)
    units = rng.integers(0, 4, 500).astype(np.uint8)
    ends = np.array([0, 30, 30, 210, 215, 500])
    found = segments(units, ends, 40, 12, Hasher())
    seen = Counter(w for a, b in zip(found.start, found.stop) for w in range(a, b))
    want = [w for a, b in zip(np.concatenate([[0], ends]), ends) for w in range(a, b - 39)]
    assert seen == Counter(want)
    same = {}
    for a, b, anchor in zip(found.start, found.stop, found.anchor):
        for w in range(a, b):
            assert same.setdefault(units[w : w + 40].tobytes(), anchor) == anchor


def test_fm_index_counts_and_matching_statistics():
    rng = np.random.default_rng(2)
    text = np.concatenate([np.append(rng.integers(1, 5, 60), 0) for _ in range(5)])
    index = substring.FMIndex(text, 13)
    starts = np.arange(len(text) - 3)
    low, high = index.intervals(text, starts, 3)
    grams = [tuple(text[i : i + 3]) for i in starts]
    count = Counter(grams)
    inner = [i for i, g in enumerate(grams) if 0 not in g]
    assert [int(high[i] - low[i]) for i in inner] == [count[grams[i]] for i in inner]

    query = rng.integers(1, 5, 80)
    got = index.matching_statistics(query, 8)
    whole = {tuple(text[i : i + k]) for k in range(1, 9) for i in range(len(text) - k + 1)}
    for i in range(len(query)):
        best = max((k for k in range(1, 9) if k <= i + 1 and tuple(query[i - k + 1 : i + 1]) in whole), default=0)
        assert got[i] == best


@pytest.mark.parametrize("sizes", [[3], [1, 1, 1, 1, 1], [4, 1, 1, 2, 1]])
def test_level_family_finds_all_matches(sizes):
    rng = np.random.default_rng(sum(sizes))
    pool = [rng.integers(97, 100, 60).astype(np.uint8).tobytes() for _ in range(3)]
    family, every = suffix.LevelFamily(depth=20), []
    for n in sizes:
        batch = [pool[rng.integers(3)][rng.integers(20):] + rng.integers(97, 100, 25).astype(np.uint8).tobytes() for _ in range(n)]
        every += batch
        family.add(batch)
    count = Counter(c[i : i + 20] for c in every for i in range(len(c) - 19))
    at = 0
    for c in every:
        got = family.matched[at : at + len(c)]
        assert [bool(g) for g in got] == [i <= len(c) - 20 and count[c[i : i + 20]] > 1 for i in range(len(c))]
        at += len(c)
    sizes = [len(level.text).bit_length() for level, _ in family.levels]
    assert sizes == sorted(set(sizes), reverse=True)
