"""Importance resampling and its checksums against plain versions."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from newsight.llm import importance, queries

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))


def brute(docs, bench):
    def buckets(text):
        w = words_of(text)
        grams = w + [a + b" " + b for a, b in zip(w, w[1:])]
        return [zlib.crc32(g) % 10_000 for g in grams]

    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [x for _, x in docs]), (t, bench)):
        for x in texts:
            for b in buckets(x):
                counts[b] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log(((b + 1) * (S + 10_000)) / ((a + 1) * (T + 10_000)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in docs:
        f = [gain[b] for b in buckets(text)]
        weight = sum(f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, score, None, len(words_of(text)) >= 20])
    can = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for k, r in enumerate(can[: 25 * len(can) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_whole_table(spark, sf_dir, documents):
    bench = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = queries.op13_importance(spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=repr) == brute(list(documents.items()), bench)


def test_odd_rows(spark, odd):
    bench = spark.createDataFrame([("w1 W2 w3",), (None,), ("",), ("w1 w2",)], "text string")
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = importance.resample(odd, bench).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, ["w1 W2 w3", None, "", "w1 w2"])


def test_long_words(spark):
    long = ["a" * 70_000 + " " + "é" * 500 + " b" * 30, "x" * 64 + " " + "y" * 65 + " z" * 25, "7" * 129]
    rows = list(enumerate(long))
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("z z b",)], "text string")
    got = importance.resample(docs, bench, percent=25).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, ["z z b"])


def test_ties_and_repeats(spark):
    text = " ".join(f"t{i}" for i in range(25))
    rows = [(5, text)] * 40 + [(6, text)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = importance.resample(docs, docs.limit(0)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 21))
    assert len({r["doc_id"] for r in got if r["rank"]}) == 1


def test_empty_tables(spark, empty):
    assert importance.resample(empty, empty).collect() == []


@pytest.mark.parametrize("positions", [1, 3, 64])
def test_position_crc(positions):
    rng = np.random.default_rng(positions)
    crc = importance.PositionCrc(positions)
    parts = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (1, 2, 3, 63, 64, 65, 127, 128, 129, 5_000)]
    buffer = np.frombuffer(b" ".join(parts), np.uint8)
    lens = np.array([len(p) for p in parts])
    starts = np.cumsum(lens + 1) - lens - 1
    assert crc.spans(buffer, starts, lens).tolist() == [zlib.crc32(p) for p in parts]
