"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values.

A token's score is the lower confidence bound of its log-odds of standing in a toxic
document, under a Dirichlet prior in proportion to the whole training corpus (Monroe,
Colaresi, Quinn 2008), less a drift that makes ordinary text score below zero. A linear
scan finds every maximal segment (Ruzzo, Tompa 1999). For clean text the best segment of n
tokens exceeds s with probability 1 - exp(-K n exp(-L s)) (Karlin, Altschul 1990); a
logistic map from that significance to the labels gives the document's score.

Tokens are hashed to a fixed number of slots, so the model has one size for any corpus;
all tokens of all labelled training documents are counted, once for each document. Counts
are summed and scored in Spark; the driver gets one signed score for each slot, many to a
row as 32-bit floats. A slot without training text scores minus the drift.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsight.llm.common import (
    bounded_batches, hash_words, held_out, keyed_text, plain_words, release, slices, split_all, stored,
    text_bytes,
)

SLOT_BITS = 20
BLOCKS = 64  # ranges of slots; a row to the driver holds slots of one range
PRIOR_SHARE = 0.1  # tokens of the prior, as a share of all training tokens
Z_BOUND = 1.64  # one-sided 95 % bound of the log-odds
DRIFT = 0.5
SIGNIFICANT_E = 0.05  # expected number of such segments in a clean document
_COUNTS = "slot int, toxic long, clean long"
_EVIDENCE = "toxic int, n_tokens long, best double, n_segments int"
SCORES = (
    "doc_id long, score double, n_tokens long, best double, n_segments int,"
    " segments array<struct<first:int,last:int,score:double>>"
)


class Model(NamedTuple):
    weights: np.ndarray  # one score for each slot
    lam: float
    k: float
    coef: tuple[float, float, float]  # bias, significance, significant segments


def token_slots(words: list[bytes], bits: int = SLOT_BITS) -> np.ndarray:
    return (hash_words(words) >> np.uint64(64 - bits)).astype(np.int64)


def log_odds(n_toxic: int, n_clean: int) -> Column:
    """Score of a slot from its counts ``toxic`` and ``clean`` and those of all slots."""
    total = F.col("toxic") + F.col("clean")
    prior, all_prior = total * PRIOR_SHARE, (n_toxic + n_clean) * PRIOR_SHARE
    y1, y0 = F.col("toxic") + prior, F.col("clean") + prior
    delta = F.log(y1 / (n_toxic + all_prior - y1)) - F.log(y0 / (n_clean + all_prior - y0))
    return delta - Z_BOUND * F.sqrt(1 / y1 + 1 / y0) - DRIFT


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, last, score), in linear time.

    Runs of one sign are summed first; the scan keeps a stack of candidates with the
    cumulative sums to their left and right ends. Each candidate remembers the nearest one before
    it that begins lower, so a search never passes over the same candidate twice.
    """
    up = scores > 0
    if not up.any():
        return []
    begins = np.concatenate([[0], np.nonzero(up[1:] != up[:-1])[0] + 1])
    sums = np.add.reduceat(scores.astype(float), begins)
    ends = np.concatenate([begins[1:], [len(scores)]]) - 1
    after = np.cumsum(sums)
    stack: list[tuple[int, int, float, float, int]] = []
    for i in np.nonzero(up[begins])[0]:
        first, last = int(begins[i]), int(ends[i])
        low, high = float(after[i] - sums[i]), float(after[i])
        j = len(stack) - 1
        while True:
            # the nearest candidate that begins lower; those passed over stay as they are
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                break
            first, low, before = stack[j][0], stack[j][2], stack[j][4]
            del stack[j:]
            j = before
        stack.append((first, last, low, high, j))
    return [(first, last, high - low) for first, last, low, high, _ in stack]


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, toxic = text_bytes(batch.column("text")), batch.column("toxic").to_numpy()
        for lo, hi in slices(texts):
            words, n = split_all(texts[lo:hi], plain_words)
            slots, code = np.unique(token_slots(words), return_inverse=True)
            row = np.repeat(np.arange(hi - lo), n)
            # once for each document: a word repeated in one text is one observation
            once = np.unique(row << 32 | code)
            of, code = toxic[lo:hi][once >> 32] == 1, once & 0xFFFFFFFF
            counts = [np.bincount(code[of == label], minlength=len(slots)) for label in (True, False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots.astype(np.int32)), *[pa.array(c.astype(np.int64)) for c in counts]],
                names=["slot", "toxic", "clean"],
            )


def _scored(texts: list[bytes], weights: np.ndarray):
    """(number of tokens, maximal segments) of each text."""
    for lo, hi in slices(texts):
        words, n = split_all(texts[lo:hi], plain_words)
        score = weights[token_slots(words)] if words else np.zeros(0, np.float32)
        ends = np.cumsum(n)
        for end, count in zip(ends, n, strict=True):
            yield int(count), maximal_segments(score[end - count : end])


def _packed(scored: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Score and share of clean text of every slot, from ``slot, score, share`` of those with text."""
    width = (1 << SLOT_BITS) // BLOCKS

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            parts = [batch.column(c).to_numpy().astype(np.float32) for c in ("score", "share")]
            for block in np.unique(slot // width):
                own = slot // width == block
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(slot[own] % width).astype(np.int32).tobytes()]),
                        *[pa.array([p[own].tobytes()]) for p in parts], pa.array([int(block)], pa.int32()),
                    ],
                    names=["places", "score", "share", "block"],
                )

    weights = np.full(1 << SLOT_BITS, -DRIFT, np.float32)
    shares = np.zeros(1 << SLOT_BITS, np.float32)
    # one partition, so that a batch holds many slots of a block; 16 bytes for each of 2^20 slots at most
    rows = scored.repartitionByRange(1, "slot").sortWithinPartitions("slot").mapInArrow(
        pack, "places binary, score binary, share binary, block int"
    )
    for row in rows.toLocalIterator():
        at = row["block"] * width + np.frombuffer(row["places"], np.int32)
        weights[at] = np.frombuffer(row["score"], np.float32)
        shares[at] = np.frombuffer(row["share"], np.float32)
    return weights, shares


def _root(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive solution of sum(share * exp(x * scores)) = 1; 1 where there is none."""
    if not (scores > 0).any() or float(scores @ share) >= 0:
        return 1.0
    low, high = 1e-3, 1.0
    value = lambda x: float(share @ np.exp(np.minimum(x * scores, 700.0)))
    while value(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 1 else (low, middle)
    return min(max(low, 0.1), 10.0)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 0.1 * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def _features(best, n_tokens, n_segments, lam: float, k: float) -> np.ndarray:
    """Bias, -ln E of the best segment cut to a fixed range, significant segments (log)."""
    n = np.maximum(np.asarray(n_tokens, float), 1.0)
    evidence = np.clip(lam * np.asarray(best, float) - np.log(k * n), -10.0, 20.0)
    return np.column_stack([np.ones(len(n)), evidence, np.log1p(np.asarray(n_segments, float))])


def _probability(best, n_tokens, n_segments, model: Model) -> np.ndarray:
    x = _features(best, n_tokens, n_segments, model.lam, model.k)
    return 1 / (1 + np.exp(-np.clip(x @ np.array(model.coef), -30, 30)))


def binned(n: Column) -> Column:
    """Numbers above 64 within 5 % of their value, so that there are few of them; others as they are."""
    return F.when(n <= 64, n.cast("double")).otherwise(F.pow(F.lit(2.0), F.round(F.log2(n) * 8) / 8))


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``text`` and ``label`` of the labelled documents outside the held-out fold."""
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col(label).cast("int")).alias(label))
    )
    fit = keyed_text(docs).filter(~held_out(F.col("doc_id")))
    known = known.filter(~held_out(F.col("doc_id")))
    # labels grow with the corpus: never rely on broadcasting them
    return fit.join(known.hint("merge"), "doc_id").select("text", label)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn token scores, extreme-value constants and the logistic map (runs jobs).

    ``labels`` has ``doc_id`` and ``toxic`` (0/1; null rows are not used; of repeated rows
    the largest label counts). Without labels of both classes every score is neutral.
    """
    train = stored(training_rows(docs, labels, "toxic"), "toxic-train")
    counts = stored(
        train.mapInArrow(_slot_counts, _COUNTS)
        .groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "slot-counts",
    )
    n1, n0 = (n or 0 for n in counts.agg(F.sum("toxic"), F.sum("clean")).first())
    if not n1 or not n0:  # one class only: nothing to tell apart
        return Model(np.full(1 << SLOT_BITS, -DRIFT, np.float32), 1.0, 1.0, (0.0, 0.0, 0.0))
    weights, shares = _packed(
        counts.select("slot", log_odds(n1, n0).alias("score"), (F.col("clean") / n0).alias("share"))
    )
    release(counts)
    lam = _root(weights.astype(float), shares.astype(float))
    shared = train.sparkSession.sparkContext.broadcast(weights)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n, found in _scored(text_bytes(batch.column("text")), shared.value):
                rows.append((n, max((s for _, _, s in found), default=0.0), found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic").cast(pa.int32()),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([float(r[1]) for r in rows], pa.float64()),
                    pa.array([len(r[2]) for r in rows], pa.int32()),
                ],
                names=["toxic", "n_tokens", "best", "n_segments"],
            )

    # equal evidence meets in one row: best is binned, so the table has a bounded size
    seen = (
        train.mapInArrow(evidence, _EVIDENCE)
        .groupBy(
            "toxic",
            F.round("best", 1).alias("best"),
            F.round(F.log2(F.greatest("n_tokens", F.lit(1)))).alias("log_n"),
            binned(F.col("n_segments")).alias("n_segments"),
        )
        .count().toPandas()
    )
    if len(seen) == 0 or seen["toxic"].nunique() < 2:
        return Model(weights, lam, 1.0, (0.0, 0.0, 0.0))
    n_tokens = 2.0 ** seen["log_n"].to_numpy()
    best, many = seen["best"].to_numpy(), seen["count"].to_numpy(float)
    clean_rows = (seen["toxic"] == 0).to_numpy()
    # mean of the extreme-value law: (ln(K n) + 0.5772) / lambda
    mean = np.average((lam * best - np.log(n_tokens))[clean_rows], weights=many[clean_rows])
    k = float(np.clip(math.exp(mean - 0.5772), 1e-6, 1.0))
    x = _features(best, n_tokens, seen["n_segments"], lam, k)
    y = seen["toxic"].to_numpy(float)
    coef = _logistic(x, y, many)
    return Model(weights, lam, k, tuple(float(c) for c in coef))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score and significant segments of every document.

    One row per input row: ``doc_id, score, n_tokens, best, n_segments, segments`` with
    the token ranges (inclusive) of the significant segments. Empty and null texts have
    no segment and get the score of no evidence. Repeated rows are scored each. Other
    columns are not read.
    """
    # a plain tuple, so that workers can read it without this package
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            ns, bests, counts, kept = [], [], [], []
            for n, found in _scored(text_bytes(batch.column("text")), model.weights):
                floor = (math.log(model.k * max(n, 1)) - math.log(SIGNIFICANT_E)) / model.lam
                ns.append(n)
                bests.append(float(max((s for _, _, s in found), default=0.0)))
                counts.append(len(found))
                kept.append([
                    {"first": a, "last": b, "score": float(s)} for a, b, s in found if s >= floor
                ])
            p = _probability(bests, ns, counts, model)
            segment = pa.struct(
                [("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(p), pa.array(ns, pa.int64()),
                    pa.array(bests, pa.float64()), pa.array(counts, pa.int32()),
                    pa.array(kept, pa.list_(segment)),
                ],
                names=["doc_id", "score", "n_tokens", "best", "n_segments", "segments"],
            )

    return keyed_text(docs).mapInArrow(run, SCORES)


def without_toxic(
    docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, with a score below ``threshold``; no shuffle."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            found = list(_scored(text_bytes(batch.column(text_col)), model.weights))
            best = [max((s for _, _, s in f), default=0.0) for _, f in found]
            p = _probability(best, [n for n, _ in found], [len(f) for _, f in found], model)
            yield batch.filter(pa.array(p < threshold))

    return docs.mapInArrow(run, docs.schema)
