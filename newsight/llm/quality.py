"""Quality: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages. Each passage is encoded by the shares of its character
classes, its word lengths and its repeated words; a hidden layer embeds it; gated attention
(Ilse, Tomczak, Welling 2018), learned from document labels alone, weighs the passages; the
weighted mean embedding gives the score. Whole texts are read: a text of more than
``MAX_PASSAGES`` passages gets longer passages, not fewer words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.llm.common import hash_words, held_out, keyed_text, slices, text_bytes

PASSAGE_WORDS = 64
MAX_PASSAGES = 256
# bound of the labelled rows that the model is fitted on; chosen by a hash of the id
FIT_ROWS = 8_000
HIDDEN, ATTENTION = 16, 8
EPOCHS, BATCH, RATE, DECAY = 30, 128, 0.01, 1e-4

_CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"\n", b"!?",
    b"#$%&*", b"|", b".,;:", b"\"'()[]{}<>", b"@/\\_=+-~^`", bytes(range(128, 256)),
]
N_FEATURES = len(_CLASSES) + 5
_MASKS = np.array([[c in group for c in range(256)] for group in _CLASSES])
_BLANK = np.array([c in b" \t\n\r\v\f" for c in range(256)])
_BAGS = "doc_id long, label int, passages array<float>"
SCORES = "doc_id long, score double, n_passages int, top_passage int, top_weight double"


def encode(text: bytes) -> np.ndarray:
    """One row of features for each passage; an empty text is one passage of zeros."""
    data = np.frombuffer(text, np.uint8)
    blank = _BLANK[data]
    begin = np.nonzero(~blank & np.concatenate([[True], blank[:-1]]))[0] if len(data) else data
    n_words = len(begin)
    if not n_words:
        return np.zeros((1, N_FEATURES), np.float32)
    size = max(PASSAGE_WORDS, -(-n_words // MAX_PASSAGES))
    heads = np.arange(0, n_words, size)
    at = begin[heads].copy()
    at[0] = 0
    length = np.diff(np.append(at, len(data))).astype(np.float64)
    out = np.empty((len(heads), N_FEATURES))
    for j, mask in enumerate(_MASKS):
        out[:, j] = np.add.reduceat(mask[data], at, dtype=np.int64) / length
    words = hash_words(text.split())
    count = np.diff(np.append(heads, n_words))
    passage = np.repeat(np.arange(len(heads), dtype=np.uint64), count)
    key = np.unique((words & np.uint64(~0xFFFF & (2**64 - 1))) | passage)
    distinct = np.bincount((key & np.uint64(0xFFFF)).astype(np.int64), minlength=len(heads))
    k = len(_CLASSES)
    out[:, k] = distinct / count
    out[:, k + 1] = np.log1p(length / count)
    out[:, k + 2] = np.log1p(count)
    out[:, k + 3] = len(np.unique(words)) / n_words  # repeats across passages
    out[:, k + 4] = np.log1p(n_words)
    return out.astype(np.float32)


def init_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def draw(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    return {
        "w": draw(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN),
        "v": draw(HIDDEN, ATTENTION), "u": draw(HIDDEN, ATTENTION), "a": draw(ATTENTION),
        "c": draw(HIDDEN), "d": np.zeros(1),
    }


def forward(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray):
    """Scores of bags whose passages stand in ``x`` from each start on, and what backward needs."""
    counts = np.diff(np.append(starts, len(x)))
    bag = np.repeat(np.arange(len(starts)), counts)
    h = np.tanh(x @ p["w"] + p["b"])
    t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
    e = (t * g) @ p["a"]
    e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
    weight = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(weight[:, None] * h, starts)
    score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
    return score, (h, t, g, weight, z, bag)


def gradients(p, x, starts, y):
    """Gradient of the mean cross-entropy by every weight."""
    score, (h, t, g, weight, z, bag) = forward(p, x, starts)
    d_out = (score - y) / len(y)
    d_z = d_out[:, None] * p["c"]
    d_weight = (d_z[bag] * h).sum(1)
    d_e = weight * (d_weight - np.add.reduceat(weight * d_weight, starts)[bag])
    d_tg = d_e[:, None] * p["a"]
    d_t, d_g = d_tg * g * (1 - t**2), d_tg * t * g * (1 - g)
    d_h = weight[:, None] * d_z[bag] + d_t @ p["v"].T + d_g @ p["u"].T
    d_pre = d_h * (1 - h**2)
    return {
        "w": x.T @ d_pre, "b": d_pre.sum(0), "v": h.T @ d_t, "u": h.T @ d_g,
        "a": (t * g).T @ d_e, "c": z.T @ d_out, "d": d_out.sum(keepdims=True),
    }


def train(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam over shuffled batches of bags; one seed gives one model."""
    rng = np.random.default_rng(seed)
    p = init_weights(rng)
    if not bags:
        return p | {"mean": np.zeros(N_FEATURES), "std": np.ones(N_FEATURES)}
    every = np.concatenate(bags).astype(np.float64)
    mean, std = every.mean(0), every.std(0) + 1e-3
    bags = [(b - mean) / std for b in bags]
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), BATCH):
            chosen = order[lo : lo + BATCH]
            own = [bags[i] for i in chosen]
            starts = np.cumsum([0] + [len(b) for b in own[:-1]])
            grad = gradients(p, np.concatenate(own), starts, labels[chosen])
            step += 1
            for k in p:
                d = grad[k] + DECAY * p[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                p[k] = p[k] - RATE * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                )
    return p | {"mean": mean, "std": std}


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> dict[str, np.ndarray]:
    """Fit on at most ``fit_rows`` labelled documents outside the held-out fold (runs a job).

    ``labels`` has ``doc_id`` and ``quality`` (0/1; null rows are not used, of repeated
    rows the smallest label counts). Only the passages of those documents, at most
    ``MAX_PASSAGES`` rows of ``N_FEATURES`` numbers each, reach the driver.
    """
    known = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("label"))
        .filter(~held_out(F.col("doc_id")))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("label").cast(pa.int32()),
                    pa.array([encode(t).ravel() for t in texts], pa.list_(pa.float32())),
                ],
                names=["doc_id", "label", "passages"],
            )

    # fit_rows bounds the broadcast side
    rows = (
        keyed_text(docs).join(F.broadcast(chosen), "doc_id")
        .mapInArrow(encoded, _BAGS).toPandas().sort_values("doc_id", kind="stable")
    )
    bags = [np.asarray(b, np.float32).reshape(-1, N_FEATURES) for b in rows["passages"]]
    return train(bags, rows["label"].to_numpy(float))


def score(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """Score of every document and the passage with the largest attention weight.

    One row per input row: ``doc_id, score, n_passages, top_passage, top_weight``. Empty
    and null texts are one passage of zeros. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            score, n, top, most = [], [], [], []
            for lo, hi in slices(texts):
                bags = [encode(t) for t in texts[lo:hi]]
                starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
                x = (np.concatenate(bags) - p["mean"]) / p["std"]
                s, (_, _, _, weight, _, _) = forward(p, x, starts)
                score += list(s)
                for at, own in zip(starts, bags, strict=True):
                    w = weight[at : at + len(own)]
                    n.append(len(own))
                    top.append(int(w.argmax()))
                    most.append(float(w.max()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(score, pa.float64()),
                    pa.array(n, pa.int32()), pa.array(top, pa.int32()),
                    pa.array(most, pa.float64()),
                ],
                names=["doc_id", "score", "n_passages", "top_passage", "top_weight"],
            )

    return keyed_text(docs).mapInArrow(run, SCORES)
