"""Stand-ins for hosted models: sparse text vectors and a closed-form label scorer.

Terms are hashed by MD5, weights come from aggregates, so every figure can be stated in plain
SQL. Texts are read once: each row's term counts are made and kept in the row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.session import bounded_batches, materialise

# hashed terms; also the bound of all tables that reach the driver or every worker
FEATURES = 1 << 18
_CACHED_WORDS = 100_000


def term_of(word: str, features: int = FEATURES) -> int:
    """First 32 bits of the word's MD5, modulo the number of features."""
    return int.from_bytes(hashlib.md5(word.encode()).digest()[:4], "big") % features


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def term_counts(
    docs: DataFrame, id_col: str, text_col: str, features: int = FEATURES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``(id, terms, counts)`` and the ``keep`` columns: hashed letters-only lower-case words.

    Counted in the row from the whole text; nothing is shuffled. Terms ascend. Batches are bounded
    in bytes, as a limit in records lets the words of long texts fill a worker.
    """
    bounded_batches(docs.sparkSession)
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(r"(\p{L}+)"), F.lit(1))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), *keep, words.alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            column = batch.column("words")
            distinct = column.flatten().dictionary_encode()
            if len(known) > _CACHED_WORDS:
                known.clear()
            names = distinct.dictionary.to_pylist()
            for word in names:
                if word not in known:
                    known[word] = term_of(word, features)
            hashed = np.array([known[w] for w in names], np.int64)
            owner = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            codes = distinct.indices.to_numpy()
            seen, n = np.unique(owner * features + (hashed[codes] if len(codes) else codes), return_counts=True)
            offsets = np.searchsorted(seen // features, np.arange(batch.num_rows + 1))
            made = [_lists(offsets, (seen % features).astype(np.int32)), _lists(offsets, n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("id", *keep)] + made, names=["id", *keep, "terms", "counts"]
            )

    kept = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    return rows.mapInArrow(run, f"id long{kept}, terms array<int>, counts array<int>")


def doc_vectors(
    docs: DataFrame, id_col: str, text_col: str, features: int = FEATURES
) -> DataFrame:
    """``(id_col, terms, weights)``: unit TF-IDF vectors of hashed terms over whole texts.

    idf is ln((n + 1) / (df + 1)) over all rows, an aggregate of at most ``features`` counters.
    A term that every text contains weighs nothing; a text of such terms only is empty.
    """
    counts = materialise(term_counts(docs, id_col, text_col, features), "term-counts")
    n = counts.count()
    idf = np.zeros(features)
    frequency = counts.select(F.explode("terms").alias("term")).groupBy("term").count()
    seen = frequency.toArrow()  # at most ``features`` rows
    idf[seen["term"].to_numpy()] = [math.log((n + 1) / (df + 1)) for df in seen["count"].to_pylist()]
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = batch.column("terms").flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), batch.column("terms").value_lengths().to_numpy())
            weight = batch.column("counts").flatten().to_numpy() * shared.value[terms]
            norm = np.sqrt(np.bincount(owner, weight * weight, minlength=batch.num_rows))
            used = weight > 0
            owner, terms, weight = owner[used], terms[used], weight[used]
            offsets = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), _lists(offsets, terms), _lists(offsets, weight / norm[owner])],
                names=[id_col, "terms", "weights"],
            )

    return counts.mapInArrow(weigh, f"`{id_col}` long, terms array<int>, weights array<double>")


@dataclass(frozen=True)
class LabelModel:
    """Log-likelihoods of each hashed term by class, and log priors.

    ``terms`` has one row per class of ``features`` columns.
    """

    classes: list
    priors: np.ndarray
    terms: np.ndarray

    @property
    def features(self) -> int:
        return self.terms.shape[1]


def train_label_model(
    rows: DataFrame, id_col: str, text_col: str, label_col: str, features: int = FEATURES
) -> LabelModel:
    """Naive Bayes on the terms' presence, in closed form from one table of counts.

    The sufficient statistics are rows per class and, per class and term, rows that hold the
    term, both summed map-side; at most classes x ``features`` counters reach the driver.
    Likelihoods are (with term + 1) / (rows + 2). Rows without a label take no part; labels may be of
    any type and number.
    """
    labelled = rows.filter(F.col(label_col).isNotNull())
    counts = materialise(
        term_counts(labelled.withColumn("_class", F.col(label_col)), id_col, text_col, features, ("_class",)),
        "label-counts",
    )
    sizes = {r["_class"]: r["count"] for r in counts.groupBy("_class").count().collect()}
    if not sizes:
        raise ValueError("no labelled rows")
    classes = sorted(sizes)
    held = np.zeros((len(classes), features))
    per_term = counts.select("_class", F.explode("terms").alias("term")).groupBy("_class", "term").count()
    seen = per_term.toArrow()
    place = {c: i for i, c in enumerate(classes)}
    held[[place[c] for c in seen["_class"].to_pylist()], seen["term"].to_numpy()] = seen["count"].to_numpy()
    size = np.array([sizes[c] for c in classes], np.float64)
    terms = np.log((held + 1) / (size[:, None] + 2))
    return LabelModel(classes, np.log(size / size.sum()), terms)


def score_label(
    model: LabelModel, rows: DataFrame, id_col: str, text_col: str, out_col: str, klass=1
) -> DataFrame:
    """``(id_col, out_col)``: the probability of one class for each row.

    Words of a text depend on each other, so their summed log-likelihoods are divided by the square
    root of the number of its distinct terms. A text without words gets the prior.
    """
    wanted = model.classes.index(klass)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            terms = batch.column("terms").flatten().to_numpy()
            size = batch.column("terms").value_lengths().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), size)
            scale = np.sqrt(np.maximum(size, 1))
            logs = np.array([
                prior + np.bincount(owner, per[terms], minlength=batch.num_rows) / scale
                for prior, per in zip(fitted.priors, fitted.terms, strict=True)
            ])
            share = np.exp(logs - logs.max(axis=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(share[wanted] / share.sum(axis=0))], names=[id_col, out_col]
            )

    counted = term_counts(rows, id_col, text_col, model.features)
    return counted.mapInArrow(score, f"`{id_col}` long, `{out_col}` double")
