"""Helpers shared by the corpus operators: stage tables, words, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsight.session import bounded_batches, free_shuffles, materialise  # noqa: F401
from newsight.session import discard as release  # noqa: F401  stage tables that nothing reads any more

# bytes of text handled at once inside a task; they bound its memory, not the result
SLICE_BYTES = 1_000_000
# share of labelled rows kept away from every fit: crc32 of the id, modulo and remainder
FOLDS, HELD_OUT_FOLD = 4, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table below the shared checkpoint folder and read it back (runs a job)."""
    return materialise(df, f"llm-{name}")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``: other columns, whatever their names, play no part.

    A null text is an empty text.
    """
    bounded_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer text is a range of its own."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit SipHash of each word."""
    if not words:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


# lower case, and blanks for ASCII characters that are neither letters nor digits
PLAIN = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def plain_words(text: bytes) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return text.translate(PLAIN).split()


def split_all(texts: list[bytes], split) -> tuple[list[bytes], np.ndarray]:
    """All words of some texts in one list, and the number of words of each text."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = split(text)
        counts[i] = len(own)
        words += own
    return words, counts


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (the published splitmix64 constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words that start at each place; the last n - 1 places have none."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(count, np.uint64)
    for j in range(n):
        h = mix((h << np.uint64(1) | h >> np.uint64(63)) ^ words[j : j + count])
    return h
