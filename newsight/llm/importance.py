"""Importance resampling towards a target distribution over hashed n-grams.

Features are runs of words, their bucket is crc32 modulo the number of buckets. CRC is linear
over XOR, so a feature's checksum is the XOR of one table entry per byte, chosen by the
byte and its distance from the feature's end, and a constant of the length. One gather and one
``bitwise_xor.reduceat`` over all spans of a slice of texts replace a call per feature. Spans
longer than the table fold block by block. Buckets are summed in each task before they meet;
only one row of sums per bucket reaches the driver. The draw adds a Gumbel value of the document's
id to its weight and keeps the highest scores.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.llm.common import bounded_batches, keyed_text, slices, split_all, stored, text_bytes
from newsight.operators.numbering import with_row_number

POSITIONS = 64  # bytes of a span that the position table covers at once
# a-z, 0-9 and all bytes of other scripts stay, A-Z become lower case, the rest are blanks
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


class PositionCrc:
    """crc32 of many spans of a buffer at once."""

    def __init__(self, positions: int = POSITIONS):
        self.positions = positions
        zeros = bytes(positions)
        # contribution of a byte that stands k bytes before the end: checksums of equal length
        # differ by the XOR of their bytes' contributions
        self.table = np.array([
            [zlib.crc32(bytes([b]) + zeros[:k]) ^ zlib.crc32(zeros[:k] + b"\0") for b in range(256)]
            for k in range(positions)
        ], np.uint32)
        self.constant = np.array([zlib.crc32(zeros[:n]) for n in range(positions + 1)], np.uint32)
        # appending a block of zero bytes to a checksum's linear part, for each byte of it
        shift = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        for _ in range(positions):
            shift = (shift >> np.uint32(8)) ^ self.table[0][shift & np.uint32(255)]
        self.append_block = shift.tolist()

    def short(self, buffer: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Spans in ascending order that do not overlap, of 1 to ``positions`` bytes each."""
        offsets = np.cumsum(lens) - lens
        within = np.arange(int(lens.sum())) - np.repeat(offsets, lens)
        from_end = np.repeat(lens, lens) - 1 - within
        values = self.table[from_end, buffer[np.repeat(starts, lens) + within]]
        return np.bitwise_xor.reduceat(values, offsets) ^ self.constant[lens]

    def long(self, span: np.ndarray) -> int:
        """A span of any length: blocks from its end, folded one after the other."""
        width = self.positions
        padded = np.zeros(-(-len(span) // width) * width, np.uint8)
        padded[len(padded) - len(span) :] = span  # leading zeros add nothing
        blocks = padded.reshape(-1, width)
        a, b, c, d = self.append_block
        linear = 0
        for at in range(0, len(blocks), 4096):
            part = blocks[at : at + 4096]
            own = np.bitwise_xor.reduce(self.table[np.arange(width)[::-1], part], axis=1)
            for value in own.tolist():
                linear = (
                    a[linear & 255] ^ b[linear >> 8 & 255] ^ c[linear >> 16 & 255] ^ d[linear >> 24] ^ value
                )
        return linear ^ zlib.crc32(bytes(len(span)))

    def spans(self, buffer: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """crc32 of each span; spans ascend and do not overlap."""
        out = np.empty(len(starts), np.uint32)
        fits = lens <= self.positions
        if fits.any():
            out[fits] = self.short(buffer, starts[fits], lens[fits])
        for i in np.flatnonzero(~fits):
            out[i] = self.long(buffer[starts[i] : starts[i] + lens[i]])
        return out


def hashed_features(texts: list[bytes], crc: PositionCrc, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Checksum and text of each run of 1 to ``longest`` words, and the number of words per text."""
    words, counts = split_all(texts, lambda t: t.translate(_WORD_BYTES).split())
    if not words:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), counts
    buffer = np.frombuffer(b" ".join(words), np.uint8)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lens + 1) - lens - 1
    ends = starts + lens
    owner = np.repeat(np.arange(len(texts)), counts)
    crcs, owners = [], []
    for n in range(1, longest + 1):
        first = np.arange(len(words) - n + 1)
        first = first[owner[first] == owner[first + n - 1]]
        for phase in range(n):  # runs of one phase do not overlap
            at = first[first % n == phase]
            if len(at):
                crcs.append(crc.spans(buffer, starts[at], ends[at + n - 1] - starts[at]))
                owners.append(owner[at])
    return np.concatenate(crcs), np.concatenate(owners), counts


def bucket_counts(docs: DataFrame, buckets: int = 10_000, longest: int = 2, text_col: str = "text") -> np.ndarray:
    """Features of all texts per bucket; each task sends one row per bucket it saw."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, total = PositionCrc(), np.zeros(buckets, np.int64)
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for a, b in slices(texts):
                found, _, _ = hashed_features(texts[a:b], crc, longest)
                total += np.bincount(found % np.uint32(buckets), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    summed = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in summed.collect():  # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of each bucket, every count plus one."""
    buckets = len(source)
    s_all, t_all = int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(((t + 1) * (s_all + buckets)) / ((s + 1) * (t_all + buckets))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ], np.int64)


def gumbel(seed: int, doc_id: int | None) -> int:
    """floor(1000 times a standard Gumbel value) that depends on seed and id only."""
    name = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(name).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def document_scores(
    docs: DataFrame, gains: np.ndarray, longest: int = 2, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` of each row."""
    own = keyed_text(docs, id_col, text_col)
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = PositionCrc()
        for batch in batches:
            texts, ids = text_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            words, features, sums = ([np.zeros(0, np.int64)] for _ in range(3))
            for a, b in slices(texts):
                found, owner, counts = hashed_features(texts[a:b], crc, longest)
                # sums of integers below 2^53 are exact
                gained = np.bincount(owner, gains[found % np.uint32(buckets)], minlength=b - a)
                words.append(counts)
                features.append(np.bincount(owner, minlength=b - a))
                sums.append(gained.astype(np.int64))
            words, features, sums = (np.concatenate(x).astype(np.int64) for x in (words, features, sums))
            weight = sums // np.maximum(features, 1)
            score = weight + np.array([gumbel(seed, i) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (words, features, weight, score))],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return own.mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long, score long"
    )


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20,
    buckets: int = 10_000, longest: int = 2, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` of each row.

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred with the highest
    scores are drawn and ranked from 1; ties go to the smaller id, a null id first, then to
    the smaller number of features. All other rows have a null rank. A null or empty text has no
    features and weight 0, and counts for nothing in the buckets; repeated rows are rows of
    their own with equal scores. Texts and words may be of any length. An empty
    ``target`` leaves all its counts at 0, an empty ``docs`` gives an empty result. Other columns
    play no part.
    """
    gains = bucket_gains(
        bucket_counts(docs, buckets, longest, text_col), bucket_counts(target, buckets, longest, text_col)
    )
    scored = stored(document_scores(docs, gains, longest, seed, id_col, text_col), "scores")
    can = F.col("n_words") >= least_words
    drawn = percent * scored.filter(can).count() // 100
    ordered = scored.withColumns({"_late": (~can).cast("int"), "_down": -F.col("score")})
    numbered = with_row_number(ordered, ["_late", "_down", "doc_id", "n_features"], name="rank")
    return numbered.drop("_late", "_down").withColumn(
        "rank", F.when(can & (F.col("rank") <= drawn), F.col("rank"))
    )
