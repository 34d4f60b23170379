"""Substring dedup: a compressed FM-index per shard, searched backwards.

Windows are routed to shards by content (``repeats``). A shard writes its contents as one
sequence of word numbers, sorts its suffixes as far as patterns reach, and keeps the
Burrows-Wheeler transform in a wavelet matrix: bit vectors with counts for each 64 bits.
The shard's own contents are streamed against it: a backward search gives the interval of
suffixes that start with each window, and the smallest document in the interval decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.llm import repeats
from newsight.llm.anchors import Hasher
from newsight.llm.common import free_shuffles, hash_words, release, slices, stored, text_bytes

WINDOW_WORDS, ANCHOR_WORDS = 13, 5
SPANS = "array<struct<first:int,last:int>>"
_KEPT = f"doc_id long, n_words long, n_removed long, removed {SPANS}, kept_text string"


class Bits:
    """A bit vector with constant-time rank: 64-bit words and counts before each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.concatenate([bits, np.zeros(-n % 64 + 64, bool)]), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before place ``i``."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Backward search over sequences of symbols 1.. with 0 between them."""

    def __init__(self, symbols: np.ndarray, reach: int):
        self.n = len(symbols)
        self.order = suffix_order(symbols, reach)
        last = symbols[self.order - 1]  # the symbol before each suffix
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=1 << self.levels))])
        self.bits, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (last >> level & 1).astype(bool)
            self.bits.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            last = np.concatenate([last[~bit], last[bit]])
        every = np.arange(1 << self.levels)
        self.base = self._place(every, np.zeros(len(every), np.int64))

    def _place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, level in enumerate(reversed(range(self.levels))):
            ones = self.bits[k].ones(i)
            i = np.where(symbol >> level & 1, self.zeros[k] + ones, i - ones)
        return i

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of the patterns with ``symbol`` put in front."""
        base, at = self.base[symbol], self.starts[symbol]
        return at + self._place(symbol, low) - base, at + self._place(symbol, high) - base

    def intervals(self, text: np.ndarray, starts: np.ndarray, width: int):
        """Suffixes that begin with the ``width`` symbols from each start of ``text`` on."""
        symbol = text[starts + width - 1]
        low, high = self.starts[symbol], self.starts[symbol + 1]
        for k in range(width - 2, -1, -1):
            low, high = self.extend(text[starts + k], low, high)
        return low, high

    def matching_statistics(self, text: np.ndarray, most: int) -> np.ndarray:
        """For each place, the longest run that ends there and stands in the index, up to ``most``."""
        low, high = np.zeros(len(text), np.int64), np.full(len(text), self.n, np.int64)
        length = np.zeros(len(text), np.int64)
        live = np.arange(len(text))
        for k in range(most):
            live = live[live - k >= 0]
            a, b = self.extend(text[live - k], low[live], high[live])
            live = live[b > a]
            low[live], high[live] = a[b > a], b[b > a]
            length[live] += 1
        return length


def suffix_order(symbols: np.ndarray, reach: int) -> np.ndarray:
    """Suffixes sorted by at least their first ``reach`` symbols, by prefix doubling.

    Backward search needs no order beyond the longest pattern.
    """
    rank, done = symbols.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while done < reach:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-done] = rank[done:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + ahead
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        done *= 2
    return order


def judge_windows(contents: list[bytes], least: np.ndarray, n: np.ndarray) -> list[list[int]]:
    """Smallest document that holds each window, for the windows of each content."""
    width = WINDOW_WORDS
    words, size = [], []
    for text in contents:
        own = text.split()
        words += own
        size.append(len(own))
    size = np.array(size, np.int64)
    ids = np.unique(hash_words(words), return_inverse=True)[1] + 1
    # one separator after each content
    first = np.concatenate([[0], np.cumsum(size + 1)])
    symbols = np.zeros(int(first[-1]), np.int64)
    owner = np.repeat(np.arange(len(size)), size)
    symbols[np.arange(len(ids)) + owner] = ids
    index = FMIndex(symbols, width)
    windows = size - width + 1
    starts = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(windows[:-1])]), windows) + np.arange(windows.sum())
    low, high = index.intervals(symbols, starts, width)
    holder = np.searchsorted(first, index.order, "right") - 1
    value = np.append(least[holder], repeats.LAST)
    # intervals of patterns of one length are equal or apart
    at, which = np.unique(low, return_inverse=True)
    end = np.zeros(len(at), np.int64)
    end[which] = high
    lowest = np.minimum.reduceat(value, np.column_stack([at, end]).ravel())[::2]
    return np.split(lowest[which], np.cumsum(windows)[:-1])


def _removed(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of set values."""
    step = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return np.nonzero(step == 1)[0], np.nonzero(step == -1)[0] - 1


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, removed, kept_text`` of every input row (runs jobs).

    A word goes if a window of ``WINDOW_WORDS`` consecutive words over it also starts in a
    document with a smaller doc_id. ``removed`` are the runs of removed words (both ends
    inclusive), ``kept_text`` the other words joined by blanks. Null and empty texts have no
    words. Rows with equal ids do not remove from each other; rows without an id come
    after all others. Other columns are not read.
    """
    plan = repeats.Plan(True, WINDOW_WORDS, ANCHOR_WORDS, other_documents=True)
    spark = docs.sparkSession
    rows = repeats.rows_of(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    occ = repeats.occurrences(rows, plan)
    contents = stored(repeats.content_table(occ), "contents-many")
    free_shuffles(spark)
    routed = stored(repeats.fetch_contents(rows, contents, plan), "routed")
    free_shuffles(spark)
    verdicts = stored(
        repeats.judged(routed, judge_windows, "min(least)", repeats.shard_count(routed)), "verdicts"
    )
    release(routed)
    free_shuffles(spark)
    alone = contents.filter("many = 1").select(
        "anchor", "content", F.lit(-1).alias("first"), F.array("least").alias("verdict")
    )
    every = verdicts.unionByName(alone)
    # bit i: window ``first + i`` also starts in a smaller document; first -1: all windows
    mask = F.aggregate(
        F.transform("verdict", lambda v, i: F.when(v < F.col("d"), F.call_function("shiftleft", F.lit(1), i)).otherwise(0)),
        F.lit(0), lambda a, b: a.bitwiseOR(b),
    )
    marks = stored(
        occ.join(every.hint("shuffle_hash"), ["anchor", "content"])
        .select("key", F.struct("ordinal", "first", mask.alias("mask")).alias("m")).filter("m.mask <> 0")
        .groupBy("key").agg(F.collect_set("m").alias("marks")),
        "marks",
    )
    release(occ, contents, verdicts)
    free_shuffles(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            texts, marks = text_bytes(batch.column("text")), batch.column("marks").to_pylist()
            ids = batch.column("doc_id")
            for lo, hi in slices(texts):
                own = repeats.cut(texts[lo:hi], plan, hasher)
                at = np.searchsorted(own.found.text, np.arange(hi - lo), "left")
                step = np.zeros(len(own.units) + 1, np.int32)
                for i in range(hi - lo):
                    for m in marks[lo + i] or ():
                        k = int(at[i]) + m["ordinal"]
                        a, b = int(own.found.start[k]), int(own.found.stop[k])
                        if m["first"] < 0:
                            step[a] += 1
                            step[b + plan.width - 1] -= 1
                            continue
                        mask, w = m["mask"], a + m["first"]
                        while mask:
                            if mask & 1:
                                step[w] += 1
                                step[w + plan.width] -= 1
                            mask, w = mask >> 1, w + 1
                gone = np.cumsum(step[:-1]) > 0
                n, n_gone, runs, kept = [], [], [], []
                begin = 0
                for end in own.ends:
                    g = gone[begin:end]
                    first, last = _removed(g)
                    n.append(int(end - begin))
                    n_gone.append(int(g.sum()))
                    runs.append([{"first": int(p), "last": int(q)} for p, q in zip(first, last, strict=True)])
                    words = own.words[begin:end]
                    if len(first):
                        words = [w for w, out in zip(words, g, strict=True) if not out]
                    kept.append(b" ".join(words))
                    begin = int(end)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(n_gone, pa.int64()),
                        pa.array(runs, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "removed", "kept_text"],
                )

    return rows.select("key", "doc_id", "text").join(marks.hint("shuffle_hash"), "key", "left").mapInArrow(run, _KEPT)
