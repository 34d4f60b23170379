"""Suffix-array dedup: a logarithmic family of suffix arrays in each shard.

Windows are routed to shards by content (``repeats``). A shard takes its contents in
batches. Each batch gets a suffix array; it is merge-scanned against every level of the
family, and equal neighbours of the merged order are long matches. Then the batch becomes a
level; levels of equal size class merge, so sizes grow geometrically and a suffix is merged a
logarithmic number of times.

Suffixes are sorted by their first ``REPEAT_BYTES`` bytes: prefix doubling for a batch. Two
sorted levels merge by the same doubling, each step of which is a linear merge of two runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.llm import repeats
from newsight.llm.anchors import Hasher
from newsight.llm.common import free_shuffles, release, slices, stored, text_bytes

REPEAT_BYTES, ANCHOR_BYTES = 400, 200
BATCH_BYTES = 2_000_000  # of contents in a batch of the family
_KEPT = "doc_id long, n_bytes long, removed array<struct<first:long,last:long>>, kept binary"


def _reaches(depth: int) -> list[int]:
    """Prefix lengths from 8 on: doubled, the last one overlapping to end at ``depth``."""
    out = [8]
    while out[-1] < depth:
        out.append(min(out[-1] * 2, depth))
    return out


def _first_keys(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that sorts like them."""
    x = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] << np.uint64(8 * step) | x[step:]
    return x[: len(text)]


def _ranked(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    ordered = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    return rank


def _sorted_by(text: np.ndarray, depth: int, runs: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of all suffixes by their first ``depth`` bytes.

    ``runs`` is an arrangement of the places in two sorted runs; a stable sort then merges
    them in linear time at each step.
    """
    key, done = _first_keys(text), 8
    for reach in [*_reaches(depth)[1:], None]:
        if runs is None:
            order = np.argsort(key)
        else:
            order = runs[np.argsort(key[runs], kind="stable")]
        rank = _ranked(key, order)
        if reach is None:
            return order, rank
        step = reach - done
        ahead = np.zeros(len(rank), np.int64)
        if step < len(rank):
            ahead[:-step] = rank[step:] + 1
        key, done = rank * (len(rank) + 1) + ahead, reach
    raise AssertionError


class Level:
    """Some contents as one text, its suffixes in order, and which windows have a match."""

    def __init__(self, text: np.ndarray, order: np.ndarray, window: np.ndarray):
        self.text, self.order, self.window = text, order, window

    @classmethod
    def build(cls, contents: list[bytes], depth: int) -> tuple[Level, np.ndarray]:
        """A level of new contents, and which places start a window that occurs twice in it.

        Only places with ``depth`` bytes before the end of their content start a window.
        """
        text = np.frombuffer(b"".join(contents), np.uint8)
        window = np.zeros(len(text), bool)
        at = 0
        for c in contents:
            window[at : at + max(0, len(c) - depth + 1)] = True
            at += len(c)
        order, rank = _sorted_by(text, depth, None)
        return cls(text, order, window), _matched(order, rank, window)

    def merged(self, other: Level, depth: int) -> tuple[Level, np.ndarray]:
        """One level of both, and the places with a match in it."""
        text = np.concatenate([self.text, other.text])
        runs = np.concatenate([self.order, other.order + len(self.text)])
        order, rank = _sorted_by(text, depth, runs)
        window = np.concatenate([self.window, other.window])
        return Level(text, order, window), _matched(order, rank, window)


def _matched(order: np.ndarray, rank: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Windows with an equal neighbour among the windows in suffix order."""
    own = order[window[order]]
    equal = rank[own][1:] == rank[own][:-1]
    out = np.zeros(len(window), bool)
    out[own[1:][equal]] = True
    out[own[:-1][equal]] = True
    return out


class LevelFamily:
    """Levels of at most one per size class; ``matched`` marks windows that occur twice."""

    def __init__(self, depth: int = REPEAT_BYTES):
        self.depth = depth
        self.levels: list[tuple[Level, np.ndarray]] = []  # with each place in the whole text
        self.matched = np.zeros(0, bool)

    def add(self, contents: list[bytes]) -> None:
        if not any(contents):
            return
        level, found = Level.build(contents, self.depth)
        places = np.arange(len(level.text)) + len(self.matched)
        self.matched = np.concatenate([self.matched, found])
        kept = []
        for old, old_places in reversed(self.levels):  # the smallest first
            together, found = old.merged(level, self.depth)
            every = np.concatenate([old_places, places])
            self.matched[every[found]] = True
            if len(old.text).bit_length() > len(level.text).bit_length():
                kept.append((old, old_places))  # a larger level: only scanned
            else:
                level, places = together, every
        self.levels = [*reversed(kept), (level, places)]


def judge_windows(contents: list[bytes], least: np.ndarray, n: np.ndarray) -> list[list[int]]:
    """Runs of windows of each content that occur elsewhere, as first and last in turn."""
    family, batch, held = LevelFamily(), [], 0
    for c in contents:
        batch.append(c)
        held += len(c)
        if held >= BATCH_BYTES:
            family.add(batch)
            batch, held = [], 0
    family.add(batch)
    out, at = [], 0
    for c, many in zip(contents, n, strict=True):
        windows = len(c) - REPEAT_BYTES + 1
        if many > 1:  # the whole content stands in several places
            out.append([0, windows - 1])
        else:
            first, last = _runs(family.matched[at : at + windows])
            out.append(np.column_stack([first, last]).ravel())
        at += len(c)
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.nonzero(step == 1)[0], np.nonzero(step == -1)[0] - 1


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, removed, kept`` of every input row (runs jobs).

    A byte goes if a string of ``REPEAT_BYTES`` bytes over it also starts anywhere else, in
    another document, a repeated row or the same text. ``removed`` are the maximal runs of
    removed bytes (both ends inclusive), ``kept`` the other bytes; a cut may fall inside a
    character. Null and empty texts have no bytes. Other columns are not read.
    """
    plan = repeats.Plan(False, REPEAT_BYTES, ANCHOR_BYTES, other_documents=False)
    spark = docs.sparkSession
    rows = repeats.rows_of(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    occ = repeats.occurrences(rows, plan)
    contents = stored(repeats.content_table(occ), "contents-many")
    free_shuffles(spark)
    routed = stored(repeats.fetch_contents(rows, contents, plan), "routed")
    free_shuffles(spark)
    # a hot window's own row: it occurs elsewhere if its places sum to more than one
    value = "if(sum(n) > 1, 1L, 0L)"
    judged = repeats.judged(routed, judge_windows, value, repeats.shard_count(routed))
    verdicts = stored(judged, "verdicts")
    release(routed)
    free_shuffles(spark)
    alone = contents.filter("many = 1 AND n > 1").select(
        "anchor", "content", F.lit(-1).alias("first"), F.array().cast("array<long>").alias("verdict")
    )
    every = verdicts.filter("size(verdict) > 0").unionByName(alone)
    hot = contents.filter(F.col("many") > repeats.HOT).select("anchor", "content", F.lit(True).alias("hot"))
    marks = stored(
        occ.join(every.hint("shuffle_hash"), ["anchor", "content"])
        .join(hot.hint("shuffle_hash"), ["anchor", "content"], "left")
        # a hot window's verdict is 0 or 1; it becomes a run of one window or none
        .withColumn("runs", F.when(F.col("hot"), F.when(
            F.get("verdict", F.lit(0)) == 1, F.array("first", "first").cast("array<long>")
        )).otherwise(F.col("verdict")))
        .filter("runs IS NOT NULL")
        .select("key", F.struct("ordinal", F.when(F.col("first") < 0, True).otherwise(False).alias("all"), "runs").alias("m"))
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
                        pairs = [0, b - a - 1] if m["all"] else m["runs"]
                        for first, last in zip(pairs[::2], pairs[1::2], strict=True):
                            step[a + first] += 1
                            step[a + last + plan.width] -= 1
                gone = np.cumsum(step[:-1]) > 0
                n, runs, kept, begin = [], [], [], 0
                for end in own.ends:
                    g = gone[begin:end]
                    first, last = _runs(g)
                    n.append(int(end - begin))
                    runs.append([{"first": int(p), "last": int(q)} for p, q in zip(first, last, strict=True)])
                    kept.append(own.units[begin:end][~g].tobytes())
                    begin = int(end)
                span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(runs, pa.list_(span)),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "removed", "kept"],
                )

    return rows.select("key", "doc_id", "text").join(
        marks.hint("shuffle_hash"), "key", "left"
    ).mapInArrow(run, _KEPT)
