"""The Spark side of both repeat finders: from texts to candidate contents and back.

1. Texts are cut into anchored segments where they are. Only hashes travel: anchors that
   stand in more than one place (counted with map-side sums) keep their segments.
2. Equal segments are one content. A content alone under its anchor needs no comparison.
   Of the others one copy of the text is fetched, so each distinct text meets an index once,
   however many documents repeat it.
3. Contents with one anchor go to one shard, whose index judges their windows. An anchor
   with more than ``HOT`` contents is not sent to a task: its windows travel as hashes of
   their own and are summed like any other key.
4. The judged windows go back to the segments and to their documents.

Joins of the long side are shuffled hash joins that adaptive execution can split; the other
side holds each key once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.llm.anchors import Hasher, Segments, segments
from newsight.llm.common import (
    free_shuffles, hash_words, keyed_text, release, slices, split_all, stored, text_bytes,
)

HOT = 20_000
SHARD_UNITS = 2_000_000  # units of content that a shard is sized for
LAST = (1 << 63) - 1  # documents without an id come after all others


class Plan(NamedTuple):
    by_words: bool
    width: int
    gram: int
    other_documents: bool  # a repeat counts only if it stands in documents of two ids


class Cut(NamedTuple):
    """Some texts as units, with their segments."""

    units: np.ndarray
    words: list[bytes] | None
    ends: np.ndarray
    found: Segments
    hasher: Hasher

    def content(self, i: int, plan: Plan) -> bytes:
        a, b = int(self.found.start[i]), int(self.found.stop[i]) + plan.width - 1
        return b" ".join(self.words[a:b]) if plan.by_words else self.units[a:b].tobytes()


def cut(texts: list[bytes], plan: Plan, hasher: Hasher) -> Cut:
    if plan.by_words:
        words, counts = split_all(texts, bytes.split)
        units = hash_words(words)
    else:
        words, counts = None, np.array([len(t) for t in texts], np.int64)
        units = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(counts)
    return Cut(units, words, ends, segments(units, ends, plan.width, plan.gram, hasher), hasher)


def ordinals(text: np.ndarray) -> np.ndarray:
    """Number of each segment inside its text."""
    first = np.searchsorted(text, text, "left")
    return (np.arange(len(text)) - first).astype(np.int32)


def rows_of(docs: DataFrame) -> DataFrame:
    """``key, d, doc_id, text``; equal rows share a key and have equal results."""
    return keyed_text(docs).select(
        F.xxhash64("doc_id", "text").alias("key"), F.coalesce("doc_id", F.lit(LAST)).alias("d"),
        "doc_id", "text",
    )


def segment_table(rows: DataFrame, plan: Plan) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            key, d = batch.column("key").to_numpy(), batch.column("d").to_numpy()
            for lo, hi in slices(texts):
                found = cut(texts[lo:hi], plan, hasher).found
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.anchor.view(np.int64)), pa.array(found.content.view(np.int64)),
                        pa.array(key[lo:hi][found.text]), pa.array(d[lo:hi][found.text]),
                        pa.array(ordinals(found.text)),
                    ],
                    names=["anchor", "content", "key", "d", "ordinal"],
                )

    return rows.select("key", "d", "text").mapInArrow(
        run, "anchor long, content long, key long, d long, ordinal int"
    )


def occurrences(rows: DataFrame, plan: Plan) -> DataFrame:
    """Segments whose anchor stands in more than one place (or document); runs jobs."""
    per_anchor = segment_table(rows, plan).groupBy("anchor")
    if plan.other_documents:
        repeated = per_anchor.agg(F.min("d").alias("a"), F.max("d").alias("b")).filter("a < b")
    else:
        repeated = per_anchor.agg(F.count("*").alias("n")).filter("n > 1")
    repeated = stored(repeated.select("anchor"), "anchors")
    free_shuffles(rows.sparkSession)
    occ = stored(
        segment_table(rows, plan).join(repeated.hint("shuffle_hash"), "anchor", "left_semi"),
        "occurrences",
    )
    release(repeated)
    free_shuffles(rows.sparkSession)
    return occ


def content_table(occ: DataFrame) -> DataFrame:
    """Distinct contents: smallest ``least`` and number ``n`` of places, contents of the anchor."""
    contents = stored(
        occ.groupBy("anchor", "content").agg(
            F.min("d").alias("least"), F.count("*").alias("n"),
            F.min(F.struct("key", "ordinal")).alias("rep"),
        ),
        "contents",
    )
    many = contents.groupBy("anchor").agg(F.count("*").alias("many"))
    return contents.join(many.hint("shuffle_hash"), "anchor")


def fetch_contents(rows: DataFrame, contents: DataFrame, plan: Plan) -> DataFrame:
    """One copy of the text of each content that shares its anchor with others.

    ``route, anchor, content, first, least, n, units``: the windows of hot anchors are rows of their
    own, with the window's hash as route and no text.
    """
    wanted = (
        contents.filter("many > 1")
        .groupBy(F.col("rep.key").alias("key"))
        .agg(F.collect_list(F.struct(
            F.col("rep.ordinal").alias("ordinal"), "anchor", "content", "least", "n",
            (F.col("many") > HOT).alias("hot"),
        )).alias("wanted"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            texts, lists = text_bytes(batch.column("text")), batch.column("wanted").to_pylist()
            for lo, hi in slices(texts):
                own = cut(texts[lo:hi], plan, hasher)
                at = np.searchsorted(own.found.text, np.arange(hi - lo), "left")
                out = []
                for i in range(hi - lo):
                    for w in lists[lo + i]:
                        k = int(at[i]) + w["ordinal"]
                        ids = (w["anchor"], w["content"])
                        if not w["hot"]:
                            out.append((w["anchor"], *ids, 0, w["least"], w["n"], own.content(k, plan)))
                            continue
                        starts = np.arange(own.found.start[k], own.found.stop[k])
                        for j, h in enumerate(own.hasher.ranges(starts, starts + plan.width).view(np.int64)):
                            out.append((int(h), *ids, j, w["least"], w["n"], None))
                cols = list(zip(*out, strict=True)) if out else [[]] * 7
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                    names=["route", "anchor", "content", "first", "least", "n", "units"],
                )

    return rows.select("key", "text").join(wanted.hint("shuffle_hash"), "key").mapInArrow(
        run, "route long, anchor long, content long, first int, least long, n long, units binary"
    )


Judge = Callable[[list[bytes], np.ndarray, np.ndarray], list[list[int]]]


def judged(routed: DataFrame, judge: Judge, hot_value: str, n_shards: int) -> DataFrame:
    """``anchor, content, first, verdict``: what the shard's index says of each content's windows.

    ``judge(contents, least, n)`` gets a part of a shard that holds anchors whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[bytes, int, int]] = {}
        size, last = 0, None

        def done() -> pa.RecordBatch:
            values = list(held.values())
            verdicts = judge(
                [v[0] for v in values], np.array([v[1] for v in values], np.int64),
                np.array([v[2] for v in values], np.int64),
            )
            keys = list(held)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([0] * len(keys), pa.int32()), pa.array(verdicts, pa.list_(pa.int64())),
                ],
                names=["anchor", "content", "first", "verdict"],
            )

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("anchor", "content", "units", "least", "n")]
            for anchor, content, units, least, n in zip(*cols, strict=True):
                if size >= SHARD_UNITS and anchor != last:
                    yield done()
                    held, size = {}, 0
                if (anchor, content) not in held:
                    held[anchor, content] = (units, least, n)
                    size += len(units)
                last = anchor
        if held:
            yield done()

    cold = (
        routed.filter("units IS NOT NULL")
        .repartition(n_shards, "anchor").sortWithinPartitions("anchor")
        .mapInArrow(run, "anchor long, content long, first int, verdict array<long>")
    )
    hot = routed.filter("units IS NULL").select("route", "anchor", "content", "first", "least", "n")
    sums = hot.groupBy("route").agg(F.expr(hot_value).alias("value"))
    return cold.unionByName(
        hot.select("route", "anchor", "content", "first").join(sums.hint("shuffle_hash"), "route")
        .select("anchor", "content", "first", F.array("value").alias("verdict"))
    )


def shard_count(routed: DataFrame) -> int:
    """Shards for the stored contents, each for about SHARD_UNITS bytes."""
    total = routed.agg(F.coalesce(F.sum(F.length("units")), F.lit(0))).first()[0]
    return int(total // SHARD_UNITS) + 8
