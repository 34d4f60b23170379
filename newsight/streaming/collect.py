"""Incremental collect: a file stream of feed payloads into an article table.

Two keyed states remember what was taken, one by canonical URL and one by title. A row passes
if its URL is new; of those, it passes if its title is new (a blank title always is). Of the
rows that arrive together the one with the smallest ``ord`` counts as the first. This is
the order of a stream: unlike the batch collect, a row that its title rejects has marked its URL.

A key is remembered until the watermark has passed the first row's time by the recency window; then
a timer forgets it, so the state holds the keys of two windows at most. The watermark is the time
of the newest row less the window. A row that is not newer than the watermark of the batch
before its own is late: it is dropped, and its keys are not marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from newsight import settings
from newsight.functions.text import is_blank, strip
from newsight.functions.url import canonical_url
from newsight.sources import scan_feeds

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOfKey(StatefulProcessor):
    """The first row of a key, once until its timer runs out.

    Rows of one key come as a stream of frames and only the best one is held, so a key with very
    many rows in one batch fills no memory.
    """

    def __init__(self, hours: int):
        self.hours = hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "until long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            return
        best = None
        for frame in rows:
            first = frame.nsmallest(1, "ord")
            if best is None or first["ord"].iloc[0] < best["ord"].iloc[0]:
                best = first
        until = int(best["ts"].iloc[0].timestamp() * 1000) + self.hours * 3_600_000
        self.seen.update((until,))
        self.handle.registerTimer(until)
        yield best

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def _first_of(rows: DataFrame, key: str, hours: int) -> DataFrame:
    return rows.groupBy(key).transformWithStateInPandas(
        FirstOfKey(hours), rows.schema, "Append", "EventTime", eventTimeColumnName="ts"
    )


def unique_articles(feeds: DataFrame, hours: int = settings.RECENCY_HOURS) -> DataFrame:
    """Dated entries of a stream of feed payloads, one per canonical URL and title."""
    # watermarks need an instant; the text dates are read as UTC
    timed = scan_feeds(feeds).filter("ts is not null").withColumn("ts", F.col("ts").cast("timestamp"))
    keyed = timed.withColumn("canonical_url", canonical_url(F.col("url")))
    # a row without a title conflicts by its URL only
    title = F.when(is_blank(F.col("title")), F.concat(F.lit("url "), "canonical_url")).otherwise(
        F.concat(F.lit("title "), strip(F.col("title")))
    )
    keyed = keyed.withColumn("title_key", title)
    by_url = _first_of(keyed.withWatermark("ts", f"{hours} hours"), "canonical_url", hours)
    return _first_of(by_url, "title_key", hours).drop("title_key")


def stream_collect(
    feeds: DataFrame, target: str, checkpoint: str, hours: int = settings.RECENCY_HOURS
) -> StreamingQuery:
    """Start an ingest of everything available, then stop.

    The Parquet sink commits each micro-batch once, so a restarted run neither
    loses nor repeats rows. Keyed state of this kind needs the RocksDB provider, which is
    set in the session unless another one was chosen.
    """
    spark = feeds.sparkSession
    if spark.conf.get(_PROVIDER).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKSDB)
    return (
        unique_articles(feeds, hours)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
