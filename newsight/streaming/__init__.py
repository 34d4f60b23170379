"""Incremental ingest."""

from newsight.streaming.collect import stream_collect

__all__ = ["stream_collect"]
