"""Bloom filter of a key column (one hash), to thin out wide rows where they are read.

The bits stand in a table of at most ``bits / 64`` words (4 MB at the default), whatever the number of
keys, so it may be broadcast. Rows that pass are few more than those with a wanted key; the join
behind the filter decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24  # under 12 % of other keys pass with up to two million keys in the filter


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(bits))


def bloom_words(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """``(word, mask)`` of the bits of all keys, combined map-side."""
    places = keys.select(_place(key, bits).alias("at"))
    return places.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("mask")
    )


def maybe_in(rows: DataFrame, key: str, words: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows whose key may be in the filter; a null key is in none. Nothing is shuffled."""
    held = words.select(F.col("word").alias("_word"), F.col("mask").alias("_mask"))
    placed = rows.filter(F.col(key).isNotNull()).withColumn("_at", _place(key, bits))
    met = placed.join(F.broadcast(held), F.shiftright("_at", 6) == F.col("_word"))
    return met.filter("shiftright(_mask, cast(_at & 63 as int)) & 1 = 1").select(*rows.columns)
