"""Rounding that agrees with correctly rounded decimal rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**27 + 1: splits a double into two halves whose products are exact
_SPLITTER = 134217729.0


def round2(x: Column) -> Column:
    """Round a double to two digits by its exact binary value, ties to even.

    ``round`` and ``bround`` decide ties on the shortest decimal text, so they
    treat 0.005 (stored slightly above) as a tie. Here the sign of the exact
    rounding error of ``x * 200`` decides (Dekker's product).
    """
    x = x.cast("double")
    product = x * 200.0
    big = x * _SPLITTER
    high = big - (big - x)
    error = (high * 200.0 - product) + (x - high) * 200.0
    looks_tied = (product % 2.0 == 1.0) | (product % 2.0 == -1.0)
    hundredths = (
        F.when(looks_tied & (error > 0), (product + 1.0) / 2.0)
        .when(looks_tied & (error < 0), (product - 1.0) / 2.0)
        .otherwise(F.rint(product / 2.0))
    )
    return hundredths / 100.0
