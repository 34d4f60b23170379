"""Evaluate a sub-expression once and use it several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Inside lambdas Spark does not share common sub-expressions.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
