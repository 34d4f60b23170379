"""Consecutive row numbers without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsight.session import materialise


def with_row_number(
    df: DataFrame,
    order_by: list[str],
    within: list[str] | None = None,
    name: str = "row_number",
) -> DataFrame:
    """Number rows 1.. in the order of ``order_by``, per ``within`` group if given.

    ``order_by`` must be unique (inside a group). One range shuffle spreads the
    rows, a hot group included, over all tasks; each row then needs only the
    number of rows in the ranges before its own. The range split is written once
    because a re-run of the sampling could move its bounds.
    """
    within = within or []
    keys = within + order_by
    ranged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    stored = materialise(ranged, "numbered")
    split = F.shiftright("_at", 33)
    # one row per task of the shuffle above
    sizes = stored.groupBy(split.alias("_split")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    numbered = (
        stored.withColumn("_split", split)
        .join(F.broadcast(offsets), "_split")
        .withColumn("_pos", position)
    )
    if within:
        starts = numbered.groupBy(*within).agg((F.min("_pos") - 1).alias("_start"))
        numbered = numbered.join(starts, within).withColumn("_pos", F.col("_pos") - F.col("_start"))
    return numbered.select(*df.columns, F.col("_pos").alias(name))
