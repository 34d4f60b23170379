"""Row filters. All are plain predicates, so Catalyst can push them to the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.dates import as_of_literal
from newsight.functions.text import is_blank


def recent(
    df: DataFrame,
    as_of,
    hours: int = settings.RECENCY_HOURS,
    ts_col: str = "ts",
    keep_undated: bool = False,
) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of``; undated rows by policy."""
    return df.filter(is_recent(as_of, hours, ts_col, keep_undated))


def is_recent(
    as_of, hours: int = settings.RECENCY_HOURS, ts_col: str = "ts", keep_undated: bool = False
) -> Column:
    cut = as_of_literal(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0))
    ts = F.col(ts_col)
    keep = ts >= cut
    return keep | ts.isNull() if keep_undated else keep


def above_threshold(
    df: DataFrame,
    score_col: str = "relevance_score",
    threshold: float = settings.RELEVANCE_THRESHOLD,
) -> DataFrame:
    return df.filter(F.col(score_col) > threshold)


def has_content(content: str = "scraped_content", title: str | None = "title") -> Column:
    """Content (and title) is neither null nor blank."""
    ok = ~is_blank(F.col(content))
    return ok & ~is_blank(F.col(title)) if title else ok


def unflagged(df: DataFrame, flag_col: str = "Flag") -> DataFrame:
    """Drop rows flagged for removal; rows without a flag stay."""
    return df.filter(~F.col(flag_col).eqNullSafe(settings.DROPPED_FLAG))


def flag_audit(df: DataFrame, flag_col: str = "Flag") -> DataFrame:
    """What the flag filter drops, and what has no flag because analysis failed."""
    flag = F.col(flag_col)
    return df.filter(flag.isNull() | (flag == settings.DROPPED_FLAG)).select(
        F.when(flag.isNull(), F.lit("failed")).otherwise(F.lit("dropped")).alias("outcome"),
        F.substring("source", 1, settings.AUDIT_SOURCE_CHARS).alias("source"),
        F.substring("title", 1, settings.AUDIT_TITLE_CHARS).alias("title"),
        F.substring("summary", 1, settings.AUDIT_SUMMARY_CHARS).alias("summary"),
    )
