"""Typed result table: required columns, schema, append, run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.dates import as_of_literal
from newsight.operators.dedup import keep_first
from newsight.schemas import EXPORT_SCHEMA, REQUIRED_ENRICHMENTS


_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def require_columns(df: DataFrame, required: list[str] = REQUIRED_ENRICHMENTS) -> DataFrame:
    """Fail before any job runs if an enrichment is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df


def export_columns(df: DataFrame, as_of) -> DataFrame:
    """The export columns in order and type, with one timestamp for the run.

    Rows without a URL are not exportable; see ``export_rejects``.
    """
    require_columns(df)
    stamped = df.filter(F.col("url").isNotNull()).withColumn(
        "processed_timestamp", as_of_literal(as_of)
    )
    typed = stamped.select(
        F.coalesce("url", F.lit("")).alias("url"),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in EXPORT_SCHEMA.fields[1:]],
    )
    return typed.to(EXPORT_SCHEMA)


def to_export(df: DataFrame, as_of, order_by: str = "ord") -> DataFrame:
    """``export_columns`` with one row per URL, the first."""
    require_columns(df)
    return export_columns(keep_first(df, ["url"], [order_by]), as_of)


def export_rejects(df: DataFrame) -> DataFrame:
    return df.filter(F.col("url").isNull())


def only_new(export: DataFrame, target: DataFrame) -> DataFrame:
    """Rows whose URL the target does not hold yet, for a repeatable append."""
    return export.join(target.select("url"), "url", "left_anti").select(*export.columns)


def append_to_path(export: DataFrame, path: str) -> None:
    """Append to a Parquet table partitioned by run date."""
    (
        export.withColumn("run_date", F.to_date("processed_timestamp"))
        .write.mode("append")
        .partitionBy("run_date")
        .parquet(path)
    )


def _ensure_database(spark: SparkSession, database: str, location: str | None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def append_to_table(
    export: DataFrame, database: str, table: str, location: str | None = None
) -> None:
    """Append to a catalog table; database and table are created on first use.

    ``location`` is where a new database keeps its tables, the warehouse by default.
    """
    _ensure_database(export.sparkSession, database, location)
    export.write.mode("append").saveAsTable(f"`{database}`.`{table}`")


def publish_run(
    export: DataFrame, database: str, table: str, location: str | None = None
) -> None:
    """Append the rows of a run to a catalog table, or replace those of the same run.

    The table has one partition per run, named by ``processed_timestamp``; only partitions that
    occur in ``export`` are overwritten. A repeated or retried run therefore leaves the table as
    it was, and other runs are never touched. Database and table are created on first use.
    """
    spark = export.sparkSession
    _ensure_database(spark, database, location)
    named = export.withColumn("run", F.date_format("processed_timestamp", "yyyyMMdd'T'HHmmss"))
    target = f"`{database}`.`{table}`"
    if not spark.catalog.tableExists(f"{database}.{table}"):
        named.limit(0).write.partitionBy("run").saveAsTable(target)
    # by position, as an insert reads it; the partition column is the last one
    rows = named.select(*spark.table(target).columns)
    # an insert takes the mode from the session, not from the writer
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        rows.write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE, before)


def source_counts(articles: DataFrame, as_of, hours: int = settings.RECENCY_HOURS) -> DataFrame:
    """Entries per source and how many are recent, old or undated."""
    cut = as_of_literal(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0))
    return articles.groupBy("source").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("ts") >= cut).alias("recent"),
        F.count_if(F.col("ts") < cut).alias("old"),
        F.count_if(F.col("ts").isNull()).alias("undated"),
    )


def run_metrics(articles: DataFrame) -> DataFrame:
    """Totals of one run over the enriched rows before the flag filter, in one pass."""
    flag = F.col("Flag")
    return articles.agg(
        F.count("*").alias("articles"),
        F.count_if(F.col("relevance_score") >= settings.RELEVANT_COUNT_FLOOR).alias("relevant"),
        F.count_if(F.col("relevance_score") > settings.RELEVANCE_THRESHOLD).alias("over_threshold"),
        F.count_if(F.col("scrape_status") == "success").alias("scraped"),
        F.coalesce(F.max("cluster_id"), F.lit(0)).alias("clusters"),
        F.count_if(F.col("cluster_id") > 0).alias("clustered"),
        F.count_if(flag.isNotNull()).alias("analysed"),
        F.count_if(flag.isNull()).alias("failed"),
        F.count_if(flag == settings.DROPPED_FLAG).alias("dropped"),
        (F.count("url") - F.count_distinct("url")).alias("duplicate_urls"),
    )
