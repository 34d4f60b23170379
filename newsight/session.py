"""Where iterative operators park intermediate tables.

Loops (dedup rounds, component contraction) and costly boundaries (vectors, cells)
are written as Parquet under the shared checkpoint folder and read back. A written
table survives the loss of any executor, cuts lineage, and is computed once.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# bytes sent to a Python worker at once; they bound its memory, not the result
BATCH_BYTES = 4_000_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables.

    Reads ``spark.checkpoint.dir``. Only a local master may run without it: on a
    cluster a driver-local temporary folder would be invisible to executors.
    """
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder every executor can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/newsight-{spark.sparkContext.applicationId}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="newsight-scratch-")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and return the stored copy."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Like ``materialise``, with the row count, which Parquet holds in its footers."""
    stored = materialise(df, name)
    return stored, stored.count()


def discard(*tables: DataFrame) -> None:
    """Delete stored intermediate tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        root = scratch_root(spark)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for file in df.inputFiles()[:1]:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
            if root.rstrip("/").split("/")[-1] in folder.toString():
                folder.getFileSystem(hadoop).delete(folder, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished stages now, not at its next collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's limit of bytes in an Arrow batch, unless it is lower already.

    The limit in records alone lets long texts fill a worker's memory.
    """
    limit = spark.conf.get(_BATCH_SETTING)
    if not limit.isdigit() or int(limit) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call after the last action."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
