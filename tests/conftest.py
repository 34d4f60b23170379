import pytest

from checks.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def each(spark):
    """Evaluate a column function over a list of strings."""

    def run(values, fn):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(
            [(i, v) for i, v in enumerate(values)], "i int, v string"
        ).select("i", fn(F.col("v")).alias("r"))
        return [r.r for r in sorted(rows.collect(), key=lambda r: r.i)]

    return run
