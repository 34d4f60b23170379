import pytest

SF = "/root/testdata/sf0.001"
# names that operators use inside
CLASHING = ["key", "d", "node", "family", "anchor", "content", "part", "bin", "score", "spans", "_row", "lane", "suffix"]


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    return {r["doc_id"]: r["text"] for r in rows}


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty and blank texts, repeated rows, a long text, clashing columns."""
    passage = " ".join(f"w{i}" for i in range(160))
    rows = [
        (1, passage), (1, passage), (2, passage), (3, None), (4, ""), (5, " \t\n "), (None, passage),
        (None, None), (6, "one"), (7, "one"), (8, "ONE"), (9, " ".join(f"v{i % 9000}" for i in range(30_000))),
        (10, "äöü €uro 漢字 " * 40), (11, f"before {passage} after"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    for i, name in enumerate(CLASHING):
        from pyspark.sql import functions as F

        frame = frame.withColumn(name, F.lit(f"x{i}"))
    return frame


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, key string")
