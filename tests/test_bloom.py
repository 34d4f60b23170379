"""The Bloom filter and the plan of the page join."""

import pytest
from pyspark.sql import functions as F

from newsight.operators import bloom, content


@pytest.mark.parametrize("bits", [64, 1 << 10, bloom.BITS])
def test_no_key_is_lost_and_others_mostly_go(spark, bits):
    rows = spark.range(5_000).select(F.concat(F.lit("u"), "id").alias("k"), F.lit("x").alias("word"))
    wanted = rows.filter("crc32(k) % 97 = 0").select("k")
    n = wanted.count()
    words = bloom.bloom_words(wanted, "k", bits)
    assert words.count() <= bits // 64
    passed = bloom.maybe_in(rows, "k", words, bits)
    assert passed.columns == rows.columns
    assert passed.join(wanted, "k", "left_semi").count() == n
    assert passed.count() == passed.distinct().count()
    if bits == bloom.BITS:
        assert passed.count() <= n + 2


def test_nulls_and_empty_sides(spark):
    rows = spark.createDataFrame([("a",), (None,)], "k string")
    words = bloom.bloom_words(rows, "k")
    assert [r.k for r in bloom.maybe_in(rows, "k", words).collect()] == ["a"]
    assert bloom.maybe_in(rows, "k", bloom.bloom_words(rows.limit(0), "k")).count() == 0
    assert bloom.maybe_in(rows.limit(0), "k", words).count() == 0


def test_html_moves_only_behind_the_filter(spark, tmp_path):
    pages = spark.range(400).select(
        F.concat(F.lit("http://s/"), "id").alias("url"), F.concat(F.lit("<p>text "), "id", F.lit("</p>")).alias("html"),
        F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("final_url"),
    )
    pages.write.parquet(str(tmp_path / "pages"))
    urls = spark.createDataFrame([(f"http://s/{i}",) for i in (3, 77, 9999)], "url string")
    redirects = spark.createDataFrame([], "url string, target string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        table = content.scrape(urls, redirects, spark.read.parquet(str(tmp_path / "pages")), blocked=[])
        plan = table._jdf.queryExecution().executedPlan().toString().split("\n")
        got = sorted(r.url for r in table.collect())
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert got == ["http://s/3", "http://s/77"]
    # walk up from the scan of the page table to the shuffle that moves its rows
    at = next(i for i, line in enumerate(plan) if "FileScan parquet" in line and "html" in line)
    depth, above = len(plan[at]) - len(plan[at].lstrip(" :+-")), []
    for line in reversed(plan[:at]):
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            depth = here
            above.append(line)
            if "Exchange hashpartitioning" in line:
                break
    assert "Exchange hashpartitioning" in above[-1]
    assert sum("BroadcastHashJoin" in line for line in above) == 1
