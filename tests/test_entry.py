"""Queries against their SQL oracles on the smoke tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare
from checks.queries import QUERIES
from newsight.schemas import EXPORT_SCHEMA

SMOKE = entry.SMOKE_DIR
needs_data = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test tables absent")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    ok, note = compare(spark, SMOKE, name)
    assert ok, note


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(entry.oracle_sql())))
def test_query_without_sql_covers_documents(spark, name):
    """Hashing and training of Spark ML are not compared, only that their rows are there."""
    ok, _ = compare(spark, SMOKE, name)
    assert ok is None
    rows = entry.queries()[name](spark, SMOKE)
    ids = [c for c in rows.columns if c in ("doc_id", "id", "ord")]
    assert rows.count() > 0 and rows.select(ids[0]).distinct().count() == rows.count()


@needs_data
def test_entry_schema(spark):
    got = entry.entry(spark).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in EXPORT_SCHEMA]
    assert not got["url"].nullable
