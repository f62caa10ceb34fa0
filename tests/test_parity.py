"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

from tools.compare import compare, duck

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)


def test_every_query_has_an_oracle():
    from wordstats.plans.catalog import QUERIES

    # the training-text queries are tested in tests/llm where SQL can't express them
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["rank", "word"]
    assert df.count() == 10
