"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, connection, name):
    problem = compare(
        spark, connection, name, entry.queries()[name], entry.oracle_sql().get(name), SF_DIR
    )
    assert problem is None, problem


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["k", "execution_date", "ab_id", "ab_emitted_at", "unique_id"]
    assert df.count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
