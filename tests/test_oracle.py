"""Every registered query outside llm against its SQL statement, on the smallest test tables."""

import pytest

import __spark_entry__ as entry
import check

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(set(entry.queries()) - set(entry._LLM))


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert check.compare(spark, con, name, SF_DIR) == []


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["country", "n_orders"]
