"""Every query against its SQL on whole tables of the small scale."""

import pytest

import __spark_entry__ as entry
from rollsight.plans.catalog import QUERIES
from tests.compare import check_engine, difference

SF_DIR = "/root/testdata/sf0.01"
TEXTS = entry.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    return check_engine(SF_DIR)


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_query_matches_sql(spark, engine, name):
    assert difference(entry.queries()[name](spark, SF_DIR), engine, TEXTS[name]) is None


def test_every_query_has_sql_or_a_brute_force_test():
    assert set(QUERIES) - set(TEXTS) == {"retrain_registry"}
    assert not set(TEXTS) - set(entry.queries())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
