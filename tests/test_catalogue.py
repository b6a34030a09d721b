"""Every query against its SQL."""

import pytest

import __spark_entry__ as entry
from claimloom.plans import catalogue
from compare import connect, same
from conftest import DATA


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    same(catalogue.queries()[name](spark, DATA), con, catalogue.oracle_sql()[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_mentions_with_letters_beyond_ascii(spark):
    rows = catalogue.queries()["entity_mentions"](spark, DATA)
    assert rows.where("n < 1").isEmpty() and rows.count() > 0
