"""The queries with SQL against it, and all queries on the small tables."""

import pytest

from claimloom.llm import queries
from compare import connect, same
from conftest import DATA


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert same(queries.queries()[name](spark, DATA), connect(DATA), queries.oracle_sql()[name]) > 0


def test_an_operator_a_number_and_the_pipeline():
    found = queries.queries()
    assert [sum(k.startswith(f"op{n}_") for k in found) for n in range(1, 14)] == [1] * 13 and "pipeline" in found
