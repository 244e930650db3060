import pytest
from oracle import check

from tidemark.llm import queries


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_its_sql(spark, data, name):
    check(spark, data, queries.queries()[name], queries.oracle_sql()[name])
