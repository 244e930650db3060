import importlib.util

import pytest
from oracle import check

import __spark_entry__ as entry
from tidemark.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, data, name):
    check(spark, data, QUERIES[name], ORACLES[name])


def test_entry_has_a_stable_schema(spark, data):
    df = entry.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "order_key", "part_key", "supplier_key", "date_day", "line_count"]
    assert df.count() > 0


def test_registered_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    both = importlib.util.find_spec("corpus_pipeline") and importlib.util.find_spec("tidemark.llm")
    assert ("pipeline" in entry.queries()) == bool(both)
