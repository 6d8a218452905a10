import pytest

from docframe.queries import ORACLES, QUERIES
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    compare(QUERIES[name](spark, sf), ORACLES[name], sf)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.columns
    assert df.count() > 0
