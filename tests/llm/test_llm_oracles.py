import pytest

from tests.oracles import SMALL, compare
from venueweave.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_runs(spark, name):
    frame = queries.QUERIES[name](spark, SMALL)
    assert frame.columns and frame.count() >= 0
