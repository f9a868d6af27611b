import pytest

from tests.oracles import SMALL, compare
from venueweave.plans import catalogue, collected, problems, reference

QUERIES = problems.QUERIES | reference.QUERIES | collected.QUERIES | catalogue.QUERIES
ORACLES = problems.ORACLES | reference.ORACLES | collected.ORACLES | catalogue.ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    compare(spark, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    frame = QUERIES[name](spark, SMALL)
    assert frame.columns and frame.count() >= 0
