import pytest

from lakestrata.plans.oracles import ORACLES
from lakestrata.plans.queries import QUERIES
from oracle_check import connect, difference


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, sf_dir, duck, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    assert len(ours) > 0
    assert difference(ours, duck.sql(ORACLES[name]).df()) is None
