"""Registered queries over whole tables next to their DuckDB SQL."""

import pytest
from oracle_check import connect, difference

from lakestrata.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    assert len(ours) > 0
    assert difference(ours, connect(sf_dir).sql(ORACLES[name]).df()) is None
