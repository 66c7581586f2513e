"""Every registered query gives the rows of its DuckDB formulation on the smallest test tables."""

import os

import pytest

from oracle_compare import compare
from phenoscope.plans import catalog, oracle_sql
from tests_support import duck_connection

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(oracle_sql.build()))
def test_query_matches_oracle(spark, name):
    problems, *_ = compare(spark, duck_connection(SF), name, catalog.registry()[name], oracle_sql.build()[name], SF)
    assert not problems
