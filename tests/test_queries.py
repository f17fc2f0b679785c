"""Every registered query against its SQL over the smallest tables."""

import compare
import pytest
from conftest import SMALL

from quirework.plans import data_problems, engine_queries

QUERIES = engine_queries.QUERIES | data_problems.QUERIES
SQL = engine_queries.SQL | data_problems.SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in SQL:
        assert compare.differences(spark, con, QUERIES[name], SQL[name], SMALL) == ""
    else:
        assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
