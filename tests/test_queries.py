"""Every registered query of the engine's own operators against DuckDB on the same tables."""

import oracle
import pytest

from recordloom import queries as Q

SQL = Q.oracle_sql()


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, sf, name):
    got = oracle.spark_rows(Q.queries()[name](spark, sf))
    assert name in SQL
    want = oracle.duck(sf, SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
