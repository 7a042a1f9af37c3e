"""Queries of this subpackage that SQL can express, against DuckDB."""

import oracle
import pytest

from recordloom.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query(spark, name, folder):
    sf = f"/root/testdata/{folder}"
    got, want = oracle.spark_rows(Q.queries()[name](spark, sf)), oracle.duck(sf, Q.oracle_sql()[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
