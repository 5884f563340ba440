"""Driver contract: entry() and every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from sqlcheck.compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    assert len(df.columns) == 42
    assert df.count() >= 0


def test_oracles_name_queries():
    """Queries without SQL are the numbered operators that SQL cannot express; their own tests cover them."""
    left = set(E.queries()) - set(E.oracle_sql())
    assert not set(E.oracle_sql()) - set(E.queries())
    assert all(name == "pipeline" or name.startswith("op") for name in left)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duck(SF)
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert res["ok"], res
