"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tools.oracle_check import compare, duck

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    got = QUERIES[key](spark, SF_SMALL).toArrow()
    if key not in ORACLES:
        assert got.num_rows > 0
        return
    want = con.sql(ORACLES[key]).to_arrow_table()
    assert compare(got, want) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["product_name", "total_revenue"] and df.count() > 0
