"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness check), and the smoke entry at sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from eddyline.plans import QUERIES
from tools.compare import compare, duck

# The training-data queries have tests of their own, in tests/llm.
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_ORACLE, con)
    assert r["schema_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["value_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
