"""Every registered query equals its DuckDB oracle (sf0.001; streams included)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck

QUERIES = {k: f for k, f in E.queries().items() if k not in E.LLM_QUERIES}
ORACLES = {k: q for k, q in E.oracle_sql().items() if k not in E.LLM_ORACLES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 58  # 24-hour alerts at sf0.001
    assert df.columns == ["user_id", "event_time", "seq", "type", "sum", "avg_check_5min", "message"]
