"""Every registered query against its DuckDB oracle (order-insensitive)."""

import pytest

import __spark_entry__ as se
from boxoffice.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

NAMES = sorted(registry.REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_contract_keys():
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q)
    # rows-only keys are the nested / map-valued outputs and the stream jobs
    assert sum(n in o for n in NAMES) >= len(NAMES) - 8


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns[:3] == ["venue", "event_id", "event"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF_SMALL, con)
    assert ok, msg
