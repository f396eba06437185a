"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from indicata.plans.oracle import ORACLE
from indicata.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, QUERIES[key], ORACLE.get(key), con)
    assert r["status"] in ("ok", "rows-only"), r


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "juros_real_estimado" in df.columns
