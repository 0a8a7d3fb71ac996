"""Every registered query equals its DuckDB oracle on the driver tables (sf0.001)."""

import pytest

import __spark_entry__ as E
from paths import SF_SMALL
from oracle_check import compare, duck

from tallyspark import catalog

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF_SMALL)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date", "fee_type", "fee_source", "token", "usd_price", "amount", "usd_amount"]
