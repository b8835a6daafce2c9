"""Registered queries against their DuckDB twins (sf0.001), the driver
entry point, and the contract of ``__spark_entry__``."""

import pytest

import __spark_entry__ as entry_mod
from goldleaf.plans import catalog
from goldleaf.plans.compare import compare, duck_connect

from .conftest import SF_SMALL

SELECTED = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "order_item_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", SELECTED)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["cols_match"], r
    assert r["rows_match"], r
    assert r["hash_match"], r
