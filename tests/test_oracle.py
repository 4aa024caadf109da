"""Every registered query equals its DuckDB oracle at sf0.01 (the driver's gate)."""

import os

import pytest

import __spark_entry__ as entry
from tally import catalog
from tests.oracle_check import compare, duck_connect

SF = os.environ.get("TALLY_TEST_SF", "/root/testdata/sf0.01")
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con, verbose=False)
    assert r["status"] == "ok", r.get("problems")


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert out.count() > 0
    assert out.columns[0] == "metric_date"
