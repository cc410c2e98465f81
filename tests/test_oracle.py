"""Every registered query against DuckDB on the same tables."""

import os

import pytest

from lakekit.plans import catalog
from oracle import compare, connect

SF_DIR = os.environ.get("LAKEKIT_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    err, rows = compare(spark, con, catalog.QUERIES[name], catalog.ORACLES.get(name), SF_DIR)
    assert err is None
    assert rows > 0 or name in EMPTY_AT_SMALL_SCALE


# at the smallest scale some filters leave nothing
EMPTY_AT_SMALL_SCALE = {"p06_last_days", "p11_partition_filter", "q08_alert", "b03_store_last_days", "b05_cancelled_per_store", "a06_having_alias", "l05_recent_edges"}


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
