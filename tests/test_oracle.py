"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from histlake.plans.catalog import QUERIES
from histlake_oracle import ORACLE
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "stream_id" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF, key, con)
    assert str(r["status"]).startswith("ok"), r
    assert r["spark_rows"] > 0 or key in {"country_change", "country_change_global"}, r
