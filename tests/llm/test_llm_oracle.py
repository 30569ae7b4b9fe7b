"""Queries of the training-data operators against DuckDB."""

import pytest

from histlake.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    r = compare(spark, SF, key, duck(SF))
    assert str(r["status"]).startswith("ok"), r
    assert r["spark_rows"] > 0


def test_all_are_registered():
    from __spark_entry__ import queries

    assert {f"op{i}" for i in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries())
