"""Driver contract: entry point, registry keys and oracle keys."""

import os

import pytest

import __spark_entry__ as E
from trawl.plans.catalog import ORACLES, QUERIES


def test_registry_has_an_oracle_per_query():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(E.SMOKE_SF), reason="driver tables not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "q", "docno", "rank", "score", "run_id"]
    rows = df.collect()
    assert rows and all(1 <= r["rank"] <= 1000 for r in rows)
