"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001)."""

import os

import pytest

import __spark_entry__ as entry
from tools.check_contract import compare

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SMOKE}/events.parquet"), reason="no test data")


def test_every_query_has_an_oracle():
    from trailmark.plans.contract import queries as own

    assert set(own()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "pageUrl", "element", "xBucket", "yBucket", "count"]
    assert df.count() > 0


def test_queries_match_oracles(spark):
    res = compare(spark, SMOKE, list(entry.oracle_sql()))
    bad = {k: v for k, v in res.items() if not v.get("match")}
    assert not bad, bad
