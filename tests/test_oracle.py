"""Every registered query against its oracle SQL (DuckDB) on sf0.01, plus the smoke entry."""

import pytest

from oracle_compare import compare

import __spark_entry__ as entry
from metricstore.plans.event_metrics import QUERIES


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["measure_time", "val", "kind", "key", "type", "long", "string"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    result = compare(spark, "/root/testdata/sf0.01", [name], verbose=False)[name]
    assert result[0] == "ok", result
