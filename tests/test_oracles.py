"""Every registered query equals its DuckDB oracle on the smallest tables.

The driver runs the same check at sf0.01; ``python -m tests.oracle_compare``
runs it at any size.
"""

import pytest

import __spark_entry__ as entry
from pitwise.plans import oracles, registry
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_registry_and_oracles_cover_the_same_queries():
    assert set(registry.queries()) == set(oracles.oracle_sql())
    assert len(registry.STAGES) == 28 and len(registry.queries()) == 28 + len(registry.ADDED)
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert len(df.columns) == len(set(df.columns))
