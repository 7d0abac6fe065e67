"""Every query of this folder that has SQL equals it, in rows, values and types."""

import pytest

from pitwise.llm import registry
from tests.llm.helpers import SF
from tests.oracle_compare import compare, duck

LONG = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["cols_match"] and r["spark_rows"] == r["oracle_rows"] > 0 and r["exact"], r
    kinds = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {registry.oracle_sql()[name]}").fetchall()}
    assert {c: LONG[t] for c, t in registry.queries()[name](spark, SF).dtypes} == kinds


def test_operators_have_queries():
    numbers = {q.split("_")[0] for q in registry.queries() if q.startswith("op")}
    assert numbers == {f"op{i}" for i in range(1, 14)}
    assert set(registry.oracle_sql()) <= set(registry.queries())
