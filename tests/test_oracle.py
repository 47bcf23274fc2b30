"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from basketry.plans import oracle, queries
from tests.compare import compare, duck

try:
    import duckdb  # noqa: F401
except ImportError:
    pytest.skip("duckdb is absent", allow_module_level=True)

SQL = oracle.oracle_sql()
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_names():
    assert set(SQL) == set(queries.queries()) - WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, sf_dir, con, name):
    problem, rows, _ = compare(spark, con, sf_dir, name, queries.queries()[name], SQL.get(name))
    assert problem is None and rows > 0


def test_entry(spark, sf_dir):
    assert "price_tier" in entry.entry(spark).columns
