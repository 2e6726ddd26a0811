"""Every registered query against its DuckDB oracle (sf0.001), and the entry."""

import pytest

import __spark_entry__ as E
from docrel.plans import oracle, registry
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = {name: E.queries()[name] for name in registry.REGISTRY}
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL) and SQL.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, name, SF, QUERIES[name], SQL[name], con)
    assert info["ok"], info
    assert info["cartesian"] == 0, info  # no query pairs two multi-row sides


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["_id", "course_code", "num_enrollments"]
    assert 0 < df.count() <= 10
