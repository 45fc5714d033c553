"""Every registered query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry
from workload.compare import difference, duck
from workload.oracles import ORACLES
from workload.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    # Queries over the corpus that SQL cannot express are tested in tests/llm.
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "dt"
    assert df.count() == 30


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, sf_dir, name):
    found = difference(spark, con, name, sf_dir)
    assert not found or (found == "no rows" and con.sql(ORACLES[name]).fetchall() == [])
