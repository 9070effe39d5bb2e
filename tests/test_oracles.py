"""Every registered query against its SQL on the small driver tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    problem, _ = compare(spark, con, name, entry.queries()[name], ORACLE[name], SF)
    assert problem is None, problem


def test_every_library_query_has_an_oracle():
    """Only queries of the optional training-data part may be tested elsewhere."""
    assert set(entry.queries()) - set(ORACLE) <= set(entry.EXTRA_QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "class_name", "reason", "boxes"]
    assert df.count() > 0
