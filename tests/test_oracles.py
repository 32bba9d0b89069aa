"""Every registered query against its SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF) == "ok"


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["rmse", "n_folds"]
