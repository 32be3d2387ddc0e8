"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from shopmarts.oracle import ORACLE
from shopmarts.registry import QUERIES
from shopmarts.session import tune
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_the_flagship_query_runs(spark):
    assert entry.entry(tune(spark)).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](tune(spark), FOLDER), con, ORACLE[name]) == []
