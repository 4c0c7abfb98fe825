"""Every registered query against its SQL twin on the small tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_result_as_sql(spark, duck, name):
    assert difference(queries()[name](spark, SF), duck, oracle_sql()[name]) is None


def test_twins_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "customer_id"
    assert df.count() > 0
