"""Every registered query at sf0.001, beside its SQL where there is one."""

import pytest

import __spark_entry__
from tests.oracle import compare, connect
from textloom.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == ["query_id", "value"]
    assert result.count() > 0
