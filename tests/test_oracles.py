"""Every registered query against its SQL oracle."""

import pytest

import __spark_entry__
from verification.compare import connect, differences
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def base():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, base, name):
    assert differences(spark, base, FOLDER, name) is None


def test_entry(spark):
    frame = __spark_entry__.entry(spark)
    assert frame.columns == ["country_code", "cnt"] and frame.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
