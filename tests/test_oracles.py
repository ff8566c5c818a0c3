"""Every registered query against its SQL, on whole tables."""

import os

import pytest
from comparison import duck, rows_of_duck, rows_of_spark

import __spark_entry__ as driver
from verification.oracles import ORACLES
from verification.registry import QUERIES

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    frame = driver.queries()[name](spark, DIRECTORY)
    expected_names, expected = rows_of_duck(duck(DIRECTORY), driver.oracle_sql()[name])
    names, rows = rows_of_spark(frame)
    assert names == expected_names
    assert sum(rows.values()) == sum(expected.values()) > 0
    assert not list((rows - expected).items())[:3]
    assert not list((expected - rows).items())[:3]


def test_flagship(spark):
    assert {row["sensor_type"] for row in driver.entry(spark).collect()} == {
        "humidity",
        "pressure",
        "temperature",
    }
