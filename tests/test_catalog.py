"""Every registered query against its SQL on the smallest tables."""

import pathlib

import pytest

import __spark_entry__ as spark_entry
from check import differences
from weatherloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no tables")


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    df = spark_entry.queries()[name](spark, FOLDER)
    _, message = differences(df, FOLDER, spark_entry.oracle_sql()[name])
    assert message is None, message


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["month", "mean_value"] and df.count() > 0


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
